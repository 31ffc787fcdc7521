"""Live patient risk, two outputs of one pass, and the accounts of a stream."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_streaming import at, msg, write_batches

from wardwatch.functions.schema import FEATURE_SCHEMA
from wardwatch.operators import features, ml, risk, rollup
from wardwatch.operators import transforms as tx
from wardwatch.plans.layers import Layers
from wardwatch.sources import lake
from wardwatch.streaming import job
from wardwatch.streaming import risk as live


def window(patient, minute, hr):
    start = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=minute)
    return (start, start + dt.timedelta(minutes=1), patient, 10, hr, hr, 97.0, 96.0, 120.0, 80.0, 121.0, 36.8, 37.0, 5, 0, 0, start.date())


def risk_rows(df):
    return sorted(tuple(r) for r in df.select(*risk.PATIENT_RISK_COLUMNS).collect())


def test_live_risk_equals_batch_after_every_batch(spark, tmp_path):
    """Batches add windows, bring one late and one twice; the risk is the batch code's each time."""
    layer, out, ck = (str(tmp_path / n) for n in ("vitals_1min", "windows", "ck"))
    batches = [[window("P-1", m, 100.0 + m) for m in range(4)] + [window("P-2", 0, 70.0)],
               [window("P-1", m, 130.0 - m) for m in range(4, 9)] + [window("P-3", 1, 96.0)],
               [window("P-2", 3, 120.0), window("P-2", 3, 120.0), window("P-1", 8, 122.0)],      # again
               [window("P-1", 2, 99.0), window("P-2", 1, 115.0)]]                                # late
    seen = []
    for batch in batches:
        seen += batch
        spark.createDataFrame(batch, FEATURE_SCHEMA).coalesce(1).write.mode("append").parquet(layer)
        live.run_bounded(spark, layer, out, ck, buckets=2)
        all_of = spark.createDataFrame(seen, FEATURE_SCHEMA).dropDuplicates(["patient_id", "window_start"])
        want = risk.patient_risk(risk.rule_scored(features.labelled(features.complete(all_of))))
        assert risk_rows(live.patient_risk(spark, out)) == risk_rows(want)


def test_untouched_patients_are_not_written_again(spark, tmp_path):
    layer, out, ck = (str(tmp_path / n) for n in ("vitals_1min", "windows", "ck"))
    spark.createDataFrame([window(f"P-{i}", m, 90.0) for i in range(20) for m in range(9)], FEATURE_SCHEMA).write.parquet(layer)
    live.run_bounded(spark, layer, out, ck, buckets=3)
    assert spark.read.parquet(out).count() == 100      # five windows each, whatever the history
    spark.createDataFrame([window("P-7", 9, 95.0), window("P-8", 0, 95.0)], FEATURE_SCHEMA).write.mode("append").parquet(layer)
    live.run_bounded(spark, layer, out, ck, buckets=3)
    again = spark.read.parquet(out)
    assert again.count() == 105 and {r["patient_id"] for r in again.filter("revision = 2").collect()} == {"P-7"}


def messages(spark):
    import json
    good = json.loads(msg(0, at(0, 10))["value"])
    bad = [b"{", b"[1, 2]", json.dumps(good | {"patient_id": None}).encode(), json.dumps(good | {"timestamp": "soon"}).encode(),
           json.dumps(good | {"steps": 1.5}).encode(), json.dumps(good | {"steps": -1, "spo2": 10}).encode(),
           json.dumps(good | {"systolic_bp": 80}).encode(), json.dumps(good | {"heart_rate": None}).encode(),
           json.dumps(good | {"spo2": 101, "body_temp": 50}).encode(), json.dumps(good | {"body_temp": 33.9}).encode()]
    rows = [msg(i, at(0, i)) for i in range(5)] + [msg(10 + i, at(1, i)) | {"value": v} for i, v in enumerate(bad)]
    return rows, bad


def test_every_message_is_clean_or_has_its_first_reason(spark, tmp_path):
    rows, bad = messages(spark)
    write_batches(str(tmp_path / "in"), [rows[:6], rows[6:]])
    source = lambda: job.file_source(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    for _ in range(2):                                 # a second run finds nothing new
        job.start_judged(source(), str(tmp_path / "out"), str(tmp_path / "ck"), available_now=True).awaitTermination()
    clean, rejected = job.read_judged(spark, str(tmp_path / "out"))
    assert sorted(r["kafka_offset"] for r in clean.collect()) == list(range(5))
    assert clean.columns == tx.clean(tx.parse(source())).columns
    got = {r["kafka_offset"] - 10: (r["reason"], r["raw_json"].encode()) for r in rejected.collect()}
    want = ["unreadable", "unreadable", "patient_id missing", "event_time missing", "steps missing", "steps below zero",
            "systolic_bp below diastolic_bp", "heart_rate out of range", "spo2 out of range", "body_temp out of range"]
    assert got == {i: (w, b) for i, (w, b) in enumerate(zip(want, bad, strict=True))}


def test_judged_agrees_with_the_noise_filter(spark, tiny):
    L = Layers(spark, tiny)
    judged = tx.judged(L.messages)
    clean = judged.filter("outcome = 'clean'").select(*L.clean.columns)
    assert clean.exceptAll(L.clean).count() == 0 == L.clean.exceptAll(clean).count()


def test_accounts_part_late_invalid_duplicate_and_written(spark, tmp_path):
    """Four batches: the watermark (2 minutes) has passed the late row by its batch."""
    src = str(tmp_path / "in")
    invalid = msg(9, at(0, 30), hr=500.0)
    write_batches(src, [[msg(0, at(0, 10)), msg(1, at(0, 10)), invalid], [msg(2, at(0, 10)), msg(3, at(10, 0))],
                        [msg(4, at(20, 0))], [msg(5, at(1, 0)), msg(6, at(20, 0)), msg(7, at(20, 5))]])
    sink = job.Sink(str(tmp_path / "lake"), str(tmp_path / "ck"))
    accounts = job.run_accounted(spark, job.file_source(spark, src, max_files_per_trigger=1), sink).collect()
    told = [tuple(r)[1:] for r in accounts if r["messages"]]
    assert told == [(3, 1, 0, 1, 1), (2, 0, 0, 1, 1), (1, 0, 0, 0, 1), (3, 0, 1, 1, 1)]
    assert all(m == i + late + d + w for m, i, late, d, w in told)
    assert lake.read_layer(spark, sink.path("silver_vitals"), "vitals").count() == sum(t[4] for t in told)
    assert spark.read.parquet(os.path.join(sink.lake_root, "_accounts")).count() == len(accounts)


def test_stateless_layers_are_written_without_a_shuffle(spark, tmp_path):
    src = str(tmp_path / "in")
    write_batches(src, [[msg(i, at(0, 10), hr=150.0) for i in range(20)]])
    for name in ("bronze_raw_vitals", "gold_alerts"):
        q = job.start(job.layers(job.file_source(spark, src))[name], name,
                      job.Sink(str(tmp_path / "lake"), str(tmp_path / "ck")), available_now=True)
        q.awaitTermination()
        assert "Exchange" not in q._jsq.explainInternal(False)


@pytest.mark.parametrize("split", [1, 7])
def test_rollups_merge_to_the_exact_counts(spark, split):
    """Patients in several buckets, minutes and groups; merged from parts in any order."""
    rows = [(f"P-{(i * 7919) % 100_000:06d}", at(i % 50, i % 60), "A" if i % 3 else "B", i / 100) for i in range(3000)]
    df = spark.createDataFrame(rows, "patient_id string, event_time timestamp, kind string, latency_sec double").repartition(split)
    rolled = rollup.per_minute(df, "event_time", ["kind"], latency=rollup.exact("latency_sec", 2))
    assert rolled.select("bucket").distinct().count() > 2
    got = {r["__k0"]: (r["patients"], r["rows"], float(r["latency"])) for r in rollup.merged(rolled, ["kind"], sums=("latency",)).collect()}
    want = {r["kind"]: (r["p"], r["n"], round(r["s"], 2)) for r in df.groupBy("kind").agg(
        F.count_distinct("patient_id").alias("p"), F.count(F.lit(1)).alias("n"), F.sum("latency_sec").alias("s")).collect()}
    assert got == want


def test_compiled_tree_scores_as_the_model_without_vectors(spark, tiny, tmp_path):
    labelled = Layers(spark, tiny).labelled.cache()
    model = ml.train(labelled).model
    model.write().overwrite().save(str(tmp_path / "tree"))
    again = ml.PipelineModel.load(str(tmp_path / "tree"))
    keys = ["patient_id", "window_start", "prediction", "window_score"]
    scored, compiled = ml.score_windows(model, labelled).select(*keys), ml.score_compiled(again, labelled).select(*keys)
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, compiled.collect()))
    plan = compiled._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "CASE WHEN" in plan
    two = labelled.withColumn("label", F.when(F.col("label") > 1, 1.0).otherwise(F.col("label")))     # class 2 never seen
    told = ml.tree_agreement(ml.tree_pipeline().fit(two), two).first()
    assert told["windows"] == told["agreeing"] == labelled.count()


def test_verification_notices_a_wrong_cluster_and_wrong_metrics(spark, tiny):
    L = Layers(spark, tiny)
    rnd = ml.run_round(spark, L.labelled)
    good = ml.verified(rnd).first()
    assert good["nearest"] == good["patients"] and good["names_follow"] and good["metrics_follow"]
    rnd.trained.accuracy -= 0.01
    some = rnd.clusters.agg(F.min("patient_id")).first()[0]
    names = {r["cluster"]: r["cluster_group"] for r in rnd.clusters.select("cluster", "cluster_group").distinct().collect()}
    own = rnd.clusters.filter(F.col("patient_id") == some).first()["cluster"]
    other = next(c for c in names if c != own)
    moved = F.col("patient_id") == some
    rnd.clusters = (rnd.clusters.withColumn("cluster", F.when(moved, other).otherwise(F.col("cluster")))
                    .withColumn("cluster_group", F.when(moved, names[other]).otherwise(F.col("cluster_group"))))
    bad = ml.verified(rnd).first()
    assert bad["nearest"] < bad["patients"] and not bad["metrics_follow"]


def test_training_gate_counts_complete_windows(spark, tiny):
    windows = Layers(spark, tiny).features
    n = windows.count()
    half = windows.withColumn("avg_hr", F.when(F.col("patient_id") > "P-000008", F.col("avg_hr")))
    told = ml.training_gate(half, min_windows=n).first()
    assert told["windows"] == n and 0 < told["complete"] < n and not told["enough"]
