"""Gap segmentation against a brute-force scan, replay clock, slices."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardwatch.operators import replay


def times_df(spark, seconds):
    base = dt.datetime(2026, 1, 1)
    return spark.createDataFrame([(base + dt.timedelta(seconds=s),) for s in seconds],
                                 "event_time timestamp")


def brute(seconds, gap):
    s = pd.Series(sorted(seconds))
    seg = (s.diff() > gap).cumsum() + 1
    out = s.groupby(seg).agg(["min", "max", "count"])
    return [(int(k), r["min"], r["max"], int(r["count"])) for k, r in out.iterrows()]


def segs(spark, seconds, gap_s, block=4096):
    df = replay.gap_segments(times_df(spark, seconds), int(gap_s * 1000), block=block)
    base = dt.datetime(2026, 1, 1)
    return [(r["segment"], (r["seg_start"] - base).total_seconds(),
             (r["seg_end"] - base).total_seconds(), r["readings"])
            for r in df.orderBy("segment").collect()]


def test_equal_gap_stays_together(spark):
    assert segs(spark, [0, 20, 41], 20) == [(1, 0, 20, 2), (2, 41, 41, 1)]


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_matches_brute_force(spark, block):
    rng = random.Random(7)
    secs, t = [], 0.0
    for _ in range(600):
        t += rng.choice([0.0, 0.5, 1.0, 5.0, 19.999, 20.0, 20.001, 45.0])
        secs.append(round(t, 3))
    secs += secs[:40]                       # duplicates of the same time
    assert segs(spark, secs, 20, block) == brute(secs, 20)


def test_longest_and_slice_and_alerts(spark):
    base = dt.datetime(2026, 1, 1)
    seconds = [0, 10, 20, 100, 101, 102, 103, 104, 105, 106, 200]
    silver = spark.createDataFrame(
        [("P-1", base + dt.timedelta(seconds=s), dt.date(2026, 1, 1)) for s in seconds],
        "patient_id string, event_time timestamp, event_date date")
    segments = replay.gap_segments(silver, 20_000)
    longest = replay.longest_segment(segments).first()
    assert (longest["seg_start"], longest["seg_end"]) == \
        (base, base + dt.timedelta(seconds=20))           # tie on duration 20 s: earliest wins
    sl = replay.replay_slice(silver, replay.longest_segment(segments), trail_minutes=0.25)
    assert sorted((r["event_time"] - base).total_seconds() for r in sl.collect()) == [10, 20]
    alerts = silver.withColumn("alert_id", F.lit("x"))
    assert replay.replay_alerts(alerts, replay.longest_segment(segments), 0.25).count() == 2


def test_replay_shift_loops_onto_the_clock(spark):
    df = times_df(spark, [0, 30, 59])
    now = dt.datetime(2026, 3, 1, 0, 0, 45)
    out = replay.replay_shift(df, F.lit(now)).orderBy("event_time").collect()
    length = 60
    pos = (now - dt.datetime(1970, 1, 1)).total_seconds() % length
    for r, off in zip(out, [0, 30, 59]):
        expect = now - dt.timedelta(seconds=(pos - off) % length)
        assert r["replay_time"] == expect
        assert now - dt.timedelta(seconds=length) < r["replay_time"] <= now


def test_export_bundle(spark, tiny):
    import tempfile
    from wardwatch.operators import risk
    from wardwatch.plans.layers import Layers
    from wardwatch.sources import lake
    L = Layers(spark, tiny)
    out = tempfile.mkdtemp(prefix="wardwatch-bundle-test-")
    L.silver.write.partitionBy("event_date").parquet(f"{out}/lake/vitals")
    risk_table = risk.patient_risk(risk.rule_scored(L.labelled))
    lake.write_snapshot(risk_table, f"{out}/lake/patient_risk", "1")
    lake.write_snapshot(risk_table.limit(4), f"{out}/lake/patient_risk", "2")
    layers = lake.inventory(spark, {"silver": ("Silver", "vitals", f"{out}/lake/vitals"),
                                    "risk": ("Gold", "patient_risk", f"{out}/lake/patient_risk"),
                                    "none": ("Gold", "model", f"{out}/lake/none")})
    metrics = spark.createDataFrame([(0.5, 3)], "accuracy double, windows bigint")
    paths = replay.export_bundle(L.silver, L.alerts, risk_table, L.patients, metrics, layers,
                                 f"{out}/bundle", gap_ms=240, trail_minutes=0.5)
    assert sorted(paths) == ["alerts", "model_metrics", "patient_risk", "patients", "recording", "vitals"]
    v = spark.read.parquet(paths["vitals"])
    a = spark.read.parquet(paths["alerts"])
    assert v.count() == replay.replay_slice(
        L.silver, replay.longest_segment(replay.gap_segments(L.silver, 240)), 0.5).count()
    lo, hi = v.agg(F.min("event_time"), F.max("event_time")).first()
    assert a.filter((F.col("event_time") < lo) | (F.col("event_time") > hi)).count() == 0
    assert "event_date" not in v.columns and "event_date" not in a.columns
    assert spark.read.parquet(paths["patient_risk"]).count() > 0
    assert spark.read.parquet(paths["patients"]).count() == L.patients.count()
    assert spark.read.json(paths["model_metrics"]).first()["accuracy"] == 0.5
    told = spark.read.schema("recorded_from timestamp, recorded_to timestamp, "
                             "layers array<struct<table: string, rows: bigint, parquet_files: bigint>>") \
        .json(paths["recording"]).first()
    assert (told["recorded_from"], told["recorded_to"]) == (lo, hi)
    assert {x["table"]: x["rows"] for x in told["layers"]} == {
        "vitals": L.silver.count(), "patient_risk": 4, "model": 0}        # the newest snapshot


def test_alerts_play_with_their_readings(spark):
    """Alerts at 10 to 30 s of a recording of 0 to 40 s: on the same clock."""
    base = dt.datetime(2026, 1, 1)
    silver = times_df(spark, [0, 10, 20, 30, 40])
    alerts = times_df(spark, [10, 20, 30])
    now = F.lit(dt.datetime(2026, 3, 1, 0, 0, 7))
    clock = replay.recording(silver)
    played = {r["event_time"]: r["replay_time"] for r in replay.replay_shift(silver, now, clock).collect()}
    for r in replay.replay_shift(alerts, now, clock).collect():
        assert played[r["event_time"]] == r["replay_time"]
    assert base in played


def test_blocks_grow_with_the_root_of_the_range(spark):
    secs = [0.0, 0.001, 5000.0, 5000.001, 100000.0]
    df = times_df(spark, secs)
    assert [r["readings"] for r in replay.gap_segments(df, 1).orderBy("segment").collect()] == [2, 2, 1]


def test_gap_segments_agree_with_session_windows(spark):
    """session_window merges readings whose gap is <= the gap duration, so its
    sessions over all readings are the same segments."""
    rng = random.Random(11)
    secs, t = [], 0.0
    for _ in range(400):
        t += rng.choice([0.5, 3.0, 19.0, 20.0, 21.0, 60.0])
        secs.append(t)
    df = times_df(spark, secs)
    sessions = (df.groupBy(F.session_window("event_time", "20 seconds"))
                .agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi"),
                     F.count(F.lit(1)).alias("n")))
    ours = replay.gap_segments(df, 20_000)
    a = sorted((r["lo"], r["hi"], r["n"]) for r in sessions.collect())
    b = sorted((r["seg_start"], r["seg_end"], r["readings"]) for r in ours.collect())
    assert a == b
