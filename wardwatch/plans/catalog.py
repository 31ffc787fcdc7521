"""Named queries: key -> callable(spark, sf_dir) -> DataFrame.

Each callable builds a fresh :class:`Layers` over the folder, so every query
reads the shared test tables and its work grows with them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import SILVER_COLUMNS
from ..operators import ml, monitor, quality, replay, reports, risk, rollup
from ..operators import transforms as tx
from ..session import scratch
from ..sources import lake, offsets
from ..sources.commits import Change, CommitLog
from ..streaming import job
from ..streaming import risk as live_risk
from .layers import Layers

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Layers(spark, sf_dir))
        run.__name__ = run.__qualname__ = name
        CATALOG[name] = run
        return fn
    return deco


def rule_risk(L: Layers) -> DataFrame:
    return risk.patient_risk(risk.rule_scored(L.labelled))


# --- layers -------------------------------------------------------------------
query("patients")(lambda L: L.patients)
query("bronze_raw")(lambda L: L.bronze)
query("parsed_readings")(lambda L: L.parsed)
query("clean_readings")(lambda L: L.clean)
query("silver_vitals")(lambda L: L.silver)
query("alerts")(lambda L: L.alerts)
query("vitals_1min")(lambda L: L.features)

# --- reports ------------------------------------------------------------------
query("q1_patient_vitals")(lambda L: reports.q1_patient_vitals(L.silver, L.patients))
query("q2_alert_counts")(lambda L: reports.q2_alert_counts(L.alerts))
query("q3_top_risky")(lambda L: reports.q3_top_risky(L.alerts, L.patients))
query("q4_ward_hourly")(lambda L: reports.q4_ward_hourly(L.features, L.patients))
query("q5_daily_summary")(lambda L: reports.q5_daily_summary(L.features))
query("q6_data_quality")(lambda L: reports.q6_data_quality(L.bronze, L.silver))
query("q7_risk_mix")(lambda L: reports.q7_risk_mix(rule_risk(L)))
query("q7_risk_members")(lambda L: reports.q7_risk_members(rule_risk(L)))

# --- layer checks -------------------------------------------------------------
query("reconcile_layers")(lambda L: reports.reconcile_layers(L.bronze, L.silver))
query("alert_matrix")(lambda L: reports.alert_matrix(L.alerts))
query("latest_readings")(lambda L: reports.latest_readings(L.silver))
query("latest_alerts")(lambda L: reports.latest_alerts(L.alerts))
query("latest_windows")(lambda L: reports.latest_windows(L.features))

# --- risk (rule-label variant; the model variant is in ml) --------------------
query("risk_labels")(lambda L: L.labelled.select("window_start", "window_end", "patient_id",
                                                 "rule_points", "label"))
query("label_distribution")(lambda L: risk.label_distribution(L.labelled))
query("recent_windows")(lambda L: risk.recent(risk.rule_scored(L.labelled))
                        .select("patient_id", "window_start", "rn"))
query("risk_vote")(lambda L: risk.vote(risk.recent(risk.rule_scored(L.labelled))))
query("patient_summary")(lambda L: risk.summary(risk.recent(risk.rule_scored(L.labelled))))
query("patient_risk_rules")(lambda L: rule_risk(L).select(*risk.PATIENT_RISK_COLUMNS)
                            .orderBy(F.desc("risk_score"), "patient_id"))
query("cluster_features")(lambda L: risk.cluster_features(L.labelled))
query("risk_counts")(lambda L: risk.risk_counts(rule_risk(L)))

# --- monitoring (rule-variant risk; "now" = newest Silver event time) --------
VIEW_MINUTES = 2          # history slider value used by the registered keys


def _now(L: Layers):
    """One "now" per query: the newest clean event time, which is Silver's too
    (de-duplication keeps every time), without the de-duplication."""
    return monitor.newest(L.clean)


def monitored(name: str):
    """A query over several layers: they are taken from one written copy of the
    clean readings, with one "now"."""
    def deco(fn):
        def run(L: Layers) -> DataFrame:
            stored = L.stored()
            return fn(stored, _now(stored))
        query(name)(run)
        return fn
    return deco


monitored("kpi_row")(lambda L, now: monitor.kpi_row(L.silver, L.alerts, rule_risk(L), VIEW_MINUTES, now))
monitored("focus_patient")(lambda L, now: monitor.focus_patient(L.silver, L.alerts, L.patients,
                                                                VIEW_MINUTES, now))
monitored("vital_series")(lambda L, now: monitor.vital_series(
    L.silver, monitor.focus_patient(L.silver, L.alerts, L.patients, VIEW_MINUTES, now), VIEW_MINUTES, now))
query("alerts_by_type")(lambda L: monitor.alerts_by_type(L.alerts, L.silver, VIEW_MINUTES, _now(L)))
query("newest_alerts")(lambda L: monitor.newest_alerts(L.alerts, L.silver, 15, VIEW_MINUTES, _now(L)))
query("risk_board")(lambda L: monitor.risk_board(rule_risk(L), L.patients))

# --- replay -------------------------------------------------------------------
REPLAY_NOW = "2025-06-01 12:00:00"
GAP_MS = 240              # the lens compresses time 5,000x: 240 ms ~ 20 min of raw events
TRAIL_MINUTES = 0.5


def _segments(L: Layers) -> DataFrame:
    return replay.gap_segments(L.silver, GAP_MS)


def _slice(L: Layers) -> DataFrame:
    return replay.replay_slice(L.silver, replay.longest_segment(_segments(L)), TRAIL_MINUTES)


def _shifted(df: DataFrame, L: Layers) -> DataFrame:
    """On the clock of the recording, i.e. of Silver's times (the clean ones)."""
    return replay.replay_shift(df, F.to_timestamp(F.lit(REPLAY_NOW)), replay.recording(L.clean))


query("replay_shift")(lambda L: _shifted(L.silver, L).select("patient_id", "event_time", "replay_time"))
query("replay_alerts_shift")(lambda L: _shifted(L.alerts, L).select(
    "alert_id", "event_time", "alert_time", "replay_time"))
query("gap_segments")(_segments)
query("longest_segment")(lambda L: replay.longest_segment(_segments(L)))
query("replay_slice")(_slice)
query("replay_alerts")(lambda L: replay.replay_alerts(L.alerts, replay.longest_segment(_segments(L)),
                                                      TRAIL_MINUTES))

# --- quality profile ----------------------------------------------------------
query("invalid_share")(lambda L: quality.invalid_share(L.parsed))
query("alert_share")(lambda L: quality.alert_share(L.clean))
query("label_agreement")(lambda L: quality.label_agreement(L.labelled))

# --- model variant of risk (rows-only checks: training is not SQL) -----------


def _trained(L: Layers):
    return ml.train(L.labelled)


query("risk_model_eval")(lambda L: (lambda t: L.spark.createDataFrame(
    [(t.train_windows, t.test_windows, float(t.accuracy), float(t.f1))],
    "train_windows bigint, test_windows bigint, accuracy double, f1 double"))(_trained(L)))
query("window_scores")(lambda L: ml.scored_windows(L.labelled)
                       .select("patient_id", "window_start", "label", "prediction", "window_score"))
query("patient_clusters")(lambda L: ml.cluster(risk.cluster_features(L.labelled)))
query("patient_risk")(lambda L: ml.run_round(L.spark, L.labelled).patient_risk)
query("model_metrics")(lambda L: ml.run_round(L.spark, L.labelled).metrics)
# what SQL can say of the model variant
query("model_split")(lambda L: ml.sides(L.labelled))
query("model_checks")(lambda L: ml.checks(ml.run_round(L.spark, L.labelled)))

# --- streaming layers over the lens messages (one available-now run) ---------


def _stream_layer(L: Layers, name: str) -> DataFrame:
    """Write the messages as Kafka-shaped files into a fresh folder of the
    shared directory, run the layer's streaming query to completion, read its
    sink back (only files committed to the sink manifest)."""
    root = scratch(L.spark, "stream")
    L.messages.write.parquet(f"{root}/messages")
    sink = job.Sink(f"{root}/lake", f"{root}/checkpoints")
    job.run_bounded(L.spark, job.file_source(L.spark, f"{root}/messages"), sink,
                    alert_time=tx.replay_as_of(L.alert_delay_s), only=[name])
    return lake.read_layer(L.spark, sink.path(name), job.TABLES[name])


def _stream_silver(L: Layers) -> DataFrame:
    """Silver rows as streamed, each with whether it equals a delivered reading in
    every column.  (dropDuplicates keeps the first copy to arrive, which depends
    on the order of arrival where a key was delivered with two payloads.)"""
    kept = _stream_layer(L, "silver_vitals")
    same = [c for c in SILVER_COLUMNS if c != "event_date"]
    delivered = L.clean.select(*same).distinct().withColumn("found", F.lit(True))
    match = [kept[c].eqNullSafe(delivered[c]) for c in same]
    return kept.join(delivered, match, "left").select(
        kept["patient_id"], kept["event_time"], kept["event_date"],
        F.coalesce("found", F.lit(False)).alias("delivered"))


query("stream_silver")(_stream_silver)
query("stream_alerts")(lambda L: _stream_layer(L, "gold_alerts"))
query("stream_vitals_1min")(lambda L: _stream_layer(L, "gold_vitals_1min"))


# --- a stream with offsets; two outputs of one pass; accounts of a stream ------


def _from_offsets(L: Layers) -> DataFrame:
    """Bronze by way of the message log: at most 20,000 offsets a micro-batch."""
    root = scratch(L.spark, "offsets")
    offsets.append(L.messages, f"{root}/log")
    sink = job.Sink(f"{root}/lake", f"{root}/checkpoints")
    job.run_log(L.spark, f"{root}/log", sink, "bronze_raw_vitals")
    return lake.read_layer(L.spark, sink.path("bronze_raw_vitals"), "raw_vitals")


def _files(L: Layers, parts: int = 1) -> tuple[str, DataFrame]:
    """A folder of message files and the stream over it."""
    root = scratch(L.spark, "stream")
    (L.messages if parts == 1 else L.messages.repartition(parts, "offset")).write.parquet(f"{root}/messages")
    return root, job.file_source(L.spark, f"{root}/messages")


def _rejected(L: Layers) -> DataFrame:
    root, messages = _files(L)
    job.start_judged(messages, f"{root}/judged", f"{root}/checkpoint", available_now=True).awaitTermination()
    _, rejected = job.read_judged(L.spark, f"{root}/judged")
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


def _accounting(L: Layers) -> DataFrame:
    root, messages = _files(L)
    accounts = job.run_accounted(L.spark, messages, job.Sink(f"{root}/lake", f"{root}/checkpoints"))
    silver = lake.read_layer(L.spark, f"{root}/lake/vitals", "vitals").agg(F.count(F.lit(1)).alias("silver")).scalar()
    return accounts.agg(*[F.sum(c).alias(c) for c in ("messages", "invalid", "late", "duplicates", "written")]).withColumn(
        "adds_up", (F.col("messages") == F.col("invalid") + F.col("late") + F.col("duplicates") + F.col("written"))
        & (F.col("written") == silver))


def _live_risk(L: Layers) -> DataFrame:
    """Messages -> one-minute layer -> each patient's last windows, two streams."""
    root, messages = _files(L)
    sink = job.Sink(f"{root}/lake", f"{root}/checkpoints")
    job.run_bounded(L.spark, messages, sink, only=["gold_vitals_1min"])
    live_risk.run_bounded(L.spark, sink.path("gold_vitals_1min"), f"{root}/windows", f"{root}/checkpoints/risk", files_per_batch=8)
    return live_risk.patient_risk(L.spark, f"{root}/windows").select(*risk.PATIENT_RISK_COLUMNS)


query("stream_from_offsets")(_from_offsets)
query("rejected_by_reason")(_rejected)
query("stream_accounting")(_accounting)
query("stream_patient_risk")(_live_risk)

# --- commit log and zone map ----------------------------------------------------


def _log(L: Layers) -> CommitLog:
    return CommitLog(L.spark, scratch(L.spark, "commits"))


def _snapshot_read(L: Layers) -> DataFrame:
    """Two rounds of the risk table, the second read from a pinned version."""
    log, rows = _log(L), rule_risk(L).select(*risk.PATIENT_RISK_COLUMNS)
    first = log.commit({"patient_risk": Change(rows.filter("risk_level = 'High'")), "patients": Change(L.patients)})
    second = log.commit({"patient_risk": Change(rows)}, base=first)
    return log.pin(second).table("patient_risk")


def _recent_slice(L: Layers) -> DataFrame:
    """The last minutes of alerts that were committed in three appends."""
    log = _log(L)
    for i in range(3):
        log.commit({"alerts": Change(L.alerts.filter(F.pmod(F.hour("event_time"), F.lit(3)) == i), "event_time", append=True)})
    pinned = log.pin()
    return pinned.recent("alerts", pinned.newest("alerts") - dt.timedelta(minutes=VIEW_MINUTES))


def _inventory(L: Layers) -> DataFrame:
    stored, log = L.stored(), _log(L)
    log.commit({"raw_vitals": Change(stored.bronze, "kafka_time"), "vitals": Change(stored.silver, "event_time"),
                "alerts": Change(stored.alerts, "event_time"), "vitals_1min": Change(stored.features, "window_start")})
    return log.pin().inventory().select("table_name", "rows", "oldest", "newest")


def _replay_bundle(L: Layers) -> DataFrame:
    stored, log = L.stored(), _log(L)
    layers = L.spark.createDataFrame([("Silver", "vitals")], "layer string, table string")
    replay.commit_bundle(stored.silver, stored.alerts, rule_risk(stored), stored.patients, layers, log, GAP_MS, TRAIL_MINUTES)
    return log.pin().inventory().select("table_name", "rows")


def _written(L: Layers) -> tuple[str, Layers]:
    """A batch copy of Silver, alerts and features below a lake root."""
    root, stored = scratch(L.spark, "lake"), L.stored()
    for name, df in (("vitals", stored.silver), ("alerts", stored.alerts), ("vitals_1min", stored.features)):
        df.write.partitionBy("event_date").parquet(f"{root}/{name}")
    return root, stored


def _layer_reader(L: Layers) -> DataFrame:
    root, _ = _written(L)
    there = lake.read_layer(L.spark, f"{root}/vitals", "vitals")
    return there.unionByName(lake.read_layer(L.spark, f"{root}/not_there", "vitals"))


def _sql_alert_counts(L: Layers) -> DataFrame:
    """The report as SQL text over the registered external tables."""
    root, _ = _written(L)
    database = "ww_" + root.rsplit("-", 1)[-1]
    lake.register_tables(L.spark, root, database=database)
    return L.spark.sql(f"""
        select alert_type, severity, count(*) as alerts, count(distinct patient_id) as patients_affected,
               round(cast(sum(cast(latency_sec as decimal(18,2))) as double) / count(latency_sec), 2) as avg_latency_sec
        from {database}.alerts group by alert_type, severity order by alerts desc""")


query("snapshot_read")(_snapshot_read)
query("recent_slice")(_recent_slice)
query("layer_inventory")(_inventory)
query("replay_bundle")(_replay_bundle)
query("layer_reader")(_layer_reader)
query("sql_alert_counts")(_sql_alert_counts)

# --- minute roll-ups with bitmaps of patients --------------------------------------
query("rollup_alert_counts")(lambda L: rollup.alert_counts(rollup.alerts_per_minute(L.alerts)))
query("rollup_ward_hourly")(lambda L: rollup.ward_hourly(rollup.windows_per_minute(L.features, L.patients)))


def _active(L: Layers) -> DataFrame:
    path = scratch(L.spark, "rollup") + "/minutes"
    rollup.per_minute(L.clean, "event_time", []).write.parquet(path)
    return rollup.active_patients(L.spark.read.parquet(path))


query("active_patients")(_active)

# --- the model, held against its own outputs ---------------------------------------


def _agreement(L: Layers) -> DataFrame:
    """The tree saved, reloaded and compiled."""
    path = scratch(L.spark, "tree") + "/model"
    trained = ml.train(L.labelled).model
    trained.write().overwrite().save(path)
    return ml.tree_agreement(ml.PipelineModel.load(path), L.labelled)


query("training_gate")(lambda L: ml.training_gate(L.features))
query("tree_agreement")(_agreement)
query("model_verified")(lambda L: ml.verified(ml.run_round(L.spark, L.labelled)))
