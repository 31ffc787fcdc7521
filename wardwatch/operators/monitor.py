"""Monitoring aggregates behind the live view: KPI row, focus patient, vital
series with breach flags, alerts by type, newest alerts, risk board.

"Now" is a parameter (``as_of`` Column); by default the newest event time of
Silver, so results are reproducible.  (The newest clean reading has the same
time and needs no de-duplication: pass that where it is at hand.)  Scalars are scalar subqueries (one
small job each, inlined), never collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules

HISTORY_MINUTES = 10


def newest(df: DataFrame, col: str = "event_time") -> Column:
    return df.agg(F.max(col)).scalar()


def minutes_before(ts: Column, minutes: float) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) - F.lit(int(minutes * 60_000_000)))


def history(df: DataFrame, since: Column, col: str = "event_time",
            partition_col: str | None = "event_date") -> DataFrame:
    """Rows at or after ``since``.  On a date-partitioned layer the matching
    date predicate is added, which Spark cannot derive from the time one, so
    old partitions are pruned at the scan."""
    out = df.filter(F.col(col) >= since)
    if partition_col and partition_col in df.columns:
        out = out.filter(F.col(partition_col) >= F.to_date(since))
    return out


def kpi_row(silver: DataFrame, alerts: DataFrame, patient_risk: DataFrame,
            minutes: float = HISTORY_MINUTES, as_of: Column | None = None,
            metrics: DataFrame | None = None) -> DataFrame:
    """Patients active in the last minute, all Silver rows, mean alert latency
    and critical alerts in the history window, High-risk patients, and - given
    the model-metrics row - the model's test accuracy."""
    now = as_of if as_of is not None else newest(silver)
    since = minutes_before(now, minutes)
    last_minute = minutes_before(now, 1)
    in_window = history(alerts, since).agg(F.struct(
        rules.exact_avg("latency_sec", 2, 12).alias("lat"),
        F.count_if(F.col("severity") == "CRITICAL").alias("crit"))).scalar()
    return (silver.agg(
                F.count_distinct(F.when(F.col("event_time") >= last_minute, F.col("patient_id")))
                 .alias("patients_active"),
                F.count(F.lit(1)).alias("silver_rows"))
            .withColumn("avg_latency_sec", in_window["lat"])
            .withColumn("critical_alerts", in_window["crit"])
            .withColumn("high_risk_patients",
                        patient_risk.agg(F.count_if(F.col("risk_level") == "High")).scalar())
            .transform(lambda df: df if metrics is None else df.withColumn(
                "model_accuracy", metrics.agg(F.max("accuracy")).scalar())))


def focus_patient(silver: DataFrame, alerts: DataFrame, patients: DataFrame,
                  minutes: float = HISTORY_MINUTES, as_of: Column | None = None) -> DataFrame:
    """The patient of the newest alert in the window, else of the newest
    reading (ties: larger alert_id / patient_id), with ward and age."""
    now = as_of if as_of is not None else newest(silver)
    since = minutes_before(now, minutes)
    by_alert = (history(alerts, since)
                .agg(F.max(F.struct("event_time", "alert_id", "patient_id"))["patient_id"])
                .scalar())
    pick = (history(silver, since)
            .agg(F.max(F.struct("event_time", "patient_id"))["patient_id"].alias("by_reading"))
            .select(F.coalesce(by_alert, F.col("by_reading")).alias("patient_id"),
                    F.when(by_alert.isNotNull(), "alert").otherwise("reading").alias("source")))
    return (pick.join(patients.select("patient_id", "ward", "age"), "patient_id", "left")
            .select("patient_id", "source", "ward", "age"))


def vital_series(silver: DataFrame, focus: DataFrame, minutes: float = HISTORY_MINUTES,
                 as_of: Column | None = None) -> DataFrame:
    """Ordered (time, metric, value, threshold, breach) of the focus patient:
    heart rate against its high limit, SpO2 against its low limit."""
    now = as_of if as_of is not None else newest(silver)
    # a scalar predicate on the de-dup key, which filters below the de-dup
    one = history(silver.filter(F.col("patient_id") == focus.agg(F.max("patient_id")).scalar()),
                  minutes_before(now, minutes))
    series = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"),
                                F.lit(float(rules.LIMITS[c].warn)).alias("threshold"),
                                rules.beyond(c).alias("breach")) for c in ("heart_rate", "spo2")])
    return (one.select("patient_id", "event_time", F.inline(series))
            .orderBy("metric", "event_time"))


def alerts_by_type(alerts: DataFrame, silver: DataFrame, minutes: float = HISTORY_MINUTES,
                   as_of: Column | None = None) -> DataFrame:
    now = as_of if as_of is not None else newest(silver)
    return (history(alerts, minutes_before(now, minutes))
            .groupBy("alert_type").agg(F.count(F.lit(1)).alias("alerts"))
            .withColumn("name", rules.alert_label("alert_type"))
            .orderBy(F.desc("alerts"), "alert_type"))


def newest_alerts(alerts: DataFrame, silver: DataFrame, n: int = 15,
                  minutes: float = HISTORY_MINUTES, as_of: Column | None = None) -> DataFrame:
    now = as_of if as_of is not None else newest(silver)
    return (history(alerts, minutes_before(now, minutes))
            .orderBy(F.desc("event_time"), "alert_id", "latency_sec").limit(n)
            .select(F.date_format("event_time", "HH:mm:ss").alias("time_utc"), "event_time",
                    "patient_id", "alert_type", "severity", "message", "latency_sec"))


def risk_board(patient_risk: DataFrame, patients: DataFrame) -> DataFrame:
    """Risk per patient with age and ward, highest score first."""
    cols = ["patient_id", "risk_level", "risk_score", "age", "ward",
            "avg_hr", "avg_spo2", "avg_sys", "avg_dia", "avg_temp"]
    if "cluster_group" in patient_risk.columns:
        cols.insert(3, "cluster_group")
    return (patient_risk.join(patients.select("patient_id", "age", "ward"), "patient_id", "left")
            .select(*cols).orderBy(F.desc("risk_score"), "patient_id"))
