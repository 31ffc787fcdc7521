"""Reporting queries over the lake (Q1-Q7) and the layer checks (C1-C3).

Each report is a function of layer DataFrames.  Where the report joins a
fact layer with the patient registry and then groups by a registry column
that is functionally dependent on ``patient_id`` (the registry is keyed by
it), the fact side is aggregated per patient first, so the join sees one row
per patient instead of one per reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules


def q1_patient_vitals(silver: DataFrame, patients: DataFrame) -> DataFrame:
    """Average vitals per patient (Silver left-joined with the registry)."""
    per_patient = silver.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("readings"),
        F.round(F.avg("heart_rate"), 1).alias("avg_hr"),
        F.round(F.avg("spo2"), 1).alias("avg_spo2"),
        F.round(F.avg("systolic_bp"), 0).alias("avg_sys"),
        F.round(F.avg("diastolic_bp"), 0).alias("avg_dia"),
        F.round(F.avg("body_temp"), 2).alias("avg_temp"),
    )
    return (per_patient.join(patients.select("patient_id", "ward"), "patient_id", "left")
            .select("patient_id", "ward", "readings", "avg_hr", "avg_spo2", "avg_sys",
                    "avg_dia", "avg_temp")
            .orderBy("patient_id"))


def q2_alert_counts(alerts: DataFrame) -> DataFrame:
    """Alert counts by type and severity, distinct patients, mean latency."""
    return (alerts.groupBy("alert_type", "severity")
            .agg(F.count(F.lit(1)).alias("alerts"),
                 F.countDistinct("patient_id").alias("patients_affected"),
                 F.round(rules.exact_avg("latency_sec", 2, 12), 2).alias("avg_latency_sec"))
            .orderBy(F.desc("alerts"), "alert_type", "severity"))


def q3_top_risky(alerts: DataFrame, patients: DataFrame, k: int = 5) -> DataFrame:
    """Top-k patients by critical alerts, then by all alerts.

    The set of alert types is bounded (five rules), so ``collect_set`` stays
    small per patient; it is sorted to make the text deterministic, and
    ``patient_id`` breaks ties.  The registry is joined to the k winners only
    (a plain left join: AQE broadcasts a small registry; a large one is
    pre-filtered by Spark's runtime bloom filter built from the k keys).
    """
    per_patient = alerts.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.sum(F.when(F.col("severity") == "CRITICAL", 1).otherwise(0)).alias("critical_alerts"),
        F.array_join(F.sort_array(F.collect_set("alert_type")), ", ").alias("alert_types"),
    )
    top = per_patient.orderBy(F.desc("critical_alerts"), F.desc("total_alerts"),
                              "patient_id").limit(k)
    return (top.join(patients.select("patient_id", "age", "ward"), "patient_id", "left")
            .select("patient_id", "age", "ward", "total_alerts", "critical_alerts", "alert_types")
            .orderBy(F.desc("critical_alerts"), F.desc("total_alerts"), "patient_id"))


def q4_ward_hourly(features: DataFrame, patients: DataFrame) -> DataFrame:
    """Hourly trend per ward over the one-minute features (inner join).

    Pre-aggregated per (patient, hour): the averages of the rounded window
    averages are carried as exact decimal sums + counts, and the distinct
    patients are counted over one row each (a registry row that occurs twice
    does not count its patient twice).
    """
    hour = F.date_format("window_start", "yyyy-MM-dd HH:00")
    per_patient_hour = features.groupBy("patient_id", hour.alias("hour_utc")).agg(
        F.sum(F.col("avg_hr").cast("decimal(8,1)")).alias("s_hr"),
        F.count("avg_hr").alias("n_hr"),
        F.sum(F.col("avg_spo2").cast("decimal(8,2)")).alias("s_spo2"),
        F.count("avg_spo2").alias("n_spo2"),
        F.sum("abnormal_readings").alias("abnormal_readings"),
    )
    joined = per_patient_hour.join(patients.select("patient_id", "ward"), "patient_id")
    mean = lambda s, n: F.try_divide(F.sum(s).cast("double"), F.sum(n).cast("double"))
    return (joined.groupBy("ward", "hour_utc")
            .agg(F.count_distinct("patient_id").alias("patients"),
                 F.round(mean("s_hr", "n_hr"), 1).alias("avg_hr"),
                 F.round(mean("s_spo2", "n_spo2"), 2).alias("avg_spo2"),
                 F.sum("abnormal_readings").alias("abnormal_readings"))
            .orderBy("hour_utc", "ward"))


def q5_daily_summary(features: DataFrame, k: int = 10) -> DataFrame:
    """Per day and patient: lowest oxygen first, then highest peak heart rate."""
    daily = features.groupBy("event_date", "patient_id").agg(
        F.count(F.lit(1)).alias("minutes_monitored"),
        F.round(rules.exact_avg("avg_hr", 1), 1).alias("avg_hr"),
        F.max("max_hr").alias("peak_hr"),
        F.min("min_spo2").alias("lowest_spo2"),
        F.max("max_temp").alias("highest_temp"),
        F.sum("falls").alias("falls"),
    )
    return daily.orderBy(F.asc_nulls_last("lowest_spo2"), F.desc_nulls_last("peak_hr"),
                         "event_date", "patient_id").limit(k)


def q6_data_quality(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Raw messages vs clean de-duplicated readings (two scalars, no join)."""
    silver_n = silver.agg(F.count(F.lit(1))).scalar()
    return (bronze.agg(F.count(F.lit(1)).alias("bronze_messages"))
            .withColumn("silver_clean_readings", silver_n)
            .withColumn("dropped_or_pending",
                        F.col("bronze_messages") - F.col("silver_clean_readings")))


def level_rank():
    return (F.when(F.col("risk_level") == "High", 1)
            .when(F.col("risk_level") == "Medium", 2).otherwise(3))


def q7_risk_mix(patient_risk: DataFrame) -> DataFrame:
    """Patients per risk level, ordered High, Medium, other.

    The member list is :func:`q7_risk_members` (one row per patient), not one
    joined string per level: that string grows with the patient count and
    would be built in a single task.
    """
    return (patient_risk.groupBy("risk_level")
            .agg(F.count(F.lit(1)).alias("patients"))
            .withColumn("level_rank", level_rank())
            .orderBy("level_rank", "risk_level"))


def q7_risk_members(patient_risk: DataFrame) -> DataFrame:
    """Members of each risk level in level order, then patient id (a
    distributed sort)."""
    return (patient_risk.select("risk_level", "patient_id")
            .withColumn("level_rank", level_rank())
            .orderBy("level_rank", "risk_level", "patient_id"))


# --- layer checks -------------------------------------------------------------

def reconcile_layers(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze count minus the Silver rows up to Bronze's newest Kafka time.

    The layers commit on different triggers, so Silver can be ahead of
    Bronze; comparing up to the same Kafka time keeps the difference >= 0
    in steady state.  One aggregate gives Bronze's count and cutoff, as one
    scalar subquery that Spark runs once; Silver is read once.
    """
    raw = bronze.agg(F.struct(F.count(F.lit(1)).alias("n"),
                              F.max("kafka_time").alias("cutoff"))).scalar()
    return (silver.agg(F.count_if(F.col("kafka_time") <= raw["cutoff"]).alias("silver_up_to_cutoff"))
            .select(raw["n"].alias("bronze_messages"), raw["cutoff"].alias("cutoff"), "silver_up_to_cutoff",
                    (raw["n"] - F.col("silver_up_to_cutoff")).alias("dropped")))


def alert_matrix(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy("alert_type", "severity").agg(F.count(F.lit(1)).alias("alerts"))
            .orderBy("alert_type", "severity"))


def latest(df: DataFrame, time_col: str, tie: list[str], cols: list[str], n: int = 5) -> DataFrame:
    """Newest ``n`` rows by ``time_col`` with a unique tie-break (top-k, no
    global sort)."""
    return df.orderBy(F.desc(time_col), *[F.asc(c) for c in tie]).limit(n).select(*cols)


def latest_readings(silver: DataFrame, n: int = 5) -> DataFrame:
    return latest(silver, "event_time", ["patient_id"],
                  ["event_time", "patient_id", "heart_rate", "spo2", "systolic_bp",
                   "diastolic_bp", "body_temp", "steps", "fall_detected"], n)


def latest_alerts(alerts: DataFrame, n: int = 5) -> DataFrame:
    # a re-delivered reading repeats its alert_id; latency tells the copies apart
    return latest(alerts, "event_time", ["alert_id", "latency_sec"],
                  ["event_time", "patient_id", "alert_type", "severity", "message",
                   "latency_sec"], n)


def latest_windows(features: DataFrame, n: int = 5) -> DataFrame:
    return latest(features, "window_start", ["patient_id"],
                  ["window_start", "patient_id", "readings", "avg_hr", "avg_spo2", "avg_sys",
                   "avg_dia", "avg_temp", "abnormal_readings"], n)
