"""Patient risk from scored one-minute windows: last-N windows, majority vote,
summary, level naming, per-patient cluster features and risk counts.

The functions take *scored* windows: one-minute features plus ``label`` /
``rule_points`` and a ``prediction`` and ``window_score`` column.  The rule
variant (:func:`rule_scored`) scores windows by their early-warning label; the
model variant (``ml.score_windows``) by a decision tree.  Everything after
scoring is the same code.

Shuffle plan: ``recent`` hash-partitions by ``patient_id`` once (the window
group limit trims each patient to N rows map-side first); the vote and the
summary aggregate on the same key and reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules

RECENT_WINDOWS = 5


def rule_scored(labelled: DataFrame) -> DataFrame:
    """Score = the rule label itself: prediction = label, score 0/50/100."""
    return (labelled.withColumn("prediction", F.col("label"))
                    .withColumn("window_score", F.col("label") * 50.0))


def label_distribution(labelled: DataFrame) -> DataFrame:
    return (labelled.groupBy("label").agg(F.count(F.lit(1)).alias("windows"))
            .select(rules.level_name("label").alias("risk_level"), "windows"))


def recent(scored: DataFrame, n: int = RECENT_WINDOWS) -> DataFrame:
    """Each patient's last ``n`` windows (``row_number`` <= n by start desc).

    Spark plans this as a partial WindowGroupLimit before the shuffle, so a
    patient with millions of windows sends at most n rows per map task.
    """
    newest_first = Window.partitionBy("patient_id").orderBy(F.col("window_start").desc())
    return (scored.withColumn("rn", F.row_number().over(newest_first))
                  .filter(F.col("rn") <= n))


def vote(recent_df: DataFrame) -> DataFrame:
    """Majority prediction per patient; a tie goes to the higher risk.

    Two hash aggregations instead of a second sort-based window: count per
    (patient, prediction), then the largest of votes and prediction packed into
    one number (a struct would make Spark sort).
    """
    counts = recent_df.groupBy("patient_id", "prediction").agg(F.count(F.lit(1)).alias("votes"))
    levels = len(rules.RISK_LEVELS)
    packed = F.col("votes") * levels + F.col("prediction").cast("bigint")
    return (counts.groupBy("patient_id").agg(F.max(packed).alias("best"))
            .select("patient_id", (F.col("best") % levels).cast("double").alias("risk_label"),
                    F.expr(f"best div {levels}").alias("votes")))


#: Window averages that a patient's summary averages again, with their decimals.
AVERAGED = {"avg_hr": 1, "avg_spo2": 2, "avg_sys": 1, "avg_dia": 1, "avg_temp": 2}


def summary(recent_df: DataFrame) -> DataFrame:
    """One row a patient over the given windows: how many, until when, their mean
    score and vitals, and the most rule points of any."""
    vitals = [F.round(rules.exact_avg(c, digits), digits).alias(c) for c, digits in AVERAGED.items()]
    return recent_df.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("windows_used"), F.max("window_end").alias("last_window_end"),
        F.max("rule_points").alias("max_rule_points"),
        F.round(F.avg("window_score"), 1).alias("risk_score"), *vitals)


def patient_risk(scored: DataFrame, n: int = RECENT_WINDOWS) -> DataFrame:
    """Vote and summary of the last ``n`` windows joined per patient."""
    r = recent(scored, n)
    return (summary(r).join(vote(r).select("patient_id", "risk_label"), "patient_id")
            .withColumn("risk_level", rules.level_name("risk_label")))


PATIENT_RISK_COLUMNS = ["patient_id", "risk_level", "risk_score", "avg_hr", "avg_spo2",
                        "avg_sys", "avg_dia", "avg_temp", "max_rule_points", "windows_used",
                        "last_window_end"]


def cluster_features(labelled: DataFrame) -> DataFrame:
    """Per patient over all windows: mean vitals and abnormal-reading rate."""
    return labelled.groupBy("patient_id").agg(
        rules.exact_avg("avg_hr", 1).alias("c_hr"),
        rules.exact_avg("avg_spo2", 2).alias("c_spo2"),
        rules.exact_avg("avg_sys", 1).alias("c_sys"),
        rules.exact_avg("avg_temp", 2).alias("c_temp"),
        F.try_divide(F.sum("abnormal_readings").cast("double"),
                     F.sum("readings").cast("double")).alias("c_abnormal_rate"),
    )


def risk_counts(patient_risk_df: DataFrame) -> DataFrame:
    return patient_risk_df.groupBy("risk_level").agg(F.count(F.lit(1)).alias("patients"))
