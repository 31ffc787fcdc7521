"""Quality profile: the invariants the monitored system's tests assert,
as queries over the whole stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..sources.lens import profile_of


def invalid_share(parsed: DataFrame) -> DataFrame:
    """Rejected readings / all messages (a null flag counts as invalid)."""
    return (parsed.agg(F.count(F.lit(1)).alias("messages"),
                       F.count_if(~rules.valid_reading()).alias("invalid"))
            .withColumn("share", F.try_divide(F.col("invalid").cast("double"),
                                              F.col("messages").cast("double"))))


def alert_share(clean: DataFrame) -> DataFrame:
    """Valid readings with at least one alert / valid readings, and the number
    of readings that fire each rule (duplicates included, as the alert
    stream sees them)."""
    return (clean.agg(
                F.count(F.lit(1)).alias("valid_readings"),
                F.count_if(rules.abnormal_reading()).alias("with_alert"),
                *[F.count_if(rules.fires(rule)).alias(rule.kind.lower()) for rule in rules.RULES])
            .withColumn("share", F.try_divide(F.col("with_alert").cast("double"),
                                              F.col("valid_readings").cast("double"))))


def label_agreement(labelled: DataFrame) -> DataFrame:
    """Share of one-minute windows per hidden cohort whose rule label is the
    cohort's expected level (low 0, medium 1, high 2)."""
    profile = profile_of(F.col("patient_id"))
    expected = F.when(profile == "low", 0.0).when(profile == "medium", 1.0).otherwise(2.0)
    return (labelled.groupBy(profile.alias("profile"))
            .agg(F.count(F.lit(1)).alias("windows"),
                 F.count_if(F.col("label") == expected).alias("agreeing"))
            .withColumn("share", F.try_divide(F.col("agreeing").cast("double"),
                                              F.col("windows").cast("double"))))
