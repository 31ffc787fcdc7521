"""Roll-ups that keep distinct counts mergeable: one bitmap of patients a minute.

Counts of distinct patients do not add up over minutes; bitmaps do.  A roll-up
holds, for each minute and group, bitmaps of the patients' numbers (32,768 numbers a
bucket) beside plain sums; reports over hours, days or all time merge its rows and read
no event again.  Numbers are exact, so are the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules

MICROS = 60_000_000


def patient_number(patient_id: str = "patient_id") -> Column:
    """The number in an id like P-000123 (other ids: number the registry and join it)."""
    return F.substring(patient_id, 3, 30).cast("bigint")


def minute(time: str) -> Column:
    at = F.unix_micros(time)
    return F.timestamp_micros(at - F.pmod(at, F.lit(MICROS)))


def per_minute(df: DataFrame, time: str, keys: list[str], number: Column | None = None,
               **sums: Column) -> DataFrame:
    """(minute, *keys, bucket, seen, rows, **sums): the roll-up."""
    number = patient_number() if number is None else number
    return (df.withColumns({"minute": minute(time), "__n": number})
            .groupBy("minute", *keys, F.bitmap_bucket_number("__n").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__n")).alias("seen"), F.count(F.lit(1)).alias("rows"),
                 *[F.sum(c).alias(name) for name, c in sums.items()]))


def merged(rolled: DataFrame, keys: list[Column | str], patients: str = "patients", rows: str = "rows",
           sums: tuple[str, ...] = ()) -> DataFrame:
    """Roll-up rows merged by ``keys``: distinct patients, rows and sums."""
    names = [f"__k{i}" for i in range(len(keys))]
    keyed = rolled.select(*[(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, names, strict=True)],
                          "bucket", "seen", "rows", *sums)
    # one bitmap a bucket and group, merged map-side: a group's rows never meet in one task
    buckets = keyed.groupBy(*names, "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("seen")).alias("__seen"), F.sum("rows").alias("__rows"),
        *[F.sum(s).alias(s) for s in sums])
    return buckets.groupBy(*names).agg(F.sum("__seen").alias(patients), F.sum("__rows").alias(rows),
                                       *[F.sum(s).alias(s) for s in sums])


def exact(column: str, decimals: int) -> Column:
    return F.col(column).cast(f"decimal(18,{decimals})")


def alerts_per_minute(alerts: DataFrame) -> DataFrame:
    return per_minute(alerts, "event_time", ["alert_type", "severity"], latency=exact("latency_sec", 2))


def alert_counts(rolled: DataFrame) -> DataFrame:
    """As ``reports.q2_alert_counts``, from the alert roll-up."""
    return (merged(rolled, ["alert_type", "severity"], "patients_affected", "alerts", ("latency",))
            .select(F.col("__k0").alias("alert_type"), F.col("__k1").alias("severity"), "alerts", "patients_affected",
                    F.round(F.col("latency").cast("double") / F.col("alerts"), 2).alias("avg_latency_sec"))
            .orderBy(F.desc("alerts"), "alert_type", "severity"))


def windows_per_minute(features: DataFrame, patients: DataFrame) -> DataFrame:
    """By ward: the registry is joined once, as the roll-up is made."""
    return per_minute(features.join(patients.select("patient_id", "ward"), "patient_id"), "window_start", ["ward"],
                      hr=exact("avg_hr", 1), spo2=exact("avg_spo2", 2), abnormal=F.col("abnormal_readings"))


def ward_hourly(rolled: DataFrame) -> DataFrame:
    """As ``reports.q4_ward_hourly``, from the ward roll-up."""
    hour = F.date_format("minute", "yyyy-MM-dd HH:00")
    mean = {c: F.round(F.col(c).cast("double") / F.col("rows"), digits) for c, digits in (("hr", 1), ("spo2", 2))}
    return (merged(rolled, ["ward", hour], sums=("hr", "spo2", "abnormal"))
            .select(F.col("__k0").alias("ward"), F.col("__k1").alias("hour_utc"), "patients", mean["hr"].alias("avg_hr"),
                    mean["spo2"].alias("avg_spo2"), F.col("abnormal").alias("abnormal_readings"))
            .orderBy("hour_utc", "ward"))


def active_patients(rolled: DataFrame) -> DataFrame:
    """Patients heard from and readings by minute, hour and day, and over all time, from one roll-up."""
    out = None
    for grain in ("minute", "hour", "day", "all"):
        start = F.date_trunc(grain, "minute") if grain != "all" else F.lit(None).cast("timestamp")
        one = merged(rolled, [start], rows="readings").select(
            F.lit(grain).alias("grain"), F.col("__k0").alias("start"), F.col("patients").alias("active_patients"), "readings")
        out = one if out is None else out.unionByName(one)
    return out
