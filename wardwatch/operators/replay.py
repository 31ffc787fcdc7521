"""Recording and replay of the lake: stream-hole segmentation, the longest
unbroken stretch, its trailing slice, the alerts inside it, and the replay
clock shift.

Gap segmentation needs the global time order, which a plain ``lag`` over an
unpartitioned window would pull into one task.  Instead:

1. Bucket times by the gap ``g``: two consecutive readings in one bucket are
   less than ``g`` apart, so a bucket never contains a break.  The bucket
   table has at most span / g rows whatever the number of readings.
2. A bucket starts a segment iff the bucket before it is empty (then the
   gap is > g) or its first time minus the previous bucket's last time is
   > g - an equi-join of the bucket table with itself shifted by one.
3. Segment numbers are a prefix count of starts: per block of ``block``
   buckets a start count, a running sum over the (span / g / block)-row
   block table, then a running count within each block (window partitioned
   by block).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch

GAP_SECONDS = 20
TRAIL_MINUTES = 30


def recording(silver: DataFrame, col: str = "event_time") -> Column:
    """The recording's clock as a scalar struct: ``lo``, its first time, and ``len``,
    its span + 1 s, in integer microseconds.  Every layer replayed together takes
    the one of Silver, or an alert would not play with its reading."""
    us = F.unix_micros(col)
    return silver.agg(F.struct(F.min(us).alias("lo"),
                               (F.max(us) - F.min(us) + F.lit(1_000_000)).alias("len"))).scalar()


def replay_shift(df: DataFrame, now: Column, clock: Column | None = None,
                 col: str = "event_time") -> DataFrame:
    """Move a recording onto a clock that loops it: each row gets the time it
    was last played at ``now``, position = now mod length.  ``clock`` is the
    :func:`recording` it belongs to (by default its own).  Integer microseconds;
    ``pmod`` keeps the result in (now - length, now]."""
    clock = recording(df, col) if clock is None else clock
    now_us = F.unix_micros(now)
    behind = F.pmod(F.pmod(now_us, clock["len"]) - (F.unix_micros(col) - clock["lo"]), clock["len"])
    return df.withColumn("replay_time", F.timestamp_micros(now_us - behind))


def gap_segments(df: DataFrame, gap_ms: int = GAP_SECONDS * 1000, col: str = "event_time",
                 block: int | None = None) -> DataFrame:
    """Segments of ``col`` split where consecutive times are more than
    ``gap_ms`` apart (equal gaps stay together): segment number (1-based,
    time order), first and last time, rows, duration in seconds.

    ``df`` is read once: the bucket table, at most span / gap rows, is written and
    the rest works on it.  ``block`` defaults to the root of the buckets' range, so
    the one globally ordered step and the largest block both grow with the root
    of span / gap.
    """
    g = int(gap_ms) * 1000
    t = df.select(F.unix_micros(col).alias("t")).filter(F.col("t").isNotNull())
    path = scratch(df.sparkSession, "buckets") + "/t"
    (t.groupBy(F.expr(f"t div {g}").alias("b"))
      .agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.count(F.lit(1)).alias("n"))
      .write.parquet(path))
    buckets = df.sparkSession.read.schema("b bigint, lo bigint, hi bigint, n bigint").parquet(path)
    if block is None:
        first, last = buckets.agg(F.min("b"), F.max("b")).first()
        block = max(4096, math.isqrt((last or 0) - (first or 0)))
    before = buckets.select((F.col("b") + 1).alias("b"), F.col("hi").alias("prev_hi"))
    flagged = (buckets.join(before, "b", "left")
               .withColumn("start", (F.col("prev_hi").isNull()
                                     | (F.col("lo") - F.col("prev_hi") > g)).cast("int"))
               .withColumn("blk", F.expr(f"b div {block}")))
    per_block = flagged.groupBy("blk").agg(F.sum("start").alias("starts"))
    # one row a block: the only globally ordered step
    offsets = per_block.withColumn(
        "before", F.sum("starts").over(Window.orderBy("blk")) - F.col("starts")).drop("starts")
    in_block = Window.partitionBy("blk").orderBy("b")
    numbered = (flagged.join(offsets, "blk")
                .withColumn("segment", F.col("before") + F.sum("start").over(in_block)))
    return (numbered.groupBy("segment")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("readings"))
            .select("segment",
                    F.timestamp_micros("lo").alias("seg_start"),
                    F.timestamp_micros("hi").alias("seg_end"),
                    "readings",
                    ((F.col("hi") - F.col("lo")) / 1e6).alias("duration_sec")))


def longest_segment(segments: DataFrame) -> DataFrame:
    """The longest segment; the earliest wins a tie."""
    return segments.orderBy(F.desc("duration_sec"), "seg_start").limit(1)


def replay_bounds(longest: DataFrame, trail_minutes: float = TRAIL_MINUTES) -> tuple[Column, Column]:
    """(from, to) of the trailing ``trail_minutes`` of the longest segment."""
    trail_us = int(trail_minutes * 60_000_000)
    b = longest.agg(F.struct(F.max("seg_start").alias("lo"),
                             F.max("seg_end").alias("hi"))).scalar()
    start = F.greatest(b["lo"], F.timestamp_micros(F.unix_micros(b["hi"]) - F.lit(trail_us)))
    return start, b["hi"]


def replay_slice(silver: DataFrame, longest: DataFrame,
                 trail_minutes: float = TRAIL_MINUTES) -> DataFrame:
    """Silver rows of the trailing part of the longest segment (all patients)."""
    start, end = replay_bounds(longest, trail_minutes)
    return (silver.filter((F.col("event_time") >= start) & (F.col("event_time") <= end))
            .drop("event_date"))


def replay_alerts(alerts: DataFrame, longest: DataFrame,
                  trail_minutes: float = TRAIL_MINUTES) -> DataFrame:
    """Alerts within the trailing part of the longest segment.  An alert has the
    time of a clean reading, so the slice's own bounds would cut the same rows;
    these need no pass over the slice."""
    start, end = replay_bounds(longest, trail_minutes)
    return (alerts.filter((F.col("event_time") >= start) & (F.col("event_time") <= end))
            .drop("event_date"))


def export_bundle(silver: DataFrame, alerts: DataFrame, patient_risk: DataFrame, patients: DataFrame,
                  metrics: DataFrame, layers: DataFrame, out: str,
                  gap_ms: int = GAP_SECONDS * 1000,
                  trail_minutes: float = TRAIL_MINUTES) -> dict[str, str]:
    """Write a replay bundle below ``out`` and return its paths: as Parquet the
    trailing slice of the longest unbroken stretch of Silver, the alerts inside
    it, the current risk table (``event_date`` dropped) and the registry; as JSON
    the model metrics and the recording, i.e. its first and last time and the
    inventory of the layers it was taken from (``layers``, see lake.inventory)."""
    longest = longest_segment(gap_segments(silver, gap_ms))
    paths = {name: f"{out}/{name}" for name in ("vitals", "alerts", "patient_risk", "patients",
                                                "model_metrics", "recording")}

    def write(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(paths[name])
        return silver.sparkSession.read.parquet(paths[name])

    vitals = write(replay_slice(silver, longest, trail_minutes), "vitals")
    write(replay_alerts(alerts, longest, trail_minutes), "alerts")
    write(patient_risk.drop("event_date"), "patient_risk")
    write(patients, "patients")
    metrics.coalesce(1).write.mode("overwrite").json(paths["model_metrics"])       # one row
    (vitals.agg(F.min("event_time").alias("recorded_from"), F.max("event_time").alias("recorded_to"))
     .join(layers.agg(F.collect_list(F.struct(*layers.columns)).alias("layers")))  # one row a layer
     .coalesce(1).write.mode("overwrite").json(paths["recording"]))
    return paths


def commit_bundle(silver: DataFrame, alerts: DataFrame, patient_risk: DataFrame, patients: DataFrame,
                  layers: DataFrame, log, gap_ms: int = GAP_SECONDS * 1000,
                  trail_minutes: float = TRAIL_MINUTES) -> int:
    """The bundle as one version of a commit log (``sources.commits``): a reader sees
    all parts of one export, and of two exports at once one fails with a conflict."""
    from ..sources.commits import Change
    base, longest = log.version(), longest_segment(gap_segments(silver, gap_ms))
    return log.commit({
        "vitals": Change(replay_slice(silver, longest, trail_minutes), "event_time"),
        "alerts": Change(replay_alerts(alerts, longest, trail_minutes), "event_time"),
        "patient_risk": Change(patient_risk.drop("event_date")), "patients": Change(patients),
        "recording": Change(layers)}, base)
