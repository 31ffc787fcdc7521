"""Patient risk kept up to date: each patient's last windows as keyed state.

A batch of new one-minute windows touches only the state of the patients in it,
which holds their last few windows and nothing older, so the work of a batch does not
grow with history.  What a batch emits is each touched patient's last windows
with a revision; readers take the newest one, and vote, summary and naming are the
batch code's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.schema import FEATURE_SCHEMA
from ..operators import features, risk
from ..session import ship

BUCKETS = 256                  # keys of the state; size it for the patients, a few thousand each
STATE = "held binary, revision long"


def _keep(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, n: int) -> Iterator[pd.DataFrame]:
    """A bucket's patients: their last ``n`` windows are kept, and passed on if they changed."""
    new = pd.concat(list(frames), ignore_index=True).drop(columns="bucket")
    revision = 1
    rows = new.assign(new=True)
    if state.exists:
        packed, revision = state.get
        held = pa.ipc.open_stream(packed).read_pandas().astype(new.dtypes.to_dict())
        rows, revision = pd.concat([held.assign(new=False), rows], ignore_index=True), revision + 1
    last = (rows.drop_duplicates(["patient_id", "window_start"])       # a window delivered again is the same
            .sort_values(["patient_id", "window_start"], ascending=[True, False]))
    last = last[last.groupby("patient_id").cumcount() < n]
    touched = last[last.groupby("patient_id")["new"].transform("any")].drop(columns="new")
    if not len(touched):
        return
    t = pa.Table.from_pandas(last.drop(columns="new"), preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as out:
        out.write_table(t)
    state.update((sink.getvalue().to_pybytes(), revision))
    yield touched.assign(revision=revision)


def last_windows(scored: DataFrame, n: int = risk.RECENT_WINDOWS, buckets: int = BUCKETS) -> DataFrame:
    """Stream of scored windows -> stream of (last ``n`` windows of each patient that a batch
    touched, revision)."""
    ship(scored.sparkSession)
    columns = ["patient_id", "window_start", "window_end", "rule_points", "prediction", "window_score", *risk.AVERAGED]
    rows = scored.select(F.pmod(F.xxhash64("patient_id"), F.lit(buckets)).cast("int").alias("bucket"), *columns)
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:]) + ", revision long"
    return rows.groupBy("bucket").applyInPandasWithState(
        partial(_keep, n=n), out, STATE, "append", GroupStateTimeout.NoTimeout)


def run_bounded(spark: SparkSession, layer: str, out: str, checkpoint: str, files_per_batch: int | None = None,
                buckets: int = BUCKETS) -> None:
    """Bring ``out`` up to the one-minute layer at ``layer`` (a folder that a stream writes), and stop."""
    reader = spark.readStream.schema(FEATURE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    windows = features.labelled(features.complete(reader.parquet(layer)))
    query = (last_windows(risk.rule_scored(windows), buckets=buckets).writeStream.queryName("patient_windows")
             .format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()


def patient_risk(spark: SparkSession, out: str) -> DataFrame:
    """The risk table from the newest revision of each patient's windows."""
    every = spark.read.parquet(out)
    newest = Window.partitionBy("patient_id").orderBy(F.desc("revision"))
    current = every.withColumn("place", F.rank().over(newest)).filter("place = 1").drop("place", "revision")
    return risk.patient_risk(current)
