"""Shared helpers of the operators: table access, lineage cuts, Arrow slices."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch, shared_dir

SLICE_BYTES = 1 << 20          # text bytes that one numpy step works on


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder that the cluster shares and go on
    from there: later jobs neither recompute it nor depend on one executor."""
    shared_dir(df.sparkSession)
    _ends_with_driver(df.sparkSession.sparkContext)
    return df.checkpoint()


def _ends_with_driver(sc) -> None:
    """The context's own checkpoint folder is removed as the driver ends."""
    if getattr(sc, "_checkpoints_end", None) != sc.getCheckpointDir():
        folder = sc._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(folder)
        sc._checkpoints_end = sc.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table of the shared folder and read back, with its size
    known to the planner."""
    path = scratch(df.sparkSession, name) + "/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    bundle = Path(tempfile.mkdtemp(prefix="ship-")) / "wardwatch_llm.zip"
    with zipfile.ZipFile(bundle, "w") as z:
        for file in sorted((root / "wardwatch").rglob("*.py")):
            z.write(file, file.relative_to(root))
    sc.addPyFile(str(bundle))
    sc._llm_shipped = True


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def group_arrow(df: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    """``applyInArrow`` of ``fn`` (table -> table) on each group of ``keys``.  The
    call is wrapped because Spark reads type hints, which partials lack."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(lambda group: fn(group), schema)


def group_pandas(df: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    """``applyInPandas`` of ``fn`` (frame -> frame) on each group of ``keys``."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInPandas(lambda group: fn(group), schema)


def cogroup_arrow(left: DataFrame, right: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    """``applyInArrow`` of ``fn`` (table, table -> table) on both sides' groups."""
    ship(left.sparkSession)
    return (left.groupBy(*keys).cogroup(right.groupBy(*keys))
            .applyInArrow(lambda mine, other: fn(mine, other), schema))


def collected(df: DataFrame) -> dict[str, np.ndarray]:
    """A small frame's columns on the driver (as Arrow: no object for each row)."""
    table = df.toArrow()
    return {name: table.column(name).to_numpy() for name in table.column_names}


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit("").cast("binary"))


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id's decimal text modulo ``folds`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def slices(batches: Iterator[pa.RecordBatch], column: str,
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``max_bytes`` of ``column``
    (one row at least, so a longer value comes alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // max_bytes
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for lo, hi in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
            yield batch.slice(int(lo), int(hi - lo))


def sum_rows(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` rows between consecutive ``offsets`` (empty spans: 0)."""
    if values.ndim == 1:
        total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
        return total[offsets[1:]] - total[offsets[:-1]]
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0)
    return out
