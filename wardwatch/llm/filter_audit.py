"""Filter interaction audit: what each of five filters removes, in every order.

A stream reads the documents' files in available-now micro-batches.  Four of
the filters look at a text alone and are Spark expressions; the fifth, identical to
the text of a smaller doc_id, depends on documents that may come later.  Each text (by its
SHA-256) therefore keeps its smallest doc_id so far in the state store; about TEXTS
of them, by their hash, share a key of the store, so that one call of Python serves them all.  A
document is counted at once as if its id were the smallest; when a smaller one
is known or arrives, the earlier count is retracted and made anew with the
fifth filter failing.  Each task sums its counts up, and of a text sends on only its
smallest id, so a text that a third of all documents share is one row a task.

What is left of the stream are counts by part and mask (the set of filters that
fail, as bits); every order and step follows from these at most 32 counts a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import scratch
from .common import map_arrow, ship, stored

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
BATCHES = 4                    # micro-batches that the files are dealt over, about
PENDING = 1 << 18              # rows that a task sums up at once
TEXTS = 1_024                  # texts that share a key of the state store, about

COUNTS = "part string, mask int, n long, good long, toxic long"
ROW = f"bucket long, digest binary, id long, {COUNTS}"
STATE = "texts binary"         # an Arrow stream of KEPT
SUMS = ["n", "good", "toxic"]
KEPT = ["digest", "id", "part", "mask"]


def failures(text: Column) -> Column:
    """Bits of the filters A to D that ``text`` (not null) fails: under 200 words;
    under half of them distinct; over 3 % capitals; a mark of markup or code."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = [F.size(words) < 200, 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
             100 * capitals > 3 * F.length(text), text.rlike("[#$%&*|]")]
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def _summed(df: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    return df.groupby(keys, sort=False, dropna=False)[SUMS].sum().reset_index()


def _packed(df: pd.DataFrame, buckets: int) -> Iterator[pa.RecordBatch]:
    """Counts of the rows, each as its task sees it (without digest), and the smallest id of
    each text with its own counts."""
    schema = pa.schema([("bucket", pa.int64()), ("digest", pa.binary()), ("id", pa.int64()), ("part", pa.string()),
                        ("mask", pa.int32()), ("n", pa.int64()), ("good", pa.int64()), ("toxic", pa.int64())])
    least = df.groupby("digest", sort=False)["id"].transform("min")
    first = df["id"].notna() & (df["id"] == least)
    later = df["id"].notna() & ~first
    known = df.assign(mask=np.where(later, df["mask"] | COPY, df["mask"]))
    firsts = _summed(df[first], KEPT)
    firsts["bucket"] = [int.from_bytes(d[:8], "big") % buckets for d in firsts["digest"]]
    counts = _summed(known, ["part", "mask"]).assign(digest=None, id=None)
    counts["bucket"] = int.from_bytes(df["digest"].iloc[0][:8], "big") % buckets      # any: they only pass
    for made in (counts, firsts):
        yield pa.RecordBatch.from_pandas(made[schema.names], schema=schema, preserve_index=False)


def _pack(batches, buckets: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= PENDING:
            yield from _packed(pa.Table.from_batches(held).to_pandas(types_mapper=_ids), buckets)
            held, n = [], 0
    if held:
        yield from _packed(pa.Table.from_batches(held).to_pandas(types_mapper=_ids), buckets)


def _ids(kind: pa.DataType):
    return pd.Int64Dtype() if kind == pa.int64() else None


def _combine(batches) -> Iterator[pa.RecordBatch]:
    """Counts of a task, summed up."""
    held = [b for b in batches if b.num_rows]
    if held:
        done = pa.Table.from_batches(held).group_by(["part", "mask"]).aggregate([(c, "sum") for c in SUMS])
        done = done.select(["part", "mask", *(f"{c}_sum" for c in SUMS)]).rename_columns(["part", "mask", *SUMS])
        yield from done.combine_chunks().to_batches()


def settle(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counts pass on.  Of a text's ids the smallest is kept; what was counted for
    any other as if it were smallest is retracted and counted as a copy."""
    new = pd.concat(list(frames), ignore_index=True)
    counts, rows = new[new["digest"].isna()], new[new["digest"].notna()]
    rows = rows.assign(id=rows["id"].astype("int64"))[[*KEPT, *SUMS]]
    if state.exists:
        rows = pd.concat([pa.ipc.open_stream(state.get[0]).read_pandas(), rows], ignore_index=True)
    stays = rows["id"] == rows.groupby("digest", sort=False)["id"].transform("min")
    wrong = rows[~stays]
    changes = pd.concat([counts, wrong.assign(**{c: -wrong[c] for c in SUMS}), wrong.assign(mask=wrong["mask"] | COPY)])
    if len(rows):
        held = pa.Table.from_pandas(_summed(rows[stays], KEPT), preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held.schema) as out:
            out.write_table(held)
        state.update((sink.getvalue().to_pybytes(),))
    if len(changes):
        yield _summed(changes, ["part", "mask"])


def mask_counts(spark: SparkSession, path: str, labels: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """(part, mask, n, good, toxic) of the documents in the Parquet files at
    ``path``, by one run of the stream."""
    read = spark.read.parquet(path)
    buckets = max(1, -(-read.count() // TEXTS))
    files = read.inputFiles()
    if len(files) == 1 and files[0].split("/")[-1] == path.split("/")[-1]:
        path = f"{path[:-1]}[{path[-1]}]"              # a stream takes one file by a pattern only
    files = files_per_batch or max(1, -(-len(files) // BATCHES))
    flags = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic")))
    flags = stored(flags.filter("good + toxic > 0"), "flags")
    root = scratch(spark, "filter-audit")
    text = F.coalesce("text", F.lit(""))
    docs = (spark.readStream.schema(read.schema).option("maxFilesPerTrigger", files).option("maxFileAge", "36500d")
            .parquet(path)
            .select(F.unhex(F.sha2(text, 256)).alias("digest"), F.col("doc_id").cast("long").alias("id"),
                    F.coalesce("lang", F.lit("")).alias("part"), failures(text).alias("mask")))
    marked = docs.join(flags, "id", "left").select(
        "digest", "id", "part", "mask", F.lit(1).cast("long").alias("n"),
        F.coalesce("good", F.lit(0)).cast("long").alias("good"), F.coalesce("toxic", F.lit(0)).cast("long").alias("toxic"))
    ship(spark)
    changes = (map_arrow(marked, partial(_pack, buckets=buckets), ROW).groupBy("bucket")
               .applyInPandasWithState(settle, COUNTS, STATE, "append", GroupStateTimeout.NoTimeout))
    query = (map_arrow(changes, _combine, COUNTS).writeStream.format("parquet").outputMode("append")
             .option("path", f"{root}/counts").option("checkpointLocation", f"{root}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return (spark.read.schema(COUNTS).parquet(f"{root}/counts").groupBy("part", "mask")
            .agg(*[F.sum(c).alias(c) for c in SUMS]))


def interactions(counts: DataFrame) -> DataFrame:
    """Every order and step from ``counts`` (part, mask, n, good, toxic)."""
    entry = F.map_from_entries(F.collect_list(F.struct("mask", F.struct(*SUMS))))
    every = f"sequence(0, {(1 << len(FILTERS)) - 1})"
    tables = [F.expr(f"transform({every}, m -> coalesce(try_element_at(held, m).{c}, 0L))").alias(c) for c in SUMS]
    steps = (counts.groupBy("part").agg(entry.alias("held")).select("part", *tables)
             .select("*", F.explode(F.split(F.lit(" ".join(ORDERS)), " ")).alias("filter_order"))
             .select("*", F.explode(F.expr(f"sequence(1, {len(FILTERS)})")).alias("step"))
             .withColumn("own", F.expr("shiftleft(1, ascii(substr(filter_order, step, 1)) - 65)"))
             .withColumn("before", F.expr(
                 f"aggregate(sequence(1, {len(FILTERS)}), 0, (a, i) -> if(i < step, "
                 "a | shiftleft(1, ascii(substr(filter_order, i, 1)) - 65), a))")))

    def total(column: str, condition: str, weight: str = "1") -> Column:
        return F.expr(f"aggregate({every}, 0L, (a, m) -> a + if({condition}, element_at({column}, m + 1) * {weight}, 0L))")

    here = "(m & own) != 0 and (m & before) = 0"
    return steps.select(
        "part", "filter_order", "step", total("n", "(m & (own | before)) = 0").alias("kept"),
        total("n", here).alias("removed"), total("n", "(m & own) != 0 and (m & before) != 0").alias("redundant"),
        total("n", "m = own").alias("unique_fails"), total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
        # of the orders, one in as many as filters fail has this one first
        total("n", "(m & own) != 0", f"({len(ORDERS)} div bit_count(m))").alias("shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """One row per part (lang; null: empty), filter_order and step, zeros included:
    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``path`` holds Parquet files with doc_id, text and lang; ``labels`` has doc_id,
    quality and toxic (a document is good, or toxic, if any of its rows says 1).  A null
    text is empty.  A row without doc_id is a copy of none, and makes none a
    copy; rows that share doc_id and text are no copies of one another.  Columns
    beyond these are not read.  No documents: no rows.  ``files_per_batch`` files
    are a micro-batch; by default the files make about BATCHES of them.  The state
    is kept by the session's provider (RocksDB for more texts than executors hold in memory).
    """
    return interactions(mask_counts(spark, path, labels, files_per_batch))
