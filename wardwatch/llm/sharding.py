"""Sharding by a hierarchical weighted hash tree.

Regions hold racks, racks hold shards.  A document descends the tree: at each
level every child draws -ln(u) / weight with u hashed from (doc_id, child), and
the smallest draw wins, so a child gets rows in proportion to its weight and a
changed weight moves rows only between that child and its siblings.  A shard
added in a region of its own therefore takes rows only into itself.

DataFrame functions only; the text is read once, for its size and checksum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_bytes

ROWS_PER_RUN = 100_000         # rows that one slot run holds on average

#: region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]

EIGHT: Tree = {"r0": {"r0k0": {0: 1.0, 1: 1.0}, "r0k1": {2: 1.0, 3: 1.0}},
               "r1": {"r1k0": {4: 1.0, 5: 1.0}, "r1k1": {6: 1.0, 7: 1.0}}}
NINE: Tree = EIGHT | {"r2": {"r2k0": {8: 1.0}}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _draw(key: Column, child: str, weight: float) -> Column:
    """-ln(u) / weight, u in (0, 1] from 53 bits of the hash of key and child."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(child)), 11)
    return -F.log((bits + 1) / F.lit(float(1 << 53))) / weight


def _descend(key: Column, node: dict, path: str) -> Column:
    """The shard that ``key`` reaches below ``node``; equal draws go to the child
    named first."""
    children = [(str(name), child) for name, child in node.items() if _weight(child) > 0]
    below = [_descend(key, child, f"{path}/{name}") if isinstance(child, dict)
             else F.lit(int(name)) for name, child in children]
    if len(children) == 1:
        return below[0]
    draws = [_draw(key, f"{path}/{name}", _weight(child)) for name, child in children]
    least = F.least(*draws)
    out = below[-1]
    for draw, shard in list(zip(draws, below, strict=True))[-2::-1]:
        out = F.when(draw == least, shard).otherwise(out)
    return out


def shard_of(key: Column, tree: Tree) -> Column:
    """Shard number of ``key`` under ``tree``; it depends on nothing else."""
    if _weight(tree) <= 0:
        raise ValueError("a tree needs a shard of positive weight")
    return _descend(key, tree, "").cast("int")


def place(docs: DataFrame, tree: Tree = EIGHT, grown: Tree | None = NINE,
          rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """doc_id, size, text_crc32, law ('key'), shard, slot, grown_shard: one row a
    document.

    size is the text's UTF-8 bytes plus 1 and a null text counts as empty.  Rows
    with the same doc_id, a missing one included, share a shard.  slot numbers
    each shard's rows from 0 without gaps: rows are hashed into runs over
    id, size, checksum and the row's own number, runs are numbered by their counts, rows within
    them by a window, so no task holds a shard, nor all of many equal rows.  Equal rows get slots in any order.
    Other columns of ``docs`` are left out; no rows: no rows.
    """
    key = F.col("doc_id").cast("long")
    text = text_bytes()
    read = docs.select(key.alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    placed = read.select(
        "*", F.lit("key").alias("law"), shard_of(F.col("doc_id"), tree).alias("shard"),
        (shard_of(F.col("doc_id"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    placed = cut(placed.withColumn("row", F.monotonically_increasing_id()))    # fixed as it is written
    runs = max(8, placed.count() // rows_per_run)
    run = F.pmod(F.xxhash64("doc_id", "size", "text_crc32", "row"), F.lit(runs))
    placed = placed.withColumn("run", run)
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("run")
                             .rowsBetween(Window.unboundedPreceding, -1))
    starts = (placed.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("n"))
              .select("shard", "run", F.coalesce(before, F.lit(0)).alias("start")))
    within = F.row_number().over(Window.partitionBy("shard", "run")
                                 .orderBy("doc_id", "size", "text_crc32"))
    return (placed.withColumn("at", within - 1).join(starts, ["shard", "run"])
            .select("doc_id", "size", "text_crc32", "law", "shard",
                    (F.col("start") + F.col("at")).cast("long").alias("slot"), "grown_shard"))
