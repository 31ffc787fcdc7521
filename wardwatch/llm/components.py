"""Connected components of an edge table by alternating star contraction.

Large star: every node hands its larger neighbours to the smallest node it
knows; small star: every node hands its smaller neighbours to the smallest.
Repeated, each component becomes a star around its smallest node.  The edge
table stays distributed throughout; the driver sees one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _hand_over(edges: DataFrame, toward: DataFrame) -> DataFrame:
    """``edges`` (u, v) -> (v, smallest of u's neighbourhood)."""
    return (edges.join(toward, "u").filter(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _smallest(edges: DataFrame) -> DataFrame:
    """Dealt out anew, so that the join back shuffles either side for itself: Spark
    then splits a node that many edges share (it can't above an aggregate)."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).repartition("u", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _hand_over(both.filter("v > u"), _smallest(both)).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    low = _smallest(down)
    return (_hand_over(down, low)
            .union(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct())


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``edges`` (a, b) of any orderable ids -> (node, root), one row for each
    node with an edge to another; root is the smallest id of its component.
    Self-loops, repeated edges and null ends are ignored; no edges: no rows."""
    now = cut(edges.selectExpr("a as u", "b as v").filter("u != v").distinct())
    mark = None
    for _ in range(max_rounds):
        found = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(found) == mark or not found[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", F.col("v").alias("w")).distinct())
        mark = tuple(found)
        now = cut(_small_star(_large_star(now)))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
