"""Exact top-k search by inner product: a Voronoi kNN join.

Queries are grouped by their nearest pivot.  For a group around pivot p whose
queries lie within r of it, every row o satisfies, for every query q of the group,
    <p, o> - r |o|  <=  <q, o>  <=  <p, o> + r |o|.
Each task sums its rows up by the k + 1 ids of the largest lower bounds a group; the
k-th largest over all ids (one is spared for the query itself) is a score that
every query of the group reaches.  A row whose upper bound stays below it is no
answer and is not sent to the group; all others are, in blocks, and matrix
products solve each group and block exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cogroup_arrow, collected, cut, map_arrow
from .vectors import by_width, usable

K = 5
SCALE = 256
SAMPLE = 2_000                 # vectors that pivots are chosen from
PER_GROUP = 256                # queries for which there is a pivot
PIVOTS = 256                   # but at most so many
QUERIES = 1024                 # queries of a group solved at once
ROWS = 16_384                  # rows of a block, about
STEP = 2_048                   # rows of a block multiplied at once
EXACT = float(1 << 53)


def _ints(x: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * x)


def _pivots(vectors: DataFrame, queries: int) -> dict[int, np.ndarray]:
    """For each vector length its pivots: centres of a few Lloyd steps on a hash
    sample of at most SAMPLE vectors."""
    picked = vectors.orderBy(F.xxhash64("vec_id", F.lit("pivot"))).limit(SAMPLE).select("vec").toArrow()
    out = {}
    for _, x in by_width(picked.column("vec")):
        x = _ints(x)
        many = int(min(PIVOTS, len(x), max(1, -(-queries // PER_GROUP))))
        p = x[np.random.default_rng(5).permutation(len(x))[:many]]
        for _ in range(5):
            near = ((x ** 2).sum(1)[:, None] - 2 * x @ p.T + (p ** 2).sum(1)).argmin(axis=1)
            p = np.stack([x[near == j].mean(axis=0) if (near == j).any() else p[j] for j in range(many)])
        out[x.shape[1]] = p
    return out


def _to_pivots(x: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row, and the distance to it by differences (the
    expanded square would cancel where a row lies on its pivot)."""
    near = ((p ** 2).sum(axis=1) - 2 * x @ p.T).argmin(axis=1)
    return near, np.sqrt(((x - p[near]) ** 2).sum(axis=1))


def _group(batches, pivots) -> Iterator[pa.RecordBatch]:
    """Queries with the group of their nearest pivot and their distance to it."""
    for b in batches:
        for rows, x in by_width(b.column("vec")):
            p = pivots.get(x.shape[1])
            if p is None:                              # a length that the sample has not seen
                p = np.zeros((1, x.shape[1]))
            near, away = _to_pivots(_ints(x), p)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(rows)), b.column("vec").take(pa.array(rows)),
                 pa.array(np.full(len(rows), x.shape[1], np.int32)), pa.array(near.astype(np.int32)),
                 pa.array(away * (1 + 1e-9) + 1e-6)],
                names=["query_id", "vec", "dim", "grp", "away"])


def _bounds(x: np.ndarray, pivots: dict, radius: dict) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(dim, group, lower bounds, upper bounds) of integer rows ``x``, with room for
    the rounding of doubles."""
    width = x.shape[1]
    p = pivots.get(width, np.zeros((1, width)))
    norm = np.sqrt((x ** 2).sum(axis=1))
    middle = x @ p.T
    for g in range(len(p)):
        if (width, g) in radius:
            room = radius[width, g] * norm
            slack = 1e-9 * (np.abs(middle[:, g]) + room + np.linalg.norm(p[g]) * norm) + 1e-6
            yield width, g, middle[:, g] - room - slack, middle[:, g] + room + slack


def _summaries(batches, pivots, radius, k: int) -> Iterator[pa.RecordBatch]:
    """The k + 1 ids with the largest lower bounds of a task's rows for each group
    (an id with several vectors counts by its largest)."""
    best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        names = b.column("vec_id").to_numpy()
        for rows, x in by_width(b.column("vec")):
            for dim, g, low, _ in _bounds(_ints(x), pivots, radius):
                ids, held = best.get((dim, g), (np.zeros(0, np.int64), np.zeros(0)))
                more = low >= held.min() if len(held) > k else np.ones(len(low), bool)
                ids, held = np.concatenate([ids, names[rows][more]]), np.concatenate([held, low[more]])
                order = np.argsort(-held, kind="stable")
                order = order[np.sort(np.unique(ids[order], return_index=True)[1])[: k + 1]]
                best[dim, g] = ids[order], held[order]
    for (dim, g), (ids, low) in best.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(low), dim, np.int32)),
                                          pa.array(np.full(len(low), g, np.int32)), pa.array(ids), pa.array(low)],
                                         names=["dim", "grp", "vec_id", "low"])


def _replicas(batches, pivots, radius, reach) -> Iterator[pa.RecordBatch]:
    """Each row once for every group that it may answer."""
    for b in batches:
        for rows, x in by_width(b.column("vec")):
            for dim, g, _, high in _bounds(_ints(x), pivots, radius):
                pick = pa.array(rows[high >= reach.get((dim, g), -np.inf)])
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pick), b.column("vec").take(pick),
                     pa.array(np.full(len(pick), dim, np.int32)), pa.array(np.full(len(pick), g, np.int32))],
                    names=["vec_id", "vec", "dim", "grp"])


def _best_of(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best of one row of scores, ties to the smaller id (columns
    are in the order of ids)."""
    if len(score) <= k:
        return np.argsort(-score, kind="stable")
    least = np.partition(score, len(score) - k)[len(score) - k]
    above, equal = np.flatnonzero(score > least), np.flatnonzero(score == least)
    return np.concatenate([above[np.argsort(-score[above], kind="stable")], equal[: k - len(above)]])


def _solve(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """Each query's k best of a block, exact in integers; of vectors that share an
    id the best one counts."""
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                      "score": pa.array([], pa.int64())})
    if not queries.num_rows or not rows.num_rows:
        return empty
    (_, q), = by_width(queries.column("vec"))
    (_, x), = by_width(rows.column("vec"))
    q, x = _ints(q), _ints(x)
    if q.shape[1] * np.abs(q).max() * np.abs(x).max() >= EXACT:
        q, x = q.astype(np.int64), x.astype(np.int64)
    ids = rows.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    own = queries.column("query_id").to_numpy()
    starts = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
    cuts = [0, *(int(s) for s in starts[np.searchsorted(starts, np.arange(STEP, len(ids), STEP))
                                          .clip(max=len(starts) - 1)]), len(ids)]
    found = []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi <= lo:
            continue
        first = np.flatnonzero(np.diff(ids[lo:hi], prepend=ids[lo] - 1))
        score = np.maximum.reduceat(q @ x[lo:hi].T, first, axis=1)
        names = ids[lo:hi][first]
        for i in range(len(own)):
            other = names != own[i]
            best = _best_of(score[i][other], names[other], k)
            found.append((np.full(len(best), own[i]), names[other][best], score[i][other][best].astype(np.int64)))
    if not found:
        return empty
    return pa.table({n: np.concatenate([f[j] for f in found]) for j, n in enumerate(("query_id", "vec_id", "score"))})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query its ``k`` rows of
    ``vectors`` with the largest inner product of the components floor(256 * x),
    ties to the smaller vec_id.

    Both take vec_id and embedding.  Vectors that are null, empty or have a null
    or non-finite component, and rows without vec_id, take no part; nor do rows
    of another length than the query's, or with its vec_id.  Repeated rows count
    once; of different vectors under one id each pair's best score counts.  With
    fewer than ``k`` rows all are returned; no queries or rows: no rows.  Scores
    are exact within 64 bits.  Further columns are left out.
    """
    def clean(df: DataFrame) -> DataFrame:
        return (df.filter(F.col("vec_id").isNotNull() & usable("embedding"))
                .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec"))
                .dropDuplicates(["vec_id", "vec"]))

    rows, asked = cut(clean(vectors)), clean(queries)
    kind = rows.schema["vec"].dataType.simpleString()
    pivots = _pivots(rows, asked.count())
    grouped = cut(map_arrow(asked, partial(_group, pivots=pivots),
                            f"query_id long, vec {kind}, dim int, grp int, away double"))
    groups = grouped.groupBy("dim", "grp").agg(F.max("away").alias("r"), F.count(F.lit(1)).alias("n"))
    groups = collected(groups)
    radius = {(int(d), int(g)): r for d, g, r in zip(groups["dim"], groups["grp"], groups["r"], strict=True)}
    order = Window.partitionBy("dim", "grp").orderBy(F.desc("low"))
    reached = (map_arrow(rows, partial(_summaries, pivots=pivots, radius=radius, k=k),
                         "dim int, grp int, vec_id long, low double")
               .groupBy("dim", "grp", "vec_id").agg(F.max("low").alias("low")).withColumn("at", F.row_number().over(order)).filter(F.col("at") == k + 1))
    reached = collected(reached)
    reach = {(int(d), int(g)): s for d, g, s in zip(reached["dim"], reached["grp"], reached["low"], strict=True)}
    sent = cut(map_arrow(rows, partial(_replicas, pivots=pivots, radius=radius, reach=reach),
                         f"vec_id long, vec {kind}, dim int, grp int"))
    blocks = sent.groupBy("dim", "grp").agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("blocks"))
    parts = grouped.groupBy("dim", "grp").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("parts"))
    deal = blocks.join(parts, ["dim", "grp"])
    left = (grouped.join(deal, ["dim", "grp"])
            .select("dim", "grp", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int").alias("part"),
                    F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "query_id", "vec"))
    right = (sent.join(deal, ["dim", "grp"])
             .select("dim", "grp", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"),
                     F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), "vec_id", "vec"))
    found = cogroup_arrow(left, right, ["dim", "grp", "part", "block"], partial(_solve, k=k),
                          "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (best.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
