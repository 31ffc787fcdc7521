"""Approximate nearest neighbours by learned partitions.

A bounded sample's neighbour graph is cut into equal parts with few edges between
them (recursive bisection along the graph's slowest direction, then swaps that lessen the
cut).  A small network learns from it in which parts a vector's neighbours lie.
Every row goes to its most probable part; a query goes to its most probable
parts until their probabilities sum up to ``reach``, and is compared there with
every row.  ``reach`` is the least that finds TARGET of the true neighbours of
an audited sample of queries, which are compared with every row beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cogroup_arrow, collected, cut, map_arrow, stored
from .vectors import by_width, usable

K = 10
SAMPLE = 8_192                 # vectors that the graph is built over and the router learns from
AUDIT = 512                    # queries compared with every row to set ``reach``
TARGET = 0.95                  # of their neighbours to be found
PER_PART = 2_048               # rows for which there is a part
PARTS = 64                     # but at most so many
NEIGHBOURS = 10                # edges of a node in the sample's graph
HIDDEN = 128
EPOCHS = 20
ROWS = 16_384                  # rows of a block, about
QUERIES = 1_024                # queries compared with a block at once
STEP = 256
ALL = 2.0                      # a reach that no sum of probabilities attains


# --- the sample's graph and its parts -------------------------------------------

def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
    """Edges (u, v) of each row to its ``k`` nearest, both ways, each once."""
    n, square = len(x), (x ** 2).sum(axis=1)
    k = min(k, n - 1)
    if k < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    near = np.empty((n, k), np.int64)
    for lo in range(0, n, STEP):
        d = square - 2 * x[lo: lo + STEP] @ x.T
        d[np.arange(len(d)), np.arange(lo, lo + len(d))] = np.inf
        near[lo: lo + STEP] = np.argpartition(d, k - 1, axis=1)[:, :k]
    u, v = np.repeat(np.arange(n), k), near.ravel()
    code = np.unique(np.concatenate([u * n + v, v * n + u]))
    return code // n, code % n


def _halves(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Two sides (0 / 1) of equal size with few edges between them."""
    weight = np.sqrt(np.maximum(np.bincount(u, minlength=n), 1))
    steady = weight / np.linalg.norm(weight)
    x = np.random.default_rng(n).normal(size=n)
    for _ in range(80):
        x = x + np.bincount(u, x[v] / weight[v], minlength=n) / weight
        x -= steady * (steady @ x)
        x /= max(np.linalg.norm(x), 1e-300)
    side = np.zeros(n, np.int64)
    side[np.argsort(x / weight, kind="stable")[n // 2:]] = 1
    crossing = np.count_nonzero(side[u] != side[v])
    for _ in range(20):                                # swaps, as long as the cut gets smaller
        gain = np.bincount(u, np.where(side[u] != side[v], 1, -1), minlength=n)
        a, b = (np.flatnonzero(side == s)[np.argsort(-gain[side == s], kind="stable")] for s in (0, 1))
        m = min(len(a), len(b), max(1, n // 32))
        m = np.count_nonzero(gain[a[:m]] + gain[b[:m]] > 2)
        moved = side.copy()
        moved[a[:m]], moved[b[:m]] = 1, 0
        now = np.count_nonzero(moved[u] != moved[v])
        if not m or now >= crossing:
            break
        side, crossing = moved, now
    return side


def balanced_parts(n: int, u: np.ndarray, v: np.ndarray, parts: int) -> np.ndarray:
    """Part of each of ``n`` nodes: ``parts`` (a power of two) of equal size, give or take one a level."""
    part = np.zeros(n, np.int64)
    while parts > 1:
        parts //= 2
        split = np.zeros(n, np.int64)
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            inside = (part[u] == p) & (part[v] == p)
            at = np.zeros(n, np.int64)
            at[own] = np.arange(len(own))
            split[own] = _halves(len(own), at[u[inside]], at[v[inside]])
        part = 2 * part + split
    return part


# --- the router -------------------------------------------------------------------

class Router(NamedTuple):
    """Probabilities of the parts of one vector length."""
    centre: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.tanh(_inputs(x, self.centre, self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _inputs(x: np.ndarray, centre: np.ndarray, scale: float) -> np.ndarray:
    return np.clip(x / scale - centre, -50, 50)


def fit_router(x: np.ndarray, parts: int) -> Router:
    """Cut the graph of rows ``x`` into parts and learn where neighbours lie: the
    target of a row is the share of each part among its neighbours and itself."""
    scale = float(np.median(np.abs(x).max(axis=1))) or 1.0
    y = np.clip(x / scale, -1e6, 1e6)
    centre = y.mean(axis=0)
    u, v = neighbour_graph(y)
    part = balanced_parts(len(x), u, v, parts)
    want = np.zeros((len(x), parts))
    np.add.at(want, (u, part[v]), 1.0)
    want[np.arange(len(x)), part] += 1.0
    want /= want.sum(axis=1, keepdims=True)
    rng = np.random.default_rng(11)
    width = x.shape[1]
    theta = [rng.normal(size=(width, HIDDEN)) / np.sqrt(width), np.zeros(HIDDEN),
             rng.normal(size=(HIDDEN, parts)) * 0.1, np.zeros(parts)]
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    inputs, step = _inputs(x, centre, scale), 0
    for _ in range(EPOCHS if parts > 1 else 0):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), STEP):
            at = order[lo: lo + STEP]
            h = np.tanh(inputs[at] @ theta[0] + theta[1])
            z = h @ theta[2] + theta[3]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            err = (z / z.sum(axis=1, keepdims=True) - want[at]) / len(at)
            back = (err @ theta[2].T) * (1 - h * h)
            slopes = [inputs[at].T @ back, back.sum(axis=0), h.T @ err, err.sum(axis=0)]
            step += 1
            for i, slope in enumerate(slopes):
                slope = slope + 1e-5 * theta[i]
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope * slope
                theta[i] = theta[i] - 3e-3 * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return Router(centre, scale, *theta)


def _mass_before(p: np.ndarray) -> np.ndarray:
    """For each part the probability of all parts that a query tries before it."""
    order = np.argsort(-p, axis=1, kind="stable")
    ranked = np.take_along_axis(p, order, axis=1)
    before = np.cumsum(ranked, axis=1) - ranked
    out = np.empty_like(p)
    np.put_along_axis(out, order, before, axis=1)
    return out


# --- tasks ------------------------------------------------------------------------

def _assign(batches, routers) -> Iterator[pa.RecordBatch]:
    """Rows with their most probable part."""
    for b in batches:
        for rows, x in by_width(b.column("vec")):
            r = routers.get(x.shape[1])
            part = r.probabilities(x).argmax(axis=1) if r else np.zeros(len(rows), np.int64)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(at), b.column("vec").take(at),
                 pa.array(np.full(len(rows), x.shape[1], np.int32)), pa.array(part.astype(np.int32))],
                names=["vec_id", "vec", "dim", "part"])


def _route(batches, routers, reach: float) -> Iterator[pa.RecordBatch]:
    """Queries, once for each part that they try."""
    for b in batches:
        for rows, x in by_width(b.column("vec")):
            r = routers.get(x.shape[1])
            tried = _mass_before(r.probabilities(x)) < reach if r else np.ones((len(rows), 1), bool)
            at, part = np.nonzero(tried)
            pick = pa.array(rows[at])
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pick), b.column("vec").take(pick),
                 pa.array(np.full(len(at), x.shape[1], np.int32)), pa.array(part.astype(np.int32))],
                names=["query_id", "vec", "dim", "part"])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between rows of equal number, in doubles."""
    gap = b - a
    far = np.sqrt((gap * gap).sum(axis=1))
    odd = ~np.isfinite(far) | (far < 1e-140)           # squares left the range of doubles
    if odd.any():
        most = np.abs(gap[odd]).max(axis=1)
        unit = np.where((most > 0) & np.isfinite(most), most, 1.0)
        far[odd] = unit * np.sqrt(((gap[odd] / unit[:, None]) ** 2).sum(axis=1))
    return far


def nearest(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, distance) of the ``k`` nearest ids of each query, its own
    left out, ties to the smaller id; an id counts once, by its nearest vector."""
    _, same = np.unique(np.ascontiguousarray(x).view(f"V{8 * x.shape[1]}").ravel(), return_inverse=True)
    order = np.lexsort((ids, same))
    fresh = np.concatenate([[True], (np.diff(same[order]) != 0) | (np.diff(ids[order]) != 0)])
    order = order[fresh]                               # repeated rows once
    starts = np.flatnonzero(np.diff(same[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    keep = order[place <= k]                           # of equal vectors the k + 1 smallest ids
    x, ids = x[keep], ids[keep]
    spare = 1 + len(ids) - len(np.unique(ids))
    with np.errstate(over="ignore", invalid="ignore"):
        square = (x ** 2).sum(axis=1)
    found = []
    for lo in range(0, len(q), STEP):
        part = q[lo: lo + STEP]
        with np.errstate(over="ignore", invalid="ignore"):
            mine = (part ** 2).sum(axis=1)[:, None]
            d = mine + square - 2 * part @ x.T
            slack = 16 * (x.shape[1] + 4) * np.finfo(float).eps * (mine + square) + 1e-290
        m = min(k + spare, len(ids))
        if np.isfinite(d).all():
            least = np.partition(d, m - 1, axis=1)[:, m - 1:m]
            i, j = np.nonzero(d - slack <= least + slack.max(axis=1, keepdims=True))
        else:
            i, j = np.nonzero(np.ones(d.shape, bool))
        other = ids[j] != own[lo + i]
        i, j = i[other], j[other]
        far = distances(part[i], x[j])
        order = np.lexsort((ids[j], far, i))
        i, name, far = i[order], ids[j][order], far[order]
        if spare > 1:
            again = np.lexsort((np.arange(len(i)), name, i))
            first = np.concatenate([[True], (np.diff(i[again]) != 0) | (np.diff(name[again]) != 0)]) \
                if len(i) else np.zeros(0, bool)
            best = np.sort(again[first])
            i, name, far = i[best], name[best], far[best]
        starts = np.flatnonzero(np.diff(i, prepend=-1))
        place = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i))))
        top = place < k
        found.append((lo + i[top], name[top], far[top]))
    return tuple(np.concatenate([f[c] for f in found]) for c in range(3))


def _solve(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """Each query's nearest of a block."""
    if not queries.num_rows or not rows.num_rows:
        return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                         "score": pa.array([], pa.float64())})
    (_, q), = by_width(queries.column("vec"))
    (_, x), = by_width(rows.column("vec"))
    own = queries.column("query_id").to_numpy()
    at, ids, far = nearest(q, own, x, rows.column("vec_id").to_numpy(), k)
    return pa.table({"query_id": own[at], "vec_id": ids, "score": far})


def _audit_rows(batches, asked: dict, k: int) -> Iterator[pa.RecordBatch]:
    """A task's nearest rows of each audited query, with their parts."""
    best: dict[int, list] = {}
    for b in batches:
        ids, part = b.column("vec_id").to_numpy(), b.column("part").to_numpy()
        for rows, x in by_width(b.column("vec")):
            if x.shape[1] not in asked or not len(rows):
                continue
            own, q = asked[x.shape[1]]
            at, name, far = nearest(q, own, x, ids[rows], k)
            where = dict(zip(ids[rows].tolist(), part[rows].tolist(), strict=True))
            held = best.setdefault(x.shape[1], [])
            held.append((at, name, far, np.array([where[i] for i in name.tolist()], np.int32)))
            if sum(len(h[0]) for h in held) > 4 * k * len(own):
                held[:] = [_best_of(held, k)]
    for width, held in best.items():
        at, name, far, part = _best_of(held, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), width, np.int32)), pa.array(at.astype(np.int32)), pa.array(name), pa.array(far),
             pa.array(part)], names=["dim", "at", "vec_id", "far", "part"])


def _best_of(held: list, k: int) -> tuple:
    at, name, far, part = (np.concatenate([h[c] for h in held]) for c in range(4))
    order = np.lexsort((name, far, at))
    starts = np.flatnonzero(np.diff(at[order], prepend=-1))
    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
    top = order[place < k]
    return at[top], name[top], far[top], part[top]


# --- the index and the search -------------------------------------------------------

def _hash_sample(df: DataFrame, n: int, most: int, salt: str) -> pa.Table:
    """At most ``most`` distinct vectors of ``df`` (``n`` rows), by their hashes; a
    task sends a few times its share, so the driver sees a bounded number of rows."""
    draw = F.xxhash64("vec_id", "vec", F.lit(salt))
    if n > 4 * most:
        df = df.filter(F.pmod(draw, F.lit(1 << 40)) < int((1 << 40) * 3.0 * most / n))
    return (df.groupBy("vec").agg(F.min("vec_id").alias("vec_id")).withColumn("draw", draw)
            .orderBy("draw").limit(most).select("vec_id", "vec").toArrow())


class Index(NamedTuple):
    """All rows in their parts, and the routers of the lengths that the sample saw."""
    rows: DataFrame
    routers: dict


def _clean(df: DataFrame) -> DataFrame:
    there = F.exists("embedding", lambda v: v != 0)
    return (df.filter(F.col("vec_id").isNotNull() & usable("embedding") & F.coalesce(there, F.lit(False)))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec")))


def build(vectors: DataFrame, sample: int = SAMPLE) -> Index:
    """Fit routers on at most ``sample`` vectors and put every row into its part."""
    rows = _clean(vectors)
    n = rows.count()
    picked = _hash_sample(rows, n, sample, "part")
    routers = {}
    for _, x in by_width(picked.column("vec")):
        parts = 1
        share = n * len(x) / max(1, picked.num_rows)   # rows of this length, about
        while 2 * parts <= min(PARTS, share / PER_PART, len(x) / (2 * NEIGHBOURS)):
            parts *= 2
        if parts > 1:
            routers[x.shape[1]] = fit_router(x, parts)
    kind = rows.schema["vec"].dataType.simpleString()
    return Index(cut(map_arrow(rows, partial(_assign, routers=routers),
                               f"vec_id long, vec {kind}, dim int, part int")), routers)


def reach_for(index: Index, queries: DataFrame, k: int, target: float, audit: int = AUDIT) -> float:
    """The least sum of probabilities up to which a query must go on so that
    ``target`` of the true neighbours of ``audit`` queries are found."""
    asked = {x.shape[1]: (picked_ids, x) for picked_ids, x in _audited(queries, audit)}
    if not asked:
        return ALL
    true = map_arrow(index.rows.select("vec_id", "vec", "part"), partial(_audit_rows, asked=asked, k=k),
                     "dim int, at int, vec_id long, far double, part int")
    one = true.groupBy("dim", "at", "vec_id").agg(F.min(F.struct("far", "part")).alias("b"))
    order = Window.partitionBy("dim", "at").orderBy("b.far", "vec_id")
    true = collected(one.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
                     .select("dim", "at", "b.part"))
    needed = [np.zeros(0)]
    for width, (_, x) in asked.items():
        mine = true["dim"] == width
        if width in index.routers:
            before = _mass_before(index.routers[width].probabilities(x))
            needed.append(before[true["at"][mine], true["part"][mine]])
        else:
            needed.append(np.zeros(np.count_nonzero(mine)))
    needed = np.sort(np.concatenate(needed))
    if not len(needed):
        return ALL
    return float(np.nextafter(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)], ALL))


def _audited(queries: DataFrame, audit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    picked = _hash_sample(queries, queries.count(), audit, "audit")
    ids = picked.column("vec_id").to_numpy()
    for rows, x in by_width(picked.column("vec")):
        yield ids[rows], x


def search(index: Index, asked: DataFrame, k: int, reach: float) -> DataFrame:
    """query_id, vec_id, score: the ``k`` nearest rows of the parts that each query tries."""
    kind = index.rows.schema["vec"].dataType.simpleString()
    sent = cut(map_arrow(asked, partial(_route, routers=index.routers, reach=reach),
                         f"query_id long, vec {kind}, dim int, part int"))
    blocks = index.rows.groupBy("dim", "part").agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("blocks"))
    chunks = sent.groupBy("dim", "part").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("chunks"))
    deal = stored(blocks.join(chunks, ["dim", "part"]), "parts")
    number = F.monotonically_increasing_id()           # equal rows are dealt like any others
    left = (sent.withColumn("number", number).join(deal, ["dim", "part"])
            .select("dim", "part", F.pmod(F.xxhash64("query_id", "number"), F.col("chunks")).cast("int").alias("chunk"),
                    F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "query_id", "vec"))
    right = (index.rows.withColumn("number", number).join(deal, ["dim", "part"])
             .select("dim", "part", F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"),
                     F.pmod(F.xxhash64("vec_id", "number"), F.col("blocks")).cast("int").alias("block"), "vec_id", "vec"))
    found = cogroup_arrow(left, right, ["dim", "part", "chunk", "block"], partial(_solve, k=k),
                          "query_id long, vec_id long, score double")
    return found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = K, target: float = TARGET,
                       sample: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query ``k`` near rows of
    ``vectors`` by Euclidean distance, nearest first, ties to the smaller vec_id.

    Both take vec_id and embedding.  Every row is indexed; only the router is
    fitted, on at most ``sample`` vectors.  About ``target`` of the true
    neighbours are found (1.0 and above: every part is tried, and all are).  Vectors that
    are null, empty, zero or have a null or non-finite component, and rows
    without vec_id, take no part; nor do rows of another length than the
    query's, or with its vec_id.  Repeated rows count once; of different vectors
    under one id each pair's nearest counts.  A query that finds fewer than ``k``
    tries every part, so that all rows are returned where there are fewer.  No
    queries or rows: no rows.  Further columns are left out.
    """
    index, asked = build(vectors, sample), cut(_clean(queries))
    reach = ALL if target >= 1 or not index.routers else reach_for(index, asked, k, target)
    best = cut(search(index, asked, k, reach))
    if reach < ALL:
        full = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
        short = cut(asked.join(full, asked["vec_id"] == full["query_id"], "left_anti"))
        if not short.isEmpty():
            again = search(index, short, k, ALL)
            best = best.union(again).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (best.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
