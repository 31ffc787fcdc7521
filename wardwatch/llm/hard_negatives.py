"""Hard negatives: rows of another label that score almost as high as a positive.

Every row lies in a cell, that of its nearest pivot, and a cell in blocks of bounded
size; the cells, with their exact radii, are the upper levels of a cover tree, and in each block
stands one tree a label (``cover_tree``).  Anchors first look for their positives
in the cells that can hold their label.  Each positive then opens a window of
scores, and the anchor is sent with its windows to the cells that can hold such a
score; the trees skip what lies outside and verify the rest exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cogroup_arrow, collected, cut, map_arrow, stored
from .cover_tree import HIGH, LOW, Lists, Queries, grow, search
from .vectors import by_width, usable

SCALE = 256
SAMPLE = 2_000                 # vectors that pivots are chosen from
PIVOTS = 256                   # at most
ROWS = 2_048                   # rows of a block, about; rows for which there is a pivot
ANCHORS = 1_024                # anchors that search a block at once
FOUND = "anchor_id long, place int, vec_id long, score long"


def _ints(x: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * x)


def _pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length that a hash sample of SAMPLE rows has: centres of a few
    Lloyd steps."""
    n = rows.count()
    draw = F.xxhash64("vec_id", F.lit("pivot"))
    some = rows.filter(F.pmod(draw, F.lit(1 << 40)) < int((1 << 40) * 3.0 * SAMPLE / n)) if n > 4 * SAMPLE else rows
    picked = some.orderBy(draw).limit(SAMPLE).select("vec").toArrow()
    out = {}
    for _, x in by_width(picked.column("vec")):
        x = _ints(x)
        many = int(min(PIVOTS, len(x), max(1, n * len(x) / picked.num_rows // ROWS)))
        p = x[np.random.default_rng(5).permutation(len(x))[:many]]
        for _ in range(5):
            near = ((x ** 2).sum(axis=1)[:, None] - 2 * x @ p.T + (p ** 2).sum(axis=1)).argmin(axis=1)
            p = np.stack([x[near == j].mean(axis=0) if (near == j).any() else p[j] for j in range(many)])
        out[x.shape[1]] = p
    return out


def _assign(batches, pivots) -> Iterator[pa.RecordBatch]:
    """Rows with the cell of their nearest pivot (-1: a length without pivots) and their
    distance to it."""
    for b in batches:
        for rows, x in by_width(b.column("vec")):
            p, x = pivots.get(x.shape[1]), _ints(x)
            cell, away = np.full(len(rows), -1, np.int32), np.zeros(len(rows))
            if p is not None:
                cell = ((p ** 2).sum(axis=1) - 2 * x @ p.T).argmin(axis=1).astype(np.int32)
                away = np.sqrt(((x - p[cell]) ** 2).sum(axis=1)) * (1 + 1e-9)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(at), b.column("label").take(at), b.column("vec").take(at),
                 pa.array(np.full(len(rows), x.shape[1], np.int32)), pa.array(cell), pa.array(away)],
                names=["vec_id", "label", "vec", "dim", "cell", "away"])


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values, and the row of each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), np.diff(at))


def _route(batches, pivots, cells: dict, same: bool) -> Iterator[pa.RecordBatch]:
    """Anchors, once for each cell that can hold what they look for: their label
    (``same``), or a score of one of their windows."""
    for b in batches:
        label = b.column("label").to_numpy()
        for rows, x in by_width(b.column("vec")):
            width = x.shape[1]
            if width in pivots:
                x = _ints(x)
                own = sorted(c for d, c in cells if d == width)
                if same:
                    low, high = (np.array([cells[width, c][i] for c in own]) for i in (1, 2))
                    sent = (low <= label[rows][:, None]) & (label[rows][:, None] <= high)
                else:
                    middle = x @ pivots[width][own].T
                    size = np.sqrt((x ** 2).sum(axis=1))[:, None]
                    room = size * np.array([cells[width, c][0] for c in own])
                    room += 1e-9 * (np.abs(middle) + room + size) + 1e-6
                    lo, at = _flat(b.column("lo").take(pa.array(rows)))
                    hi, _ = _flat(b.column("hi").take(pa.array(rows)))
                    sent = np.zeros(middle.shape, bool)
                    np.logical_or.at(sent, at, (middle[at] + room[at] >= lo[:, None]) & (middle[at] - room[at] <= hi[:, None]))
                at, which = np.nonzero(sent)
                cell = np.array(own, np.int32)[which]
            else:
                at, cell = np.arange(len(rows)), np.full(len(rows), -1, np.int32)
            pick = pa.array(rows[at])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(pick) for c in ("anchor_id", "label", "vec", "lo", "hi")),
                 pa.array(np.full(len(at), width, np.int32)), pa.array(cell)],
                names=["anchor_id", "label", "vec", "lo", "hi", "dim", "cell"])


def search_block(anchors: pa.Table, rows: pa.Table, k: int, same: bool) -> pa.Table:
    """The ``k`` best rows of a block, of an anchor's own label (``same``) or of the others, for
    each of its windows: place is the window's number."""
    found = [np.zeros(0, np.int64)] * 4
    if anchors.num_rows and rows.num_rows:
        (_, q), = by_width(anchors.column("vec"))
        (_, x), = by_width(rows.column("vec"))
        own, mine = anchors.column("anchor_id").to_numpy(), anchors.column("label").to_numpy()
        ids, label = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        lo, at = _flat(anchors.column("lo"))
        hi, _ = _flat(anchors.column("hi"))
        queries = Queries(_ints(q), own, at, lo, hi)
        best = Lists.empty(len(at), k)
        x = _ints(x)
        for kind in np.unique(label):
            items = np.flatnonzero((mine[at] == kind) == same)
            if len(items):
                there = label == kind
                search(grow(x[there], ids[there], k), queries, items, best)
        item, col = np.nonzero(best.score > LOW)
        place = np.arange(len(at)) - np.searchsorted(at, at)
        found = own[at[item]], place[item], best.ids[item, col], best.score[item, col]
    return pa.table({"anchor_id": pa.array(found[0], pa.int64()), "place": pa.array(found[1].astype(np.int32)),
                     "vec_id": pa.array(found[2], pa.int64()), "score": pa.array(found[3], pa.int64())})


def _searched(rows: DataFrame, anchors: DataFrame, pivots: dict, cells: dict, k: int, same: bool) -> DataFrame:
    """The ``k`` best of each anchor and window over all blocks of the cells it is sent to."""
    kind = rows.schema["vec"].dataType.simpleString()
    sent = cut(map_arrow(anchors.select("anchor_id", "label", "vec", "lo", "hi"),
                         partial(_route, pivots=pivots, cells=cells, same=same),
                         f"anchor_id long, label long, vec {kind}, lo array<long>, hi array<long>, dim int, cell int"))
    blocks = rows.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("blocks"))
    chunks = sent.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("chunks"))
    deal = stored(blocks.join(chunks, ["dim", "cell"]), "cells")
    left = (sent.join(deal, ["dim", "cell"])
            .select("dim", "cell", F.pmod(F.xxhash64("anchor_id"), F.col("chunks")).cast("int").alias("chunk"),
                    F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "anchor_id", "label", "vec", "lo", "hi"))
    right = (rows.join(deal, ["dim", "cell"])
             .select("dim", "cell", F.explode(F.expr("sequence(0, chunks - 1)")).alias("chunk"),
                     F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), "vec_id", "label", "vec"))
    found = cogroup_arrow(left, right, ["dim", "cell", "chunk", "block"], partial(search_block, k=k, same=same), FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score: for each of ``anchors`` and each of its ``positives`` best other rows of
    its label, the ``negatives`` best rows of other labels with ``low`` * positive_score
    <= 100 * negative_score <= ``high`` * positive_score.

    ``vectors`` has vec_id, embedding and an integer label; ``anchors`` has
    vec_id, and those that are rows of ``vectors`` count.  A score is the inner
    product of the components floor(256 * x), exact within 64 bits; higher ones come
    first, ties to the smaller vec_id.  Rows without vec_id or label, and vectors that
    are null, empty or have a null or non-finite component, take no part; rows
    of different lengths never meet.  Of rows under one vec_id the one of the least label,
    then vector, takes part, so repeated rows count once.  A positive
    without such rows (one of a negative score, say), an anchor without positives, no
    rows: no rows.  Further columns are left out.
    """
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("embedding")
    one = F.struct(F.col("label").cast("long").alias("label"), F.col("embedding").alias("vec"))
    rows = cut(vectors.filter(good).groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(one).alias("row"))
               .select("vec_id", "row.label", "row.vec"))
    kind = rows.schema["vec"].dataType.simpleString()
    pivots = _pivots(rows)
    dealt = cut(map_arrow(rows, partial(_assign, pivots=pivots),
                          f"vec_id long, label long, vec {kind}, dim int, cell int, away double"))
    size = collected(dealt.filter("cell >= 0").groupBy("dim", "cell").agg(
        F.max("away").alias("away"), F.min("label").alias("low"), F.max("label").alias("high")))
    cells = {(int(d), int(c)): (r, int(lo), int(hi)) for d, c, r, lo, hi in zip(
        *(size[n] for n in ("dim", "cell", "away", "low", "high")), strict=True)}
    asked = cut(rows.join(anchors.filter("vec_id is not null")
                          .select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
                .withColumnRenamed("vec_id", "anchor_id"))
    first = asked.withColumn("lo", F.array(F.lit(LOW).cast("long"))).withColumn("hi", F.array(F.lit(HIGH).cast("long")))
    exact = F.col("score").cast("decimal(20,0)")
    found = cut(_searched(dealt, first, pivots, cells, positives, True)
                .select("anchor_id", (-F.col("score")).alias("s"), F.col("vec_id").alias("positive_id"),
                        F.ceil(exact * low / 100).cast("long").alias("least"),
                        F.floor(exact * high / 100).cast("long").alias("most")).filter("least <= most"))
    windows = found.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("s", "positive_id", "least", "most"))).alias("w"))
    second = asked.join(windows, "anchor_id").select(
        "anchor_id", "label", "vec", F.col("w.least").alias("lo"), F.col("w.most").alias("hi"), "w")
    answers = _searched(dealt, second, pivots, cells, negatives, False)
    places = windows.select("anchor_id", F.posexplode("w").alias("place", "p")).select(
        "anchor_id", "place", F.col("p.positive_id").alias("positive_id"), (-F.col("p.s")).alias("positive_score"))
    return (answers.join(places, ["anchor_id", "place"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                    F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
