"""Embedding near-duplicates by NN-descent.

Equal vectors are one node.  A first graph comes from random hyperplanes: nodes
stand in the order of their signs, meet those about them and keep their nearest.  NN-descent then
refines it: each node introduces its neighbours to one another, whoever improves
a list enters it, and only pairs with a new edge meet again.  A list that is full
of links is saturated: it and the lists about it are enlarged, WIDEN times as long, their edges
are new again, and the descent goes on among them.  Links beyond the longer lists are not
given up: components with a saturated list are counted exactly, in tiles of blocks
against themselves and against one another, which joins those that link.  A sample of nodes, linked ones and
others, compared with every row, audits the mean recall of a node outside the
crowds; below the target the search goes on with fresh hyperplanes and larger
meetings, and after TRIES it fails with the recall reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, group_arrow, map_arrow
from .components import components
from .vectors import by_width, unit, usable

NEIGHBOURS = 12                # length of a neighbour list at first
WIDEN = 4                      # times as long are saturated ones
WIDE_ROUNDS = 2                # of descent among these
TABLES = 6                     # sets of hyperplanes of the first graph
MEET = 128                     # nodes of like signs that meet, and as many on either side
ROUNDS = 4
AUDIT = 2_000                  # linked, and unlinked, nodes that the audit compares with every row
RECALL = 0.97
TRIES = 8                      # each with fresh hyperplanes and twice as many that meet
BLOCK = 512                    # members of a crowded component compared at once
SIDE = 8                       # blocks on either side of a tile
TILE = 1024                    # blocks whose centres are compared at once
BITS = 48

EDGES = "u long, v long, sim double"


def _signs(batches, tables: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Adds ``signs``: for each set of hyperplanes the BITS signs as a number."""
    for b in batches:
        out = np.zeros((b.num_rows, tables), np.int64)
        for rows, x in by_width(b.column("vec")):
            planes = np.random.default_rng([seed, x.shape[1]]).normal(size=(x.shape[1], tables * BITS))
            side = (unit(x) @ planes > 0).reshape(len(rows), tables, BITS)
            out[rows] = side @ (1 << np.arange(BITS, dtype=np.int64)[::-1])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(out), pa.list_(pa.int64()))],
                                         names=[*b.schema.names, "signs"])


def _nearest(group: pa.Table, done: int, k: int, meet: int, ends: bool) -> tuple[list[pa.Table], int]:
    """The ``k`` nearest of each row from ``done`` on, among its block of ``meet``
    rows and the blocks before and after; and how far that came."""
    node, n, out = group.column("node").to_numpy(), group.num_rows, []
    (_, x), = by_width(group.column("vec"))
    x = unit(x)
    while done < n and (ends or done + 2 * meet <= n):
        lo, hi, to = max(0, done - meet), min(n, done + 2 * meet), min(n, done + meet)
        sim = x[done:to] @ x[lo:hi].T
        sim[np.arange(to - done), np.arange(done, to) - lo] = -np.inf
        most = min(k, hi - lo - 1)
        if most > 0:
            best = np.argpartition(-sim, most - 1, axis=1)[:, :most]
            u = np.repeat(np.arange(to - done), most)
            out.append(pa.table({"u": node[done:to][u], "v": node[lo:hi][best.ravel()], "sim": sim[u, best.ravel()]}))
        done = to
    return out, done


def _neighbours_in_order(batches, k: int, meet: int) -> Iterator[pa.RecordBatch]:
    """Rows in the order of (run, sign): each meets those about it in its run."""
    kept, done = None, 0                               # the last run's end, of it passed on already
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if kept is None else pa.concat_tables([kept, t]).combine_chunks()
        if not t.num_rows:
            continue
        run = t.column("run").to_numpy()
        edge = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(run)]
        for lo, hi in zip(edge, edge[1:], strict=False):
            own, last = t.slice(lo, hi - lo), hi == len(run)
            out, done = _nearest(own, done, k, meet, not last)
            for o in out:
                yield from o.to_batches()
            if last:
                rest = max(0, done - meet)
                kept, done = own.slice(rest), done - rest
            else:
                done = 0
    if kept is not None:
        for o in _nearest(kept, done, k, meet, True)[0]:
            yield from o.to_batches()


def _first_graph(nodes: DataFrame, k: int, tables: int, meet: int, seed: int) -> DataFrame:
    """Edges among nodes with like signs: the nodes of a label stand in the order of
    their signs, so that where they are many further bits part them, and meet
    those next to them.  Only equal signs stand in random order."""
    kinds = (f"node long, label {nodes.schema['label'].dataType.simpleString()}, dim int, "
             f"vec {nodes.schema['vec'].dataType.simpleString()}, signs array<long>")
    order = ["label", "dim", "t", "sign", "deal"]
    signed = (map_arrow(nodes.select("node", "label", "dim", "vec"), partial(_signs, tables=tables, seed=seed), kinds)
              .select("node", "label", "dim", "vec", F.posexplode("signs").alias("t", "sign"))
              .withColumn("deal", F.xxhash64("node", "t", F.lit(seed)))
              .repartitionByRange(*order).sortWithinPartitions(*order)
              .select(F.xxhash64("label", "dim", "t").alias("run"), "node", "vec"))
    return map_arrow(signed, partial(_neighbours_in_order, k=k, meet=meet), EDGES)


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each u; an edge is new unless it was there before."""
    one = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.bool_and("new").alias("new"))
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return one.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k).drop("at")


def _saturated(graph: DataFrame, k: int, threshold: float) -> DataFrame:
    """(node): those whose list of ``k`` is full of links."""
    return (graph.filter(F.col("sim") >= threshold).groupBy(F.col("u").alias("node"))
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k).select("node"))


def _whole_groups(batches, key: str) -> Iterator[pa.Table]:
    """Batches of rows sorted by ``key``, re-cut so that no key is divided."""
    kept = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if kept is None else pa.concat_tables([kept, t]).combine_chunks()
        if not t.num_rows:
            continue
        keys = t.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if last:
            yield t.slice(0, last)
        kept = t.slice(last)
    if kept is not None and kept.num_rows:
        yield kept


def _introduce(batches) -> Iterator[pa.RecordBatch]:
    """Members of each centre meet; whoever betters a list is passed on."""
    for t in _whole_groups(batches, "c"):
        centre, node = t.column("c").to_numpy(), t.column("node").to_numpy()
        new, worst = t.column("new").to_numpy(zero_copy_only=False), t.column("worst").to_numpy()
        for rows, x in by_width(t.column("vec")):
            starts = np.flatnonzero(np.diff(centre[rows], prepend=centre[rows[0]] - 1))
            size = np.diff(np.append(starts, len(rows)))
            most = int(size.max())
            where = starts[:, None] + np.minimum(np.arange(most), size[:, None] - 1)
            there = np.arange(most) < size[:, None]
            x = unit(x)[where]
            sim = x @ x.transpose(0, 2, 1)
            at = rows[where]
            meet = (there[:, :, None] & there[:, None, :] & (new[at][:, :, None] | new[at][:, None, :])
                    & (node[at][:, :, None] != node[at][:, None, :]) & (sim > worst[at][:, :, None]))
            g, i, j = np.nonzero(meet)
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[at[g, i]]), pa.array(node[at[g, j]]), pa.array(sim[g, i, j])],
                names=["u", "v", "sim"])


def _descend(nodes: DataFrame, graph: DataFrame, k: int, seed: int) -> DataFrame:
    """One round of NN-descent."""
    back = graph.select(F.col("v").alias("c"), F.col("u").alias("node"), "new")
    some = Window.partitionBy("c").orderBy(F.desc("new"), F.xxhash64("node", F.lit(seed)))
    back = back.withColumn("at", F.row_number().over(some)).filter(F.col("at") <= k).drop("at")
    members = (graph.select(F.col("u").alias("c"), F.col("v").alias("node"), "new").union(back)
               .groupBy("c", "node").agg(F.bool_or("new").alias("new")))
    worst = (graph.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("least"))
             .select(F.col("u").alias("node"), F.when(F.col("n") < k, -2.0).otherwise(F.col("least")).alias("worst")))
    known = (nodes.select("node", "vec").join(worst, "node", "left")
             .withColumn("worst", F.coalesce("worst", F.lit(-2.0))))
    met = (members.join(known, "node").select("c", "node", "new", "worst", "vec")
           .repartition("c").sortWithinPartitions("c"))
    found = map_arrow(met, _introduce, EDGES).distinct().withColumn("new", F.lit(True))
    return _top(graph.withColumn("new", F.lit(False)).union(found.select("u", "v", "sim", "new")), k)


def _enlarged(nodes: DataFrame, graph: DataFrame, full: DataFrame, wide: int, seed: int) -> DataFrame:
    """``graph`` with longer lists, of ``wide``, of the saturated nodes ``full`` and of those in
    their lists: all their edges are new again, and the descent goes on among them."""
    about = cut(full.union(graph.join(full.withColumnRenamed("node", "u"), "u", "left_semi").select("v")).distinct())
    some = nodes.select("node", "vec").join(about, "node", "left_semi")
    lists = graph.join(about.withColumnRenamed("node", "u"), "u", "left_semi").withColumn("new", F.lit(True))
    for r in range(WIDE_ROUNDS):
        lists = cut(_descend(some, lists, wide, seed + r))
    return cut(graph.select("u", "v", "sim").union(lists.select("u", "v", "sim")).groupBy("u", "v")
               .agg(F.max("sim").alias("sim")).withColumn("new", F.lit(False)))


def _ball(group: pa.Table) -> pa.Table:
    """Mean direction of a block and the largest angle of a member to it."""
    (_, x), = by_width(group.column("vec"))
    x = unit(x)
    centre = x.sum(axis=0)
    length = np.sqrt(centre @ centre)
    centre = centre / length if length > 1e-9 else x[0]
    radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
    return pa.table({"root": group.column("root").slice(0, 1), "own": group.column("own").slice(0, 1),
                     "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": [radius]})


def _may_link(group: pa.Table, threshold: float) -> pa.Table:
    """Pairs of blocks, one of each tile (or both of one), that are near enough for a link."""
    root, own = group.column("root").to_numpy(), group.column("own").to_numpy()
    side, radius = group.column("side").to_numpy(), group.column("radius").to_numpy()
    (_, x), = by_width(group.column("centre"))
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    same = not len(b)
    b = a if same else b
    gap = np.arccos(np.clip(x[a] @ x[b].T, -1, 1)) - radius[a][:, None] - radius[b]
    near = gap <= np.arccos(np.clip(threshold, -1, 1)) + 1e-6
    if same:
        near = np.triu(near) | np.eye(len(a), dtype=bool)
    i, j = np.nonzero(near)
    return pa.table({"root": root[a[i]], "own": own[a[i]], "root2": root[b[j]], "own2": own[b[j]]})


def _linked_in_tile(group: pa.Table, threshold: float) -> pa.Table:
    """For each member of two sides of blocks how many vectors of the other it links to,
    and the other's root if it links to any.  A block that came for several pairs counts once."""
    node, side, root = (group.column(c).to_numpy() for c in ("node", "side", "root"))
    copies = group.column("copies").to_numpy()
    (_, x), = by_width(group.column("vec"))
    x = unit(x)
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = not len(b)
    b = a if alone else b                              # a tile with itself
    n_links, nodes = np.zeros((2, len(node)), np.int64)
    for lo in range(0, len(a), BLOCK):
        at = a[lo: lo + BLOCK]
        link = (x[at] @ x[b].T >= threshold) & (node[at][:, None] != node[b][None, :])
        n_links[at], nodes[at] = (link * copies[b]).sum(axis=1), link.sum(axis=1)
        if not alone:
            n_links[b] += (link * copies[at][:, None]).sum(axis=0)
            nodes[b] += link.sum(axis=0)
    other = np.where(side == 0, root[b[0]], root[a[0]])
    return pa.table({"node": node, "n_links": n_links, "nodes": nodes, "root": root,
                     "other": np.where(nodes > 0, other, root)})


def _count_in_blocks(members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(node, n_links, nodes) of crowded components, and (a, b): roots that a link
    joins.  ``members`` (root, label, dim, node, copies, vec) are dealt into blocks; every
    two blocks of a label, of one component or of two, whose centres and radii
    leave room for a link are compared, by counts alone; no pair leaves its task.
    Pairs of blocks meet in tiles of SIDE by SIDE: a block is sent once a tile, not once a pair."""
    blocks = (members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
              .repartition("root", "blocks"))          # so that a large root can be split in the join
    dealt = cut(members.join(blocks, "root")
                .withColumn("own", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")).drop("blocks"))
    kinds = "root long, own int, centre array<double>, radius double"
    balls = cut(group_arrow(dealt.select("root", "own", "vec"), ["root", "own"], _ball, kinds)
                .join(dealt.select("root", "label", "dim").distinct(), "root"))
    tiles = balls.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    tiled = (balls.join(tiles, ["label", "dim"])
             .withColumn("tile", F.pmod(F.xxhash64("root", "own"), F.col("tiles")).cast("int"))
             .withColumn("with", F.explode(F.expr("sequence(0, tiles - 1)"))))
    tiled = tiled.select("label", "dim", F.least("tile", "with").alias("i"), F.greatest("tile", "with").alias("j"),
                         (F.col("tile") > F.col("with")).cast("int").alias("side"), "root", "own", "centre", "radius")
    near = group_arrow(tiled, ["label", "dim", "i", "j"], partial(_may_link, threshold=threshold),
                       "root long, own int, root2 long, own2 int")
    # both ends in one order, so that two tiles meet once; blocks that aren't near have no link
    ends = F.sort_array(F.array(F.struct("root", "own"), F.struct(F.col("root2").alias("root"), F.col("own2").alias("own"))))
    ends = near.select(ends.alias("e")).select(
        *[F.col("e")[i][c].alias(f"{c}{i}") for i in (0, 1) for c in ("root", "own")])
    for i in (0, 1):
        ends = ends.withColumn(f"t{i}", F.expr(f"own{i} div {SIDE}"))
    pair, apart = ["root0", "t0", "root1", "t1"], (F.col("root0") != F.col("root1")) | (F.col("t0") != F.col("t1"))
    sides = cut(ends.select(*pair, F.lit(0).alias("side"), F.col("root0").alias("root"), F.col("own0").alias("own"))
                .union(ends.select(*pair, apart.cast("int"), "root1", "own1")).distinct())
    found = cut(group_arrow(sides.join(dealt, ["root", "own"]).select(*pair, "side", "root", "node", "copies", "vec"),
                            pair, partial(_linked_in_tile, threshold=threshold),
                            "node long, n_links long, nodes long, root long, other long"))
    return (found.groupBy("node").agg(F.sum("n_links").alias("n_links"), F.sum("nodes").alias("nodes")),
            found.filter("root != other").select(F.col("root").alias("a"), F.col("other").alias("b")).distinct())


def _audited(batches, sample: dict, threshold: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        node, label = b.column("node").to_numpy(), b.column("label").to_pylist()
        for rows, x in by_width(b.column("vec")):
            x = unit(x)
            for key, (own, y) in sample.items():
                mine = np.array([r for r, p in enumerate(rows) if label[p] == key[0]], np.int64)
                if key[1] != x.shape[1] or not len(mine):
                    continue
                link = (x[mine] @ y.T >= threshold) & (node[rows[mine]][:, None] != own)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(link.sum(axis=0))], names=["node", "n"])


def audit(nodes: DataFrame, links: DataFrame, threshold: float, sample: int = AUDIT) -> tuple[float, bool]:
    """Mean over the nodes with links of the share that ``links`` (node, nodes: linked
    nodes, crowded) has, crowded components apart, and whether a node with links
    was seen or every node was.  ``sample`` nodes with a found link and as many
    without are compared with every row of their label; either kind weighs by
    its number."""
    state = (nodes.select("node", "label", "dim", "vec").join(links, "node", "left")
             .filter(~F.coalesce("crowded", F.lit(False)))
             .withColumn("got", F.coalesce("nodes", F.lit(0).cast("long"))))
    order = F.xxhash64("node", F.lit("audit"))
    queries, got, picked, asked = {}, {}, [], {}
    of_all = {r["some"]: r["count"] for r in state.groupBy((F.col("got") > 0).alias("some")).count().collect()}
    for some in of_all:
        rows = (state.filter((F.col("got") > 0) == F.lit(some)).orderBy(order).limit(sample)
                .select("node", "label", "vec", "got").toArrow())
        asked[some] = rows.num_rows
        got.update(zip(rows.column("node").to_pylist(), rows.column("got").to_pylist(), strict=True))
        picked.append(rows)
    if not picked:
        return 1.0, True
    rows = pa.concat_tables(picked).combine_chunks()
    node, label = rows.column("node").to_numpy(), np.array(rows.column("label").to_pylist(), object)
    for at, x in by_width(rows.column("vec")):
        for own in set(label[at].tolist()):
            mine = label[at] == own
            queries[own, x.shape[1]] = (node[at[mine]], unit(x[mine]))
    true = map_arrow(nodes.select("node", "label", "vec"), partial(_audited, sample=queries, threshold=threshold),
                     "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).filter("n > 0").collect()
    weight = {some: of_all[some] / asked[some] for some in of_all}
    share = [(weight[got[r["node"]] > 0], min(1.0, got[r["node"]] / r["n"])) for r in true]
    if not share:
        return 1.0, asked == of_all
    return sum(w * s for w, s in share) / sum(w for w, _ in share), True


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, k: int = NEIGHBOURS,
                    rounds: int = ROUNDS, recall: float = RECALL, seed: int = 3) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each row of ``vectors``
    (vec_id, embedding, label).

    Vectors link when their labels and lengths are equal and their cosine, in
    doubles, is at least ``threshold``.  A null label, and a vector that is null,
    empty, zero or has a null or non-finite component, links with nothing.
    Repeated rows link with each other like any equal vectors.  Rows without
    vec_id link but never name a component.  Further columns are left out; no
    rows: no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("vec"))
    good = F.col("label").isNotNull() & usable("vec") & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False))
    valid = rows.filter(good).withColumn("dim", F.size("vec"))
    nodes = cut(valid.groupBy("label", "dim", "vec")
                .agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
                .withColumn("node", F.monotonically_increasing_id()))
    graph, tried = None, 0
    while True:
        fresh = _first_graph(nodes, k, TABLES, MEET << tried, seed + tried).withColumn("new", F.lit(True))
        known = fresh if graph is None else graph.union(fresh.select(*graph.columns))
        graph = cut(_top(known, k))
        for r in range(rounds):
            graph = cut(_descend(nodes, graph, k, seed + r))
            if graph.filter("new").limit(1).isEmpty():
                break
        full = cut(_saturated(graph, k, threshold))
        if not full.isEmpty():
            graph = _enlarged(nodes, graph, full, WIDEN * k, seed)
        links, roots, reached, seen = _links(nodes, graph, full, threshold, AUDIT << tried)
        tried += 1
        if reached >= recall and (seen or tried > 1):
            break
        if tried == TRIES:
            raise RuntimeError(f"{reached:.4f} of a node's links found after {tried} tries, {recall} asked for")
    found = (nodes.join(links.select("node", "n_links"), "node", "left").join(roots, "node", "left")
             .withColumn("root", F.coalesce("root", "node"))
             .withColumn("n_links", F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1))
    names = (found.groupBy("root").agg(F.min("first_id").alias("component_id"))
             .repartition("root", "component_id"))     # so that a large root can be split in the join
    named = found.join(names, "root").select("label", "dim", "vec", "n_links", "component_id")
    linked = valid.join(named, ["label", "dim", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                      F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(nodes: DataFrame, graph: DataFrame, full: DataFrame, threshold: float,
           sample: int) -> tuple[DataFrame, DataFrame, float, bool]:
    """(node, n_links: other vectors linked, nodes: other nodes linked, crowded),
    (node, root), and what the audit says."""
    edges = graph.filter(F.col("sim") >= threshold).select("u", "v")
    pairs = cut(edges.union(edges.select("v", "u")).distinct())
    roots = cut(components(pairs.select(F.col("u").alias("a"), F.col("v").alias("b"))))
    crowded = roots.join(full, "node").select("root").distinct()
    crowd = roots.join(crowded, "root").join(nodes.select("node", "label", "dim", "copies", "vec"), "node")
    few = (pairs.join(roots.join(crowded, "root", "left_anti").select(F.col("node").alias("u")), "u")
           .join(nodes.select(F.col("node").alias("v"), "copies"), "v")
           .groupBy(F.col("u").alias("node")).agg(F.sum("copies").alias("n_links"),
                                                  F.count(F.lit(1)).alias("nodes")))
    counts, joined = _count_in_blocks(crowd, threshold)
    links = cut(few.withColumn("crowded", F.lit(False)).unionByName(counts.withColumn("crowded", F.lit(True))))
    merged = components(joined).select(F.col("node").alias("root"), F.col("root").alias("whole"))
    roots = cut(roots.join(merged, "root", "left").select("node", F.coalesce("whole", "root").alias("root")))
    return links, roots, *audit(nodes, links, threshold, sample)
