import numpy as np
import pyarrow as pa
import pytest

from wardwatch.llm import embed_dedup, topk
from wardwatch.llm.common import table


def awkward_vectors(spark, kind="float"):
    rng = np.random.default_rng(8)
    rows = []
    for label in (0, 1):
        centres = rng.normal(size=(6, 16))
        for i in range(120):
            v = centres[i % 6] + 0.12 * rng.normal(size=16) if i < 60 else rng.normal(size=16)
            rows.append((label * 1000 + i, v.tolist(), label))
    near = rows[3][1]
    rows += [(5000, near, 0), (5001, near, 0), (5001, near, 0), (5002, [2 * x for x in near], 0), (5003, near, None),
             (5004, None, 0), (5005, [], 0), (5006, [0.0] * 16, 0), (5007, [float("nan")] + near[1:], 0),
             (5008, [None, *near[1:]], 0), (5009, [float("inf")] + near[1:], 1), (5010, near[:8], 0), (5011, near[:8], 0),
             (None, near, 0), (None, [1.0] * 16, 1), (5012, [1e-30 * x for x in near], 0)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(3)


def good(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)


def links_by_brute_force(rows, threshold):
    n = len(rows)
    ok = [good(r["embedding"]) and any(r["embedding"]) and r["label"] is not None for r in rows]
    unit = []
    for r, k in zip(rows, ok, strict=True):
        x = np.array(r["embedding"], float) / np.abs(r["embedding"]).max() if k else None
        unit.append(x / np.linalg.norm(x) if k else None)
    near = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i]["label"] == rows[j]["label"]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in near[i]:
            root[find(i)] = find(j)
    groups = {}
    for i in range(n):
        groups.setdefault(find(i), []).append(i)
    name = {g: min((rows[i]["vec_id"] for i in m if rows[i]["vec_id"] is not None), default=None) for g, m in groups.items()}
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, len(near[i]), name[find(i)], r["vec_id"] is not None and r["vec_id"] == name[find(i)])
                  for i, r in enumerate(rows))


def found_by(df, **kw):
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"])
                  for r in embed_dedup.near_duplicates(df, **kw).collect())


@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_as_by_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(embed_dedup, "MEET", 16)
    monkeypatch.setattr(embed_dedup, "BLOCK", 7)
    vectors = awkward_vectors(spark, kind)
    assert found_by(vectors, k=6) == links_by_brute_force(vectors.collect(), 0.93)


def test_given_table(spark, small):
    vectors = table(spark, small, "embeddings")
    want = links_by_brute_force(vectors.collect(), 0.6)
    got = found_by(vectors, threshold=0.6)
    assert sum(g[2] for g in got) >= 0.95 * sum(w[2] for w in want) > 0 or got == want


def test_crowds_have_every_link(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=24)
    rows = [(i, (centre + 0.2 * rng.normal(size=24)).tolist(), 1) for i in range(300)]
    rows += [(1000 + i, rng.normal(size=24).tolist(), 1) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert found_by(vectors) == links_by_brute_force(vectors.collect(), 0.93)


@pytest.mark.parametrize("block", [7, 512])
def test_tight_groups_that_link_to_one_another(spark, block, monkeypatch):
    """Each fills its members' lists, the next one's members are links all the same."""
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    monkeypatch.setattr(embed_dedup, "TILE", 3)
    rng = np.random.default_rng(4)
    rows = []
    for g in range(4):                                 # a chain: 0.94 from one to the next
        turn = g * np.arccos(0.94)
        centre = np.r_[np.cos(turn), np.sin(turn), np.zeros(14)]
        rows += [(100 * g + i, (centre + 0.005 * rng.normal(size=16)).tolist(), 1) for i in range(40)]
    rows += [(1000 + i, (np.r_[np.zeros(15), 1.0] + 0.02 * rng.normal(size=16)).tolist(), 1) for i in range(40)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = links_by_brute_force(vectors.collect(), 0.93)
    assert {w[3] for w in want} == {0, 1000}
    assert found_by(vectors) == want


def test_audit_weighs_nodes_outside_the_crowd(spark):
    """One crowd, 20 pairs: the crowd's links hide no pair that is missed."""
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, *(0.01 * rng.normal(size=15)).tolist()], 1) for i in range(300)]
    for i in range(20):
        v = rng.normal(size=16)
        rows += [(1000 + 2 * i + j, (v + 0.01 * rng.normal(size=16)).tolist(), 1) for j in range(2)]
    nodes = spark.createDataFrame(rows, "node long, vec array<double>, label int").selectExpr("*", "16 as dim")
    crowd = [(i, 299, True) for i in range(300)]

    def found(pairs):
        return spark.createDataFrame(crowd + [(1000 + i, 1, False) for i in range(2 * pairs)],
                                     "node long, nodes long, crowded boolean")

    assert embed_dedup.audit(nodes, found(20), 0.93) == (1.0, True)
    assert embed_dedup.audit(nodes, found(10), 0.93) == (0.5, True)
    assert embed_dedup.audit(nodes, found(0), 0.93) == (0.0, True)


def test_recall_that_is_not_reached_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "audit", lambda *_: (0.5, True))
    monkeypatch.setattr(embed_dedup, "TRIES", 2)
    vectors = spark.createDataFrame([(i, [1.0, float(i)], 1) for i in range(9)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(RuntimeError, match="0.5000"):
        embed_dedup.near_duplicates(vectors, rounds=1)


def test_like_signs_are_parted_by_further_bits():
    """Rows in the order of their signs: near ones meet however many there are."""
    rng = np.random.default_rng(6)
    x = np.repeat(rng.normal(size=(500, 16)), 2, axis=0) + 1e-3 * rng.normal(size=(1000, 16))
    kinds = pa.schema([("node", pa.int64()), ("vec", pa.list_(pa.float64()))])
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(x.tolist(), kinds.field("vec").type)], schema=kinds)
    (signed,) = embed_dedup._signs([batch], 1, 0)
    order = np.argsort([s[0] for s in signed.column("signs").to_pylist()], kind="stable")
    rows = batch.take(pa.array(order)).add_column(0, "run", pa.array(np.zeros(1000, np.int64)))
    for size in (70, 1000):                            # however the rows come in batches
        parts = [rows.slice(i, size) for i in range(0, 1000, size)]
        found = pa.Table.from_batches(list(embed_dedup._neighbours_in_order(parts, 2, 8)))
        pairs = set(zip(found.column("u").to_pylist(), found.column("v").to_pylist(), strict=True))
        assert len(pairs) == found.num_rows == 2000
        assert sum((i, i ^ 1) in pairs for i in range(1000)) >= 900


def test_no_vectors(spark):
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed_dedup.near_duplicates(nothing).count() == 0
    assert topk.top_k(nothing, nothing).count() == 0
    invalid = spark.createDataFrame([(1, None, 1), (2, [0.0], 1)], "vec_id long, embedding array<float>, label int")
    assert found_by(invalid) == [(False, 1, 0, 1, True), (False, 2, 0, 2, True)]


def top_by_brute_force(rows, queries, k):
    ints = {}
    for r in rows:
        if r["vec_id"] is not None and good(r["embedding"]):
            ints.setdefault(r["vec_id"], []).append([int(np.floor(256 * x)) for x in r["embedding"]])
    out = []
    for q in queries:
        best = []
        for c, vs in ints.items():
            scores = [sum(a * b for a, b in zip(v, w, strict=True)) for v in vs for w in ints.get(q, []) if len(v) == len(w)]
            if c != q and scores:
                best.append((-max(scores), c))
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(best)[:k])]
    return sorted(out)


def found_top(vectors, queries, k):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(vectors, queries, k).collect())


@pytest.mark.parametrize("k", [1, 5, 400])
def test_top_k_as_by_brute_force(spark, k, monkeypatch):
    monkeypatch.setattr(topk, "PER_GROUP", 20)
    monkeypatch.setattr(topk, "QUERIES", 9)
    monkeypatch.setattr(topk, "ROWS", 40)
    monkeypatch.setattr(topk, "STEP", 11)
    vectors = awkward_vectors(spark)
    queries = vectors.filter("vec_id % 3 = 0 or vec_id > 4000")
    asked = {r["vec_id"] for r in queries.collect() if good(r["embedding"])}
    assert found_top(vectors, queries, k) == top_by_brute_force(vectors.collect(), asked, k)


@pytest.mark.parametrize("copies", [1, 12, 300])
def test_one_id_with_many_vectors_hides_no_other(spark, copies):
    """Its vectors have the largest bounds; the bound is over ids all the same."""
    rows = [(0, [1.0, 0.0])] + [(7, [9.0 + i / 64, i / 640]) for i in range(copies)]
    rows += [(100 + i, [0.5 + i / 64, 0.25]) for i in range(20)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = found_top(vectors, vectors.filter("vec_id = 0"), 5)
    assert len(got) == 5 and got == top_by_brute_force(vectors.collect(), [0], 5)


def test_columns_that_clash(spark):
    names = ["vec", "dim", "grp", "low", "at", "label_", "node", "root", "part", "block", "query_id", "score", "rank", "copies",
             "n_links", "component_id", "kept", "first_id", "sim", "new"]
    from pyspark.sql import functions as F
    vectors = awkward_vectors(spark)
    clash = vectors.select("*", *[F.lit("x").alias(c) for c in names])
    queries = "vec_id % 40 = 0"
    assert found_top(clash, clash.filter(queries), 3) == found_top(vectors, vectors.filter(queries), 3)
    assert found_by(clash) == found_by(vectors)


def test_rows_below_the_bound_are_not_sent(spark):
    """One tight group of queries far from most rows."""
    rng = np.random.default_rng(6)
    rows = [(i, (np.r_[4.0, np.zeros(7)] + 0.01 * rng.normal(size=8)).tolist()) for i in range(50)]
    rows += [(1000 + i, (np.r_[-4.0, np.zeros(7)] + 0.01 * rng.normal(size=8)).tolist()) for i in range(500)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = vectors.filter("vec_id < 10")
    assert found_top(vectors, queries, 5) == top_by_brute_force(vectors.collect(), range(10), 5)
    x = np.floor(256 * np.array([r[1] for r in rows]))
    p = x[:10].mean(axis=0)
    radius = {(8, 0): float(np.linalg.norm(x[:10] - p, axis=1).max())}
    (_, _, low, high), = topk._bounds(x, {8: p[None]}, radius)
    reach = np.sort(low)[-6]
    assert (high >= reach).sum() <= 50


def test_bounds_hold():
    rng = np.random.default_rng(7)
    q, x = rng.integers(-300, 300, (40, 12)).astype(float), rng.integers(-300, 300, (200, 12)).astype(float)
    p = q.mean(axis=0)
    radius = {(12, 0): float(np.linalg.norm(q - p, axis=1).max())}
    (_, _, low, high), = topk._bounds(x, {12: p[None]}, radius)
    score = q @ x.T
    assert (low <= score.min(axis=0)).all() and (score.max(axis=0) <= high).all()


def test_given_table_top_k(spark, small):
    vectors = table(spark, small, "embeddings")
    queries = [r["vec_id"] for r in vectors.filter("vec_id % 50 = 0").collect()]
    assert found_top(vectors, vectors.filter("vec_id % 50 = 0"), 5) == top_by_brute_force(vectors.collect(), queries, 5)


def test_big_components_stay_exact(spark):
    rows = [(i, [float(2 ** 40 + 3 * i), float(i)]) for i in range(20)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    rows = [{"vec_id": i, "embedding": [x / 2 ** 20 for x in v]} for i, v in rows]
    scaled = spark.createDataFrame([(r["vec_id"], r["embedding"]) for r in rows], vectors.schema)
    assert found_top(scaled, scaled, 3) == top_by_brute_force(rows, range(20), 3)
