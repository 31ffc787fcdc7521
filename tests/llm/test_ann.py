import numpy as np
import pytest
from pyspark.sql import functions as F
from test_vectors import awkward_vectors, good

from wardwatch.llm import ann
from wardwatch.llm.common import table


def nearest_by_brute_force(rows, asked, k):
    held = {}
    for r in rows:
        if r["vec_id"] is not None and good(r["embedding"]) and any(r["embedding"]):
            held.setdefault(r["vec_id"], []).append(np.array(r["embedding"], float))
    out = {}
    for q in asked:
        best = []
        for c, vs in held.items():
            far = [np.sqrt(((v - w) ** 2).sum()) for v in vs for w in held.get(q, []) if len(v) == len(w)]
            if c != q and far:
                best.append((min(far), c))
        if best:
            out[q] = sorted(best)[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        mine = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(mine) + 1
        mine.append((r["score"], r["vec_id"]))
    return out


def equal(got, want):
    assert got.keys() == want.keys()
    for q, best in want.items():
        assert [c for _, c in got[q]] == [c for _, c in best], q
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in best], rtol=1e-13, atol=0)


def small_parts(monkeypatch):
    for name, value in (("PER_PART", 20), ("ROWS", 30), ("QUERIES", 9)):
        monkeypatch.setattr(ann, name, value)


@pytest.mark.parametrize(("kind", "k"), [("float", 1), ("double", 10), ("float", 400)])
def test_every_part_gives_the_true_neighbours(spark, kind, k, monkeypatch):
    small_parts(monkeypatch)
    more = spark.createDataFrame([(77, [float(i), *[1.0] * 15], 0) for i in range(12)], "vec_id long, embedding array<double>, label int")
    vectors = awkward_vectors(spark, kind).unionByName(more.withColumn("embedding", F.col("embedding").cast(f"array<{kind}>")))
    queries = vectors.filter("vec_id % 3 = 0 or vec_id > 4000 or vec_id = 77")
    rows = vectors.collect()
    equal(found(ann.nearest_neighbours(vectors, queries, k, target=1.0)),
          nearest_by_brute_force(rows, {r["vec_id"] for r in queries.collect()}, k))


def clustered(spark, n=4000, groups=40):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(groups, 16))
    x = centres[rng.integers(0, groups, n)] + 0.15 * rng.normal(size=(n, 16))
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)


def test_a_part_of_the_rows_gives_most_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "PER_PART", 250)
    vectors = clustered(spark)
    queries = vectors.filter("vec_id % 20 = 0")
    index = ann.build(vectors, sample=1500)
    assert index.rows.count() == 4000 and index.rows.select("part").distinct().count() == 16
    asked = ann._clean(queries)
    reach = ann.reach_for(index, asked, 10, 0.95, audit=100)
    want = nearest_by_brute_force(vectors.collect(), [r["vec_id"] for r in queries.collect()], 10)
    got = found(ann.nearest_neighbours(vectors, queries, 10, sample=1500))
    hit = [len({c for _, c in got[q]} & {c for _, c in best}) for q, best in want.items()]
    assert np.mean(hit) >= 9.0 and all(len(g) == 10 for g in got.values())
    sizes = np.bincount([r["part"] for r in index.rows.collect()], minlength=16)
    x = np.array([r["vec"] for r in asked.collect()], float)
    tried = ann._mass_before(index.routers[16].probabilities(x)) < reach
    assert (tried * sizes).sum() <= 0.5 * 200 * 4000


def test_given_table(spark, small):
    vectors = table(spark, small, "embeddings")
    queries = vectors.filter("vec_id % 100 = 0")
    want = nearest_by_brute_force(vectors.collect(), [r["vec_id"] for r in queries.collect()], 10)
    got = found(ann.nearest_neighbours(vectors, queries))
    assert np.mean([len({c for _, c in got[q]} & {c for _, c in b}) for q, b in want.items()]) >= 9.0


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(1)
    x = np.repeat(rng.normal(size=(4, 8)) * 5, 64, axis=0) + 0.1 * rng.normal(size=(256, 8))
    u, v = ann.neighbour_graph(x, 6)
    part = ann.balanced_parts(256, u, v, 4)
    assert np.bincount(part).tolist() == [64] * 4 and (part[u] == part[v]).all()
    noise = rng.normal(size=(501, 8))
    u, v = ann.neighbour_graph(noise)
    part = ann.balanced_parts(501, u, v, 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.max() - sizes.min() <= 3 and (part[u] == part[v]).mean() > 2 / 8
    assert ann.neighbour_graph(noise[:1])[0].size == 0


def test_router_learns_where_neighbours_lie():
    rng = np.random.default_rng(2)
    x = np.repeat(rng.normal(size=(8, 12)) * 2, 50, axis=0) + 0.2 * rng.normal(size=(400, 12))
    p = ann.fit_router(x, 4).probabilities(x)
    assert np.allclose(p.sum(axis=1), 1) and (p.max(axis=1) > 0.8).mean() > 0.8
    before = ann._mass_before(p)
    assert (before.min(axis=1) == 0).all() and (before < 1).all()


def test_distances_of_odd_sizes():
    a = np.array([[1e200, 0], [3e-200, 0], [0, 0], [1.5, 2]])
    b = np.array([[-1e200, 0], [0, 4e-200], [0, 0], [1.5, 0]])
    assert np.allclose(ann.distances(a, b), [2e200, 5e-200, 0, 2], rtol=1e-15)
    at, ids, far = ann.nearest(a[:1], np.array([9]), a, np.arange(4), 2)
    assert ids.tolist() == [0, 1] and far[0] == 0 and far[1] == 1e200


def test_copies_of_a_third_of_all_rows(spark, monkeypatch):
    small_parts(monkeypatch)
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(100)] + [(7, [1.0, 2.0, 3.0])] * 50
    rows += [(200 + i, rng.normal(size=3).tolist()) for i in range(150)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = vectors.filter("vec_id % 10 = 0")
    equal(found(ann.nearest_neighbours(vectors, queries, 5, target=1.0)),
          nearest_by_brute_force(vectors.collect(), {r["vec_id"] for r in queries.collect()}, 5))


def test_few_none_and_clashing(spark):
    kinds = "vec_id long, embedding array<float>, label int"
    nothing = spark.createDataFrame([], kinds)
    assert ann.nearest_neighbours(nothing, nothing).count() == 0
    few = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, 0.0], 1), (4, None, 1)], kinds)
    assert found(ann.nearest_neighbours(few, few)) == {1: [(2 ** 0.5, 2)], 2: [(2 ** 0.5, 1)]}
    assert ann.nearest_neighbours(few, nothing).count() == 0
    clash = few.select("*", *[F.lit("x").alias(c) for c in ("vec", "dim", "part", "block", "chunk", "blocks", "chunks", "score",
                                                           "rank", "query_id", "number", "draw", "n", "at", "far", "b")])
    assert found(ann.nearest_neighbours(clash, clash)) == found(ann.nearest_neighbours(few, few))
