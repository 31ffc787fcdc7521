import random

import pytest
import xxhash

from wardwatch.llm import components, simhash
from wardwatch.llm.common import table


def fingerprint(text):
    """By the definition, bit by bit."""
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(ids, fps, bits=2):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    out = {}
    for i, d in enumerate(ids):
        out.setdefault(find(i), []).append(d)
    return [min((d for d in out[find(i)] if d is not None), default=None) for i in range(len(ids))]


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    fps = [fingerprint(t) for _, t in rows]
    want = smallest_reachable([d for d, _ in rows], fps)
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted([(d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, want, strict=True)], key=key)


def test_whole_table_as_by_brute_force(spark, tiny):
    check(table(spark, tiny, "documents"))


def test_awkward_rows(awkward):
    check(awkward)


def test_clashing_columns(clashing):
    out = simhash.near_duplicates(clashing)
    assert out.count() == clashing.count()
    assert simhash.keep_one(clashing).columns == clashing.columns


def test_no_rows(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("size", [7, 64, 1000])
@pytest.mark.parametrize("shingle", [1, 2, 3])
def test_windows_lose_no_shingle(size, shingle):
    rng = random.Random(size)
    for _ in range(40):
        data = b"".join(rng.choice([b"a", b"bc", b" ", b"\n", b"def "]) for _ in range(rng.randint(0, 60)))
        runs = list(simhash._windows(data, shingle, size))
        got = sorted(h for w in runs for h in simhash._hashes(w, shingle))
        assert got == sorted(simhash._hashes(data.split(), shingle)), data


@pytest.mark.parametrize("bits", [1, 2])
def test_crowded_variants_lose_no_component(spark, bits, monkeypatch):
    """A dense ball, a chain and far strangers; small groups force every index."""
    monkeypatch.setattr(simhash, "FULL", 3)
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre ^ (1 << i) ^ (1 << j) for i in range(8) for j in range(8)} | {centre}
    chain = rng.getrandbits(64)
    for k in range(0, 60, 2):
        fps.add(chain)
        chain ^= 3 << k
    fps |= {rng.getrandbits(64) for _ in range(100)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits)
    found = edges.collect()
    assert all(((e["a"] ^ e["b"]) & (1 << 64) - 1).bit_count() <= bits for e in found)
    roots = {r["node"]: r["root"] for r in components.components(edges).collect()}
    want = smallest_reachable(signed, [f & (1 << 64) - 1 for f in signed], bits)
    got = [roots.get(f, f) for f in signed]
    assert got == want


def kept_by_brute_force(rows):
    """Texts of the rows that stay, as (doc_id, text): any row of the smallest id (else fingerprint)."""
    fps = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    roots = smallest_reachable(signed, fps, 2)
    groups = {}
    for (i, t), f, root in zip(rows, signed, roots, strict=True):
        groups.setdefault(root, []).append((i is None, i or 0, f, t or ""))
    return [{(None if m[0] else m[1], m[3]) for m in g if m[:3] == min(g)[:3]} for g in groups.values()]


def check_kept(df):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = [(r["doc_id"], r["text"] or "") for r in simhash.keep_one(df).collect()]
    want = kept_by_brute_force(rows)
    assert len(got) == len(want) and all(sum(g in w for g in got) == 1 for w in want)


def test_keep_one_keeps_exactly_one_row_of_each_group(awkward, clashing):
    check_kept(awkward)
    assert simhash.keep_one(clashing).columns == clashing.columns
    assert simhash.keep_one(clashing).count() == simhash.keep_one(awkward).count()
    # of the rows without id, the one whose text nothing else has
    assert [r["text"] for r in simhash.keep_one(awkward).collect() if r["doc_id"] is None] == ["a row without id that stands alone here"]


def test_texts_that_share_an_id_stay_apart(spark):
    """Two unlinked texts under one id are two groups; a copy under a repeated id goes."""
    one, two, three = "a b c d e f g", "q r s t u v w x", "k l m n o p"
    rows = [(3, one), (3, two), (4, two), (2, three), (3, three), (5, one), (3, one), (None, two), (None, "z z1 z2 z3"),
            (None, "z z1 z2 z3"), (6, ""), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check_kept(df)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in simhash.keep_one(df).collect()) == [
        (0, "z z1 z2 z3"), (2, three), (3, one), (3, two), (6, "")]


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (9, None), (50, 49)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 10 for i in range(10, 41)}, **{i: 100 for i in range(100, 140)}, 49: 49, 50: 49}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
