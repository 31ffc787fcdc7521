import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardwatch.llm import sharding
from wardwatch.llm.common import table


def test_sizes_checksums_and_slots(awkward):
    rows = sharding.place(awkward).collect()
    texts = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in awkward.collect())
    want = sorted((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in texts)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in rows) == want
    for shard in range(8):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_key_decides_and_growth_only_fills_the_new_shard(awkward, spark, small):
    rows = sharding.place(table(spark, small, "documents")).collect()
    assert {r["grown_shard"] for r in rows if r["grown_shard"] != r["shard"]} == {8}
    moved = sum(r["grown_shard"] != r["shard"] for r in rows) / len(rows)
    assert 0.07 < moved < 0.16
    assert max(Counter(r["shard"] for r in rows).values()) < 1.4 * len(rows) / 8
    by_key = {}
    for r in sharding.place(awkward).collect():
        assert by_key.setdefault(r["doc_id"], r["shard"]) == r["shard"]


def test_runs_are_numbered_without_gaps(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "cast(id as string) as text").union(
        spark.range(2000).selectExpr("cast(1 as long)", "'same'"))
    rows = sharding.place(docs, rows_per_run=50).collect()
    for shard in range(8):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_equal_rows_are_dealt_over_the_runs(spark):
    docs = spark.createDataFrame([(None, None)] * 900, "doc_id long, text string").repartition(5)
    out = sharding.place(docs, rows_per_run=100)
    assert sorted(r["slot"] for r in out.collect()) == list(range(900))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "row#" in plan                              # the run's hash takes the row's number


def test_a_changed_weight_moves_rows_only_within_its_subtree(spark):
    def shards(tree):
        df = spark.range(3000).withColumn("shard", sharding.shard_of(F.col("id"), tree))
        return {r["id"]: r["shard"] for r in df.collect()}

    before = {"a": {"k": {0: 1, 1: 1}, "l": {2: 2}}, "b": {"m": {3: 1, 4: 3}}}
    after = {"a": {"k": {0: 1, 1: 1}, "l": {2: 2}}, "b": {"m": {3: 2, 4: 2}}}       # b keeps its weight
    one, two = shards(before), shards(after)
    assert all(one[i] == two[i] for i in one if one[i] < 3)
    assert {(one[i], two[i]) for i in one if one[i] != two[i]} == {(4, 3)}
    share = Counter(one.values())
    assert share[4] > 2 * share[3] and abs(share[2] - 750) < 150


def test_weights_must_be_positive():
    with pytest.raises(ValueError):
        sharding.shard_of(None, {"r": {"k": {0: 0.0}}})


def test_clashing_columns_and_no_rows(clashing, empty):
    assert sharding.place(clashing).count() == clashing.count()
    assert sharding.place(empty).count() == 0


def test_native_plan(awkward):
    plan = sharding.place(awkward)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
