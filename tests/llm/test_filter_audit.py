import itertools
import re

import pytest
from awkward_rows import DOCS, documents
from pyspark.sql import functions as F

from wardwatch.llm import filter_audit
from wardwatch.llm.common import table


KINDS = "doc_id long, quality int, toxic int"


def masks_by_brute_force(rows):
    first = {}
    for r in rows:
        if r["doc_id"] is not None:
            text = r["text"] or ""
            first[text] = min(first.get(text, r["doc_id"]), r["doc_id"])
    for r in rows:
        text = r["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
                 "E": r["doc_id"] is not None and first[text] < r["doc_id"]}
        yield r["lang"] or "", r["doc_id"], {f for f, bad in fails.items() if bad}


def by_brute_force(rows, labels):
    good = {r["doc_id"] for r in labels if r["quality"] == 1} - {None}
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1} - {None}
    docs = [(part, fails, i in good, i in toxic) for part, i, fails in masks_by_brute_force(rows)]
    out, shapley = [], {}
    for part in {d[0] for d in docs}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            every = left
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failing = [d for d in every if f in d[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out.append([part, order, step, len(left), len(gone), len(failing) - len(gone), sum(d[1] == {f} for d in every),
                            sum(d[2] for d in gone), sum(d[3] for d in gone)])
    return sorted((*o, shapley[o[0], o[1][o[2] - 1]]) for o in out)


def written(spark, rows, path, files):
    for i in range(files):
        spark.createDataFrame(rows[i::files], DOCS).coalesce(1).write.mode("append").parquet(path)
    return path


def audited(spark, path, labels, **kw):
    return sorted(map(tuple, filter_audit.audit(spark, path, labels, **kw).collect()))


def awkward_rows():
    long = " ".join(f"w{i}" for i in range(250))
    rows = documents() + [(200 - i, long, "en" if i % 2 else "de", "s", 1) for i in range(40)]     # smaller ids come later
    rows += [(300, long + " A#", "en", "s", 1), (299, long + " A#", None, "s", 1), (299, long + " A#", "fr", "s", 1),
             (-5, long, "es", "s", 1), (None, long, "es", "s", 1), (301, "ÄÖ É X" * 40, "en", "s", 1),
             (302, "A " * 300, "en", "s", 1), (303, "*", "en", "s", 1)]
    return rows


@pytest.mark.parametrize(("files_per_batch", "texts"), [(None, 1024), (1, 16), (3, 1)])
def test_as_by_brute_force_whatever_the_batches(spark, tmp_path, monkeypatch, files_per_batch, texts):
    monkeypatch.setattr(filter_audit, "TEXTS", texts)
    rows = awkward_rows()
    path = written(spark, rows, str(tmp_path / "documents.parquet"), 6)
    labels = spark.createDataFrame([(i, i % 2, i % 3 % 2) for i in range(0, 310, 3)] + [(200, 1, None), (200, 0, 1), (None, 1, 1)], KINDS)
    want = by_brute_force([dict(zip(DOCS.names, r, strict=True)) for r in rows], labels.collect())
    assert audited(spark, path, labels, files_per_batch=files_per_batch) == want
    assert any(w[9] for w in want) and any(w[7] for w in want) and any(w[8] for w in want)


def test_given_table(spark, tiny):
    docs, labels = table(spark, tiny, "documents"), table(spark, tiny, "labels")
    want = by_brute_force(docs.collect(), labels.collect())
    assert audited(spark, f"{tiny}/documents.parquet", labels) == want
    counts = filter_audit.mask_counts(spark, f"{tiny}/documents.parquet", labels)
    assert counts.agg({"n": "sum"}).first()[0] == docs.count()


def test_smaller_ids_retract_what_was_counted(spark, tmp_path):
    """Three batches bring ids 9, 5, 7 of one text: 5 stays, 9 and 7 are copies."""
    path = str(tmp_path / "documents.parquet")
    for i in (9, 5, 7):
        spark.createDataFrame([(i, "same", "en", None, None)], DOCS).coalesce(1).write.mode("append").parquet(path)
    labels = spark.createDataFrame([(9, 1, 0)], KINDS)
    counts = filter_audit.mask_counts(spark, path, labels, files_per_batch=1)
    own = 1                                            # under 200 words
    assert sorted(map(tuple, counts.filter("n != 0").collect())) == [("en", own, 1, 0, 0), ("en", own | 16, 2, 1, 0)]


def test_a_text_of_a_third_of_all_rows_is_one_row_a_task(spark):
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"digest": [b"x"] * 500 + [b"%d" % i for i in range(500)], "id": list(range(1000)),
                                        "part": ["en"] * 1000, "mask": pa.array([1] * 1000, pa.int32()), "n": [1] * 1000,
                                        "good": [1] * 1000, "toxic": [0] * 1000})
    rows = [r for b in filter_audit._pack([batch, batch.slice(0, 0)], 8) for r in b.to_pylist()]
    assert [(r["mask"], r["n"]) for r in rows if r["digest"] is None] == [(1, 501), (17, 499)]
    assert sum(r["digest"] == b"x" for r in rows) == 1


def test_no_documents_and_clashing_columns(spark, tmp_path):
    nothing = str(tmp_path / "none.parquet")
    spark.createDataFrame([], DOCS).write.parquet(nothing)
    labels = spark.createDataFrame([(1, 1, 1)], KINDS)
    assert audited(spark, nothing, labels) == []
    assert audited(spark, nothing, labels.limit(0)) == []
    path = str(tmp_path / "clash.parquet")
    rows = documents()[:30]
    names = ["id", "digest", "part", "mask", "n", "good", "toxic", "kind", "held", "step", "own", "before", "filter_order"]
    spark.createDataFrame(rows, DOCS).select("*", *[F.lit("x").alias(c) for c in names]).write.parquet(path)
    want = by_brute_force([dict(zip(DOCS.names, r, strict=True)) for r in rows], labels.collect())
    clash = labels.select("*", *[F.lit("x").alias(c) for c in ("id", "good", "n")])
    assert audited(spark, path, clash) == want
