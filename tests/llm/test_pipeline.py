import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import __spark_entry__
from wardwatch.llm import catalog, langid, packing, quality, simhash
from wardwatch.llm.common import table

ROOT = Path(__file__).resolve().parents[2]


def test_stages_keep_what_the_operators_decide(spark, tiny):
    docs = table(spark, tiny, "documents")
    labels = table(spark, tiny, "labels")
    named = langid.identify(docs).filter(f"lang_pred != 'und' and score >= {langid.MIN_SCORE}")
    ids = {r["doc_id"] for r in named.collect()}
    one = corpus_pipeline.language_id(spark, docs, tiny)
    assert one.schema == docs.schema and {r["doc_id"] for r in one.collect()} == ids
    good = {r["doc_id"] for r in quality.classify(one, labels).filter("predicted = 1").collect()}
    two = corpus_pipeline.quality_classifier(spark, one, tiny)
    assert two.schema == docs.schema and {r["doc_id"] for r in two.collect()} == good and good < ids
    first = {r["component_id"] for r in simhash.near_duplicates(two).collect()}
    three = corpus_pipeline.simhash_near_dedup(spark, two, tiny)
    assert three.schema == docs.schema and sorted(r["doc_id"] for r in three.collect()) == sorted(first)
    pieces = corpus_pipeline.run(spark, tiny)
    assert {r["doc_id"] for r in pieces.collect()} == first
    assert pieces.agg({"length": "sum"}).first()[0] == packing.pieces(three).agg({"length": "sum"}).first()[0]


def test_clean_documents_stay(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    good = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.quality_classifier(
        spark, corpus_pipeline.language_id(spark, docs, small), small).collect()}
    assert len(good - kept) <= 0.01 * len(good)


def test_stages_take_awkward_tables(spark, awkward, empty, tiny):
    for docs in (awkward, empty):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, tiny)
            out.write.format("noop").mode("overwrite").save()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "simhash_near_dedup", "packing"]


def test_sql_twins(spark, small):
    import duckdb
    con = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        con.sql(f"create view {name} as select * from '{small}/{name}.parquet'")
    for name, sql in catalog.SQL.items():
        got = catalog.QUERIES[name](spark, small)
        want = con.sql(sql).df()[got.columns]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.itertuples(index=False))), name


def test_registered():
    names = __spark_entry__.queries()
    assert set(catalog.QUERIES) | {"pipeline"} <= set(names)
    assert [k for k in catalog.QUERIES if not k.startswith("op")] == []
    assert sorted(int(k[2:].split("_")[0]) for k in catalog.QUERIES) == list(range(1, 14))
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_entry_imports_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "wardwatch"):
        (tmp_path / name).symlink_to(ROOT / name) if name.endswith(".py") else None
    (tmp_path / "wardwatch").mkdir()
    for item in (ROOT / "wardwatch").iterdir():
        if item.name != "llm":
            (tmp_path / "wardwatch" / item.name).symlink_to(item)
    code = (f"import sys; sys.path.insert(0, {str(tmp_path)!r}); import importlib.util as u; "
            f"s = u.spec_from_file_location('entry', {str(tmp_path / '__spark_entry__.py')!r}); m = u.module_from_spec(s); "
            "s.loader.exec_module(m); print(len(m.queries()), any(k.startswith('op') for k in m.queries()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, check=True).stdout
    assert int(out.split()[0]) >= 50 and out.split()[1] == "False"
