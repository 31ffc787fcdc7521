"""Side-by-side check of a Spark query and its DuckDB oracle text.

Usable from pytest (``compare(spark, name, sf_dir)``) and as a script:
``python tests/compare.py /root/testdata/sf0.01 [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.isdir(path):
            path += "/*.parquet"
        if os.path.exists(path.removesuffix("/*.parquet")):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
                 "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def rows_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)


def rows_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    cols = [names[i] for i in order]
    data = [tuple(_norm(row[i]) for i in order) for row in rel.fetchall()]
    return cols, sorted(data, key=_key)


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    from wardwatch.plans.catalog import CATALOG
    from wardwatch.plans.oracle import QUERIES
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = CATALOG[name](spark, sf_dir)
    scols, srows = rows_spark(sdf)
    t1 = time.time()
    dcols, drows = rows_duck(con, QUERIES[name])
    t2 = time.time()
    if scols != dcols:
        return False, f"columns differ: spark={scols} oracle={dcols}"
    stypes = dict(sdf.dtypes)
    rel = con.sql(QUERIES[name])
    dtypes = dict(zip(rel.columns, (str(t) for t in rel.types)))
    wrong = {c: (stypes[c], dtypes[c]) for c in scols
             if SPARK_TO_DUCK.get(stypes[c], stypes[c]) != dtypes[c]}
    if wrong:
        return False, f"types differ: {wrong}"
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} oracle={len(drows)}"
    bad = [(a, b) for a, b in zip(srows, drows) if a != b]
    if bad:
        a, b = bad[0]
        diff = {c: (x, y) for c, x, y in zip(scols, a, b) if x != y}
        return False, f"{len(bad)} rows differ, first: {diff}"
    return True, f"{len(srows)} rows  spark {t1 - t0:.2f}s  duckdb {t2 - t1:.2f}s"


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from wardwatch.plans.catalog import CATALOG
    from wardwatch.plans.oracle import QUERIES
    from wardwatch.session import build
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or [k for k in CATALOG if k in QUERIES]
    spark = build("local[8]")
    con = duck(sf_dir)
    failed = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and continue with the next key
            ok, msg = False, f"{type(exc).__name__}: {str(exc)[:400]}"
        failed += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:24s} {msg}", flush=True)
    print(f"{len(names) - failed}/{len(names)} match")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
