"""The driver contract in __spark_entry__.py."""

import inspect

import __spark_entry__ as entry_module
from wardwatch.plans.catalog import CATALOG


def test_entry_runs_on_the_smoke_folder_with_a_stable_schema(spark):
    a = entry_module.entry(spark)
    b = entry_module.entry(spark)
    assert a.schema == b.schema
    assert a.count() > 0


def test_queries_and_oracles_line_up():
    q, o = entry_module.queries(), entry_module.oracle_sql()
    assert set(o) <= set(q)
    for name, fn in q.items():
        assert len(inspect.signature(fn).parameters) == 2, name
    own = set(q) & set(CATALOG)
    assert own == set(CATALOG) and len(own) == 69 and len(own & set(o)) == 64
    for name in own & set(o):
        assert "from events" in o[name] and "from customer" in o[name], name   # reads the given tables
