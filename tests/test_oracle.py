"""Every SQL-expressible query against its independent DuckDB text."""

import pytest

from compare import compare, duck
from wardwatch.plans.catalog import CATALOG
from wardwatch.plans.layers import INPUT_PARTITIONS
from wardwatch.plans.oracle import QUERIES

LARGE = "/root/testdata/sf0.1"

SQL_KEYS = [k for k in CATALOG if k in QUERIES]
def test_every_query_is_registered_with_an_oracle_or_is_model_or_stream():
    rows_only = {"risk_model_eval", "window_scores", "patient_clusters", "patient_risk",
                 "model_metrics"}
    assert set(CATALOG) - set(QUERIES) == rows_only
    assert set(QUERIES) <= set(CATALOG)


@pytest.fixture(scope="module")
def con_tiny(tiny):
    return duck(tiny)


@pytest.fixture(scope="module")
def con_small(small):
    return duck(small)


@pytest.mark.parametrize("name", SQL_KEYS)
def test_matches_oracle_sf0001(spark, tiny, con_tiny, name):
    ok, msg = compare(spark, name, tiny, con_tiny)
    assert ok, msg


@pytest.mark.parametrize("name", SQL_KEYS)
def test_matches_oracle_sf001(spark, small, con_small, name):
    ok, msg = compare(spark, name, small, con_small)
    assert ok, msg


@pytest.fixture(scope="module")
def dealt_out(spark):
    """The one-file events of sf0.1, dealt out over the test's cores."""
    spark.conf.set(INPUT_PARTITIONS, "8")
    yield duck(LARGE)
    spark.conf.unset(INPUT_PARTITIONS)


@pytest.mark.parametrize("name", SQL_KEYS)
def test_matches_oracle_sf01(spark, dealt_out, name):
    ok, msg = compare(spark, name, LARGE, dealt_out)
    assert ok, msg
