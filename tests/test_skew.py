"""A hot patient: a third of all messages belong to one patient.  Results must
stay whole and equal to the oracle; no operator may depend on keys being
spread evenly."""

import tempfile

import pytest

from compare import compare, duck


@pytest.fixture(scope="module")
def skewed_dir(spark, tiny):
    out = tempfile.mkdtemp(prefix="wardwatch-skew-test-")
    ev = spark.read.parquet(f"{tiny}/events.parquet")
    hot = ev.selectExpr("event_id", "ts", "if(event_id % 3 = 0, 0, user_id) as user_id",
                        "event_type", "value", "props")
    hot.write.parquet(f"{out}/events.parquet")
    spark.read.parquet(f"{tiny}/customer.parquet").write.parquet(f"{out}/customer.parquet")
    return out


@pytest.mark.parametrize("name", ["silver_vitals", "vitals_1min", "q1_patient_vitals",
                                  "q2_alert_counts", "q3_top_risky", "risk_vote",
                                  "patient_summary", "recent_windows", "gap_segments"])
def test_hot_patient_matches_oracle(spark, skewed_dir, name):
    ok, msg = compare(spark, name, skewed_dir, duck(skewed_dir))
    assert ok, msg


def test_hot_patient_really_is_hot(spark, skewed_dir):
    from pyspark.sql import functions as F
    from wardwatch.plans.layers import Layers
    s = Layers(spark, skewed_dir).silver
    top = s.groupBy("patient_id").count().orderBy(F.desc("count")).first()
    assert top["patient_id"] == "P-000000" and top["count"] > s.count() / 3


@pytest.fixture(scope="module")
def copies_dir(spark, tiny):
    """A third of all messages are copies of one reading (same patient and
    time): a stuck device re-sending."""
    out = tempfile.mkdtemp(prefix="wardwatch-copies-test-")
    ev = spark.read.parquet(f"{tiny}/events.parquet")
    first = ev.orderBy("event_id").first()
    stuck = ev.selectExpr(
        "event_id",
        f"if(event_id % 3 = 0, timestamp_ntz '{first['ts']}', ts) as ts",
        f"if(event_id % 3 = 0, {first['user_id']}, user_id) as user_id",
        "event_type", f"if(event_id % 3 = 0, {first['value']}, value) as value", "props")
    stuck.write.parquet(f"{out}/events.parquet")
    spark.read.parquet(f"{tiny}/customer.parquet").write.parquet(f"{out}/customer.parquet")
    return out


@pytest.mark.parametrize("name", ["silver_vitals", "vitals_1min", "q1_patient_vitals",
                                  "q2_alert_counts", "alerts"])
def test_hot_group_of_copies_matches_oracle(spark, copies_dir, name):
    ok, msg = compare(spark, name, copies_dir, duck(copies_dir))
    assert ok, msg
