"""Plan shape: pruning reaches the scan, partial aggregation before every
shuffle of a hot key, window group limit, bounded broadcasts only."""

import pytest

from wardwatch.operators import replay, risk
from wardwatch.plans.catalog import CATALOG
from wardwatch.plans.layers import Layers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_used_columns(spark, tiny):
    p = plan(CATALOG["q2_alert_counts"](spark, tiny))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p
    assert "props" not in p


def test_dedup_and_features_combine_map_side(spark, tiny):
    L = Layers(spark, tiny)
    p = plan(L.silver)
    assert "SortAggregate" not in p and "row_number(), 1, Partial" in p and "row_number(), 1, Final" in p
    p = plan(L.features)
    assert "partial_count" in p and "partial_avg" in p


def test_last_n_windows_use_window_group_limit(spark, tiny):
    L = Layers(spark, tiny)
    p = plan(risk.recent(risk.rule_scored(L.labelled)))
    assert "WindowGroupLimit" in p and "5, Partial" in p   # trimmed before the shuffle


def test_top_k_is_computed_once_and_joined_after_the_limit(spark, tiny):
    p = plan(CATALOG["q3_top_risky"](spark, tiny))
    assert "TakeOrderedAndProject" in p
    assert p.count("FileScan parquet [event_id") == 1
    assert p.index("Join") < p.index("TakeOrderedAndProject")   # join sits above the limit


def test_gap_segments_order_globally_only_one_row_a_block(spark, tiny):
    p = plan(replay.gap_segments(Layers(spark, tiny).silver, 240))
    assert p.count("SinglePartition") == 1        # the running sum over the block table
    assert "event_id" not in p                    # all from the written bucket table


def test_scalars_are_subqueries_not_joins(spark, tiny):
    p = plan(CATALOG["kpi_row"](spark, tiny))
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_bucketed_copies_group_and_join_without_shuffle(spark, tiny):
    import tempfile
    from wardwatch.operators import reports
    from wardwatch.sources import lake
    root = tempfile.mkdtemp(prefix="wardwatch-bucket-test-")
    L = Layers(spark, tiny)
    spark.sql("create database if not exists ww_bucket")
    silver = lake.write_bucketed(L.silver, "ww_bucket.vitals", f"{root}/vitals", 4,
                                 order=["event_time"])
    patients = lake.write_bucketed(L.patients, "ww_bucket.patients", f"{root}/patients", 4)
    out = reports.q1_patient_vitals(silver, patients)
    p = plan(out)
    body = p[p.index("SortMergeJoin") if "SortMergeJoin" in p else 0:]
    assert "Exchange hashpartitioning" not in body        # aggregate and join are co-located
    assert out.count() == reports.q1_patient_vitals(L.silver, L.patients).count()


@pytest.mark.parametrize("name,most", [
    ("kpi_row", 1), ("focus_patient", 1), ("vital_series", 1), ("alerts_by_type", 2), ("newest_alerts", 2),
    ("gap_segments", 1), ("longest_segment", 1), ("replay_slice", 2), ("replay_alerts", 2),
    ("replay_shift", 2), ("replay_alerts_shift", 2), ("reconcile_layers", 2), ("q6_data_quality", 2),
    ("q3_top_risky", 1), ("patient_risk_rules", 1)])
def test_input_is_read_this_often(spark, tiny, reads, name, most):
    """With the scan's own splits: no repartition that branches could share."""
    events = spark.read.parquet(f"{tiny}/events.parquet").count()
    assert 0 < reads(lambda: CATALOG[name](spark, tiny), tiny) <= most * events


def test_input_is_dealt_out_only_on_request(spark, tiny):
    assert "Exchange" not in plan(Layers(spark, tiny).messages)
    assert "hashpartitioning(event_id" in plan(Layers(spark, tiny, input_partitions=3).messages)


def test_focus_patient_filters_below_the_dedup(spark, tiny):
    p = plan(CATALOG["vital_series"](spark, tiny))
    assert "LeftSemi" not in p


def test_vote_aggregates_by_hash(spark, tiny):
    p = plan(CATALOG["risk_vote"](spark, tiny))
    vote = p[: p.index("WindowGroupLimit")]
    assert "HashAggregate" in vote and "SortAggregate" not in vote
