"""Lake utilities: tolerant reader, external tables, snapshots, inventory,
recent slice, patients CSV."""

import datetime as dt
import os
import tempfile

import pytest

from wardwatch.functions.schema import LAYER_SCHEMAS
from wardwatch.plans.layers import Layers
from wardwatch.sources import lake


@pytest.fixture(scope="module")
def built(spark, tiny):
    root = tempfile.mkdtemp(prefix="wardwatch-lake-test-")
    L = Layers(spark, tiny)
    L.silver.write.partitionBy("event_date").parquet(f"{root}/lake/vitals")
    L.alerts.repartition(4).write.partitionBy("event_date").parquet(f"{root}/lake/alerts")
    lake.write_patients(L.patients, f"{root}/patients")
    return root, L


def test_missing_layer_reads_empty_with_schema(spark):
    df = lake.read_layer(spark, "/nonexistent/wardwatch/vitals", "vitals")
    assert df.count() == 0 and df.schema == LAYER_SCHEMAS["vitals"]


def test_layer_round_trip_keeps_date_partition(spark, built):
    root, L = built
    back = lake.read_layer(spark, f"{root}/lake/vitals", "vitals")
    assert back.count() == L.silver.count()
    assert dict(back.dtypes)["event_date"] == "date"


def test_external_tables(spark, built):
    root, L = built
    made = lake.register_tables(spark, f"{root}/lake", f"{root}/patients", database="ww_test")
    assert set(made) == {"vitals", "alerts", "patients"}       # unwritten layers skipped
    n = spark.sql("select count(*) from ww_test.vitals").first()[0]
    assert n == L.silver.count()
    q = spark.sql("""select p.ward, count(*) from ww_test.alerts a
                     join ww_test.patients p on a.patient_id = p.patient_id group by p.ward""")
    assert sum(r[1] for r in q.collect()) == L.alerts.count()
    spark.sql("drop table ww_test.vitals")
    assert os.path.isdir(f"{root}/lake/vitals")                 # data kept


def test_patients_csv(spark, built):
    root, L = built
    p = lake.read_patients(spark, f"{root}/patients")
    assert p.count() == L.patients.count() and dict(p.dtypes)["age"] == "int"


def test_snapshots_never_expose_half_a_write(spark, built):
    root, L = built
    snap = f"{root}/risk"
    lake.write_snapshot(L.patients.limit(3), snap, run_id="001")
    lake.write_snapshot(L.patients.limit(5), snap, run_id="002")
    os.makedirs(f"{snap}/run_id=003")                           # in progress, no _SUCCESS
    assert lake.read_snapshot(spark, snap).count() == 5


def test_inventory(spark, built):
    root, L = built
    inv = lake.inventory(spark, {
        "silver": ("Silver", "vitals", f"{root}/lake/vitals"),
        "alerts": ("Gold", "alerts", f"{root}/lake/alerts"),
        "features": ("Gold", "vitals_1min", f"{root}/lake/vitals_1min")})
    got = {r["table"]: (r["rows"], r["parquet_files"]) for r in inv.collect()}
    assert got["vitals"][0] == L.silver.count() and got["vitals"][1] >= 1
    assert got["alerts"][0] == L.alerts.count()
    assert got["vitals_1min"] == (0, 0)


def test_recent_slice(spark, built):
    root, L = built
    newest = L.silver.agg({"event_time": "max"}).first()[0]
    now = newest
    recent = lake.read_recent(spark, f"{root}/lake/vitals", "vitals", 2, now)
    expect = L.silver.filter(L.silver.event_time >= now - dt.timedelta(minutes=2)).count()
    # the files were just written, so the file-time cut keeps them all
    assert recent.count() == expect


def test_compaction_keeps_rows_in_fewer_files(spark, built):
    root, L = built
    src = f"{root}/lake/vitals"
    out = lake.compact(spark, src, "vitals", f"{root}/compacted/vitals", rows_per_file=400)
    assert out.exceptAll(lake.read_layer(spark, src, "vitals")).count() == 0
    assert out.count() == L.silver.count()
    files = out.select("_metadata.file_path").distinct().count()
    assert files <= L.silver.count() // 400 + 2 * out.select("event_date").distinct().count() + 8


def test_sql_text_over_registered_lake(spark, built):
    """Report SQL written against the lake tables runs through spark.sql."""
    from wardwatch.operators import reports, risk
    root, L = built
    lake.register_tables(spark, f"{root}/lake", f"{root}/patients", database="ww_sql")
    pr = risk.patient_risk(risk.rule_scored(L.labelled))
    lake.write_snapshot(pr.select("patient_id", "risk_level", "risk_score"), f"{root}/pr", "001")
    lake.register_snapshot(spark, f"{root}/pr", database="ww_sql")
    q2 = spark.sql("""SELECT alert_type, severity, COUNT(*) AS alerts,
                             COUNT(DISTINCT patient_id) AS patients_affected
                      FROM ww_sql.alerts GROUP BY alert_type, severity""")
    ours = reports.q2_alert_counts(L.alerts).select("alert_type", "severity", "alerts",
                                                    "patients_affected")
    assert q2.exceptAll(ours).count() == 0 and ours.exceptAll(q2).count() == 0
    q7 = spark.sql("""SELECT risk_level, COUNT(*) AS patients FROM ww_sql.patient_risk
                      GROUP BY risk_level""")
    assert {r[0]: r[1] for r in q7.collect()} == \
        {r["risk_level"]: r["patients"] for r in reports.q7_risk_mix(pr).collect()}


def test_recent_slice_skips_old_files(spark, built):
    import glob
    root, L = built
    src = f"{root}/lake/alerts"
    files = sorted(glob.glob(f"{src}/event_date=*/*.parquet"))
    old = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc).timestamp()
    for f in files[: len(files) // 2]:
        os.utime(f, (old, old))                 # written long before the window
    # event times are 2024-01-01 00:00-00:09: a 60-minute window ending 00:10
    # keeps every row by time, so only the file-time cut removes rows
    keep = lake.read_recent(spark, src, "alerts", 60, dt.datetime(2024, 1, 1, 0, 10))
    fresh = files[len(files) // 2:]
    assert keep.count() == (spark.read.parquet(*fresh).count() if fresh else 0)
    assert keep.count() < L.alerts.count()


@pytest.fixture()
def damaged(spark, tmp_path, tiny):
    """A layer of four files, one of them cut short."""
    import glob
    src = f"{tmp_path}/vitals"
    Layers(spark, tiny).silver.repartition(4).write.partitionBy("event_date").parquet(src)
    files = sorted(glob.glob(f"{src}/event_date=*/*.parquet"))
    bad = files[1]
    with open(bad, "r+b") as f:
        f.truncate(os.path.getsize(bad) // 2)
    os.remove(os.path.join(os.path.dirname(bad), f".{os.path.basename(bad)}.crc"))
    return src, bad


def test_an_unreadable_file_is_an_error_unless_left_out_by_name(spark, damaged, tiny):
    src, bad = damaged
    with pytest.raises(Exception):
        lake.read_layer(spark, src, "vitals").count()
    some = lake.read_layer(spark, src, "vitals", tolerant=True).count()
    assert 0 < some < Layers(spark, tiny).silver.count()
    (row,) = lake.skipped_files(spark, src, "vitals").collect()
    assert row["file"].endswith(os.path.basename(bad)) and row["length"] == os.path.getsize(bad)


def test_compaction_keeps_all_rows_or_fails(spark, damaged, tmp_path, built):
    src, _ = damaged
    root, L = built
    dst = f"{tmp_path}/compacted/vitals"
    before = lake.compact(spark, f"{root}/lake/vitals", "vitals", dst).count()
    assert before == L.silver.count()
    with pytest.raises(Exception):
        lake.compact(spark, src, "vitals", dst)
    assert lake.read_layer(spark, dst, "vitals").count() == before          # untouched


def test_recent_slice_is_the_same_in_any_zone(spark, built):
    root, L = built
    now = L.silver.agg({"event_time": "max"}).first()[0].replace(tzinfo=dt.timezone.utc)
    want = None
    for hours in (0, 14, -11):
        moved = now.astimezone(dt.timezone(dt.timedelta(hours=hours)))
        n = lake.read_recent(spark, f"{root}/lake/vitals", "vitals", 2, moved).count()
        want = n if want is None else want
        assert n == want > 0
    assert lake.read_recent(spark, f"{root}/lake/vitals", "vitals", 2, now.replace(tzinfo=None)).count() == want


def test_newest_snapshot_is_the_last_written(spark, built, tmp_path):
    root, L = built
    snap = f"{tmp_path}/snap"
    assert lake.newest_snapshot(spark, snap) is None
    with pytest.raises(FileNotFoundError):
        lake.read_snapshot(spark, snap)
    for i, run in enumerate(("9", "10")):
        lake.write_snapshot(L.patients.limit(i + 1), snap, run)
        t = 1_700_000_000 + i
        os.utime(f"{snap}/run_id={run}/_SUCCESS", (t, t))
    assert lake.read_snapshot(spark, snap).count() == 2
