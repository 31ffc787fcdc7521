"""Reports on hand-written rows: unmatched registry rows (NULL side of left
joins), top-k tie-breaks, pre-aggregated joins equal the join-then-group form."""

import datetime as dt

from pyspark.sql import functions as F

from wardwatch.operators import reports


def silver_rows(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [("P-1", t, 70.0, 97.0, 120.0, 80.0, 36.5), ("P-1", t + dt.timedelta(seconds=1), 80.0,
            96.0, 121.0, 81.0, 36.7), ("P-9", t, 90.0, 95.0, 130.0, 85.0, 37.0)]
    return spark.createDataFrame(rows, "patient_id string, event_time timestamp, heart_rate double, "
                                       "spo2 double, systolic_bp double, diastolic_bp double, "
                                       "body_temp double")


def patients(spark):
    return spark.createDataFrame([("P-1", 40, "Cardiology")], "patient_id string, age int, ward string")


def test_q1_keeps_readings_of_unregistered_patients(spark):
    out = {r["patient_id"]: r for r in reports.q1_patient_vitals(silver_rows(spark), patients(spark)).collect()}
    assert out["P-9"]["ward"] is None and out["P-9"]["readings"] == 1
    assert out["P-1"]["ward"] == "Cardiology" and out["P-1"]["avg_hr"] == 75.0
    assert out["P-1"]["avg_sys"] == 121.0          # 120.5 rounds half up


def alerts_rows(spark):
    t = dt.datetime(2026, 1, 1)
    rows = []
    for pid, crit, warn in [("P-1", 2, 1), ("P-2", 2, 1), ("P-3", 1, 5), ("P-9", 3, 0)]:
        rows += [(pid, "HIGH_HR", "CRITICAL", t)] * crit + [(pid, "FEVER", "WARNING", t)] * warn
    return spark.createDataFrame(rows, "patient_id string, alert_type string, severity string, "
                                       "event_time timestamp")


def test_q3_order_ties_and_unmatched(spark):
    out = reports.q3_top_risky(alerts_rows(spark), patients(spark), k=3).collect()
    assert [r["patient_id"] for r in out] == ["P-9", "P-1", "P-2"]
    assert out[0]["ward"] is None and out[0]["alert_types"] == "HIGH_HR"
    assert out[1]["age"] == 40 and out[1]["alert_types"] == "FEVER, HIGH_HR"


def test_q4_pre_aggregation_equals_join_then_group(spark, tiny):
    from wardwatch.plans.layers import Layers
    L = Layers(spark, tiny)
    w, p = L.features, L.patients
    direct = (w.join(p, "patient_id")
              .groupBy("ward", F.date_format("window_start", "yyyy-MM-dd HH:00").alias("hour_utc"))
              .agg(F.countDistinct("patient_id").alias("patients"),
                   F.sum("abnormal_readings").alias("abnormal_readings")))
    ours = reports.q4_ward_hourly(w, p).select("ward", "hour_utc", "patients", "abnormal_readings")
    assert direct.exceptAll(ours).count() == 0 and ours.exceptAll(direct).count() == 0


def test_kpi_row_without_alerts_in_window(spark):
    from wardwatch.operators import monitor
    t = dt.datetime(2026, 1, 1, 12)
    silver = spark.createDataFrame(
        [("P-1", t), ("P-2", t - dt.timedelta(seconds=90)), ("P-1", t - dt.timedelta(minutes=30))],
        "patient_id string, event_time timestamp")
    alerts = spark.createDataFrame(
        [("P-1", t - dt.timedelta(hours=2), "CRITICAL", 3.0)],
        "patient_id string, event_time timestamp, severity string, latency_sec double")
    risk_df = spark.createDataFrame([("P-1", "High"), ("P-2", "Low")], "patient_id string, risk_level string")
    r = monitor.kpi_row(silver, alerts, risk_df, minutes=10).first()
    assert r["patients_active"] == 1 and r["silver_rows"] == 3
    assert r["avg_latency_sec"] is None and r["critical_alerts"] == 0
    assert r["high_risk_patients"] == 1


def test_q4_counts_a_patient_once_even_if_registered_twice(spark, tiny):
    from wardwatch.operators import reports
    from wardwatch.plans.layers import Layers
    L = Layers(spark, tiny)
    once = {(r["ward"], r["hour_utc"]): r["patients"] for r in reports.q4_ward_hourly(L.features, L.patients).collect()}
    doubled = L.patients.union(L.patients)
    twice = {(r["ward"], r["hour_utc"]): r["patients"] for r in reports.q4_ward_hourly(L.features, doubled).collect()}
    assert once == twice
