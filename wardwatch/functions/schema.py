"""Declared schemas of the wire format and of every lake layer."""

from __future__ import annotations

from pyspark.sql.types import (BinaryType, BooleanType, DateType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType, TimestampType)

# --- fixed values: names, types and order of the wire format and the layers --------
# A message's JSON.  Vitals may come with or without decimals, so they are doubles; a
# step counter with decimals is a fault and parses to null.
READING_SCHEMA = StructType([
    StructField("patient_id", StringType()),
    StructField("device_id", StringType()),
    StructField("timestamp", StringType()),          # "yyyy-MM-dd HH:mm:ss.SSS", UTC
    StructField("heart_rate", DoubleType()),
    StructField("spo2", DoubleType()),
    StructField("systolic_bp", DoubleType()),
    StructField("diastolic_bp", DoubleType()),
    StructField("body_temp", DoubleType()),
    StructField("steps", LongType()),
    StructField("fall_detected", BooleanType()),
])
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"

# The columns a Kafka source yields; the file-backed stand-in yields the same.
MESSAGE_SCHEMA = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

VITALS = ["heart_rate", "spo2", "systolic_bp", "diastolic_bp", "body_temp"]

BRONZE_COLUMNS = ["kafka_key", "raw_json", "topic", "kafka_partition", "kafka_offset",
                  "kafka_time", "ingest_date"]
SILVER_COLUMNS = ["patient_id", "device_id", "event_time", *VITALS, "steps", "fall_detected",
                  "kafka_time", "event_date"]
ALERT_COLUMNS = ["alert_id", "patient_id", "device_id", "event_time", "alert_type", "severity",
                 "message", *VITALS, "fall_detected", "alert_time", "latency_sec", "event_date"]
FEATURE_COLUMNS = ["window_start", "window_end", "patient_id", "readings", "avg_hr", "max_hr",
                   "avg_spo2", "min_spo2", "avg_sys", "avg_dia", "max_sys", "avg_temp", "max_temp",
                   "steps_in_window", "falls", "abnormal_readings", "event_date"]
# Inputs of the risk model, in vector order.
MODEL_FEATURES = ["avg_hr", "max_hr", "avg_spo2", "min_spo2", "avg_sys", "avg_dia", "avg_temp",
                  "falls"]

PATIENT_SCHEMA = StructType([
    StructField("patient_id", StringType()),
    StructField("age", IntegerType()),
    StructField("gender", StringType()),
    StructField("ward", StringType()),
    StructField("device_type", StringType()),
    StructField("device_id", StringType()),
])

BRONZE_SCHEMA = StructType([
    StructField("kafka_key", StringType()),
    StructField("raw_json", StringType()),
    StructField("topic", StringType()),
    StructField("kafka_partition", IntegerType()),
    StructField("kafka_offset", LongType()),
    StructField("kafka_time", TimestampType()),
    StructField("ingest_date", DateType()),
])

SILVER_SCHEMA = StructType([
    StructField("patient_id", StringType()),
    StructField("device_id", StringType()),
    StructField("event_time", TimestampType()),
    *[StructField(c, DoubleType()) for c in VITALS],
    StructField("steps", LongType()),
    StructField("fall_detected", BooleanType()),
    StructField("kafka_time", TimestampType()),
    StructField("event_date", DateType()),
])

ALERT_SCHEMA = StructType([
    StructField("alert_id", StringType()),
    StructField("patient_id", StringType()),
    StructField("device_id", StringType()),
    StructField("event_time", TimestampType()),
    StructField("alert_type", StringType()),
    StructField("severity", StringType()),
    StructField("message", StringType()),
    *[StructField(c, DoubleType()) for c in VITALS],
    StructField("fall_detected", BooleanType()),
    StructField("alert_time", TimestampType()),
    StructField("latency_sec", DoubleType()),
    StructField("event_date", DateType()),
])

FEATURE_SCHEMA = StructType([
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("patient_id", StringType()),
    StructField("readings", LongType()),
    StructField("avg_hr", DoubleType()),
    StructField("max_hr", DoubleType()),
    StructField("avg_spo2", DoubleType()),
    StructField("min_spo2", DoubleType()),
    StructField("avg_sys", DoubleType()),
    StructField("avg_dia", DoubleType()),
    StructField("max_sys", DoubleType()),
    StructField("avg_temp", DoubleType()),
    StructField("max_temp", DoubleType()),
    StructField("steps_in_window", LongType()),
    StructField("falls", LongType()),
    StructField("abnormal_readings", LongType()),
    StructField("event_date", DateType()),
])

# --- end of fixed values -------------------------------------------------------------

LAYER_SCHEMAS = {
    "raw_vitals": BRONZE_SCHEMA,
    "vitals": SILVER_SCHEMA,
    "alerts": ALERT_SCHEMA,
    "vitals_1min": FEATURE_SCHEMA,
}
LAYER_PARTITION = {
    "raw_vitals": "ingest_date",
    "vitals": "event_date",
    "alerts": "event_date",
    "vitals_1min": "event_date",
}
