"""The lens: a deterministic projection of the shared test tables into the
vitals model.

``events`` rows become wearable messages (Kafka-shaped: key, value JSON,
topic, partition, offset, timestamp) and ``customer`` rows become the patient
registry.  Every step is a narrow per-row projection, so the lens scales with
its inputs and adds no shuffle.  Integer arithmetic throughout; doubles only
as multiples of 0.25 / 0.5, so sums are exact in any order.

Time is compressed by 5,000 (30 days -> about 8.6 minutes) so that a patient
sends several readings per minute.  About 1 % of messages are re-delivered
30 s later with a new offset, and a few readings are injected as sensor
errors, as alert-worthy spikes, falls and fevers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.schema import TIMESTAMP_FORMAT

# --- fixed values of the lens (shared with the SQL oracle text) -------------
BASE_US = 1704067200000000        # 2024-01-01 00:00:00 UTC in microseconds
TIME_COMPRESSION = 5000
TOPIC = "vitals"
KAFKA_PARTITIONS = 3
REDELIVERY_EVERY = 97             # event ids divisible by this arrive twice
REDELIVERY_DELAY_S = 30
ID_WIDTH = 6                      # shorter ids are padded to it, longer ones stay whole
# --- end of fixed values ------------------------------------------------------


def _cohort(p: Column, low, medium, high) -> Column:
    """Pick a per-cohort constant: 12 of 20 patients low, 5 medium, 3 high."""
    return F.when(p < 12, low).when(p < 17, medium).otherwise(high)


def _cohort_sql(low: str, medium: str, high: str) -> str:
    return f"case when p < 12 then {low} when p < 17 then {medium} else {high} end"


def _padded_sql(key: str) -> str:
    """At least ID_WIDTH digits; ``lpad`` alone would cut longer ids off."""
    text = f"cast({key} as string)"
    return f"lpad({text}, greatest({ID_WIDTH}, length({text})), '0')"


def padded_id(prefix: str, key: str) -> Column:
    return F.expr(f"concat('{prefix}', {_padded_sql(key)})")


def profile_of(patient_id: Column) -> Column:
    """Hidden cohort of a lens patient (low / medium / high)."""
    p = F.substr(patient_id, F.lit(3)).cast("bigint") % 20
    return _cohort(p, F.lit("low"), F.lit("medium"), F.lit("high"))


# The projection is written as SQL expression text: one JVM call per column
# instead of one per operator keeps plan construction cheap.
_READING_EXPRS = [
    "event_id",
    f"concat('P-', {_padded_sql('user_id')}) as patient_id",
    f"concat('DEV-', {_padded_sql('user_id')}) as device_id",
    f"{_cohort_sql(repr('low'), repr('medium'), repr('high'))} as profile",
    f"{BASE_US} + (us - {BASE_US}) div {TIME_COMPRESSION * 1000} * 1000 as et_us",
    f"""cast(case when event_id % 400 = 1 then null when event_id % 400 = 2 then -1
             when event_type = 'error' and event_id % 11 = 0 then 125 + event_id % 31
             else {_cohort_sql('72', '90', '100')} + v % 7 - 3 end as double) as heart_rate""",
    f"""cast(case when event_id % 400 = 3 then 105.0D
             when event_type = 'click' and event_id % 13 = 0 then 86.0D + (event_id % 11) * 0.5D
             else {_cohort_sql('97.5D', '94.5D', '93.5D')} + ((v div 7) % 5 - 2) * 0.5D
             end as double) as spo2""",
    f"""cast(case when event_id % 400 = 4 then 60
             when event_type = 'view' and event_id % 17 = 0 then 145 + event_id % 41
             else {_cohort_sql('116', '131', '134')} + (v div 11) % 5 - 2 end as double)
        as systolic_bp""",
    f"""cast(case when event_id % 400 = 4 then 80
             when event_type = 'view' and event_id % 17 = 0 then 92 + event_id % 31
             else {_cohort_sql('76', '82', '84')} + (v div 13) % 5 - 2 end as double)
        as diastolic_bp""",
    f"""cast(case when event_id % 400 = 5 then null
             when event_type = 'signup' and event_id % 19 = 0 then 38.25D + (event_id % 7) * 0.25D
             else {_cohort_sql('36.75D', '37.0D', '37.5D')} + ((v div 17) % 3 - 1) * 0.25D
             end as double) as body_temp""",
    "500 + event_id div 10 as steps",
    "event_type = 'purchase' and event_id % 37 = 0 as fall_detected",
    # re-delivery without a second scan: 1 or 2 copies per row
    f"explode(if(event_id % {REDELIVERY_EVERY} = 0, array(0, 1), array(0))) as copy",
]


def readings(events: DataFrame) -> DataFrame:
    """One row per delivered message: the reading fields, the hidden profile,
    event time and Kafka time in integer microseconds and the offset."""
    return (
        events.selectExpr("event_id", "user_id", "event_type",
                          "unix_micros(cast(ts as timestamp)) as us",
                          "cast(round(value * 100) as bigint) as v", "user_id % 20 as p")
        .selectExpr(*_READING_EXPRS)
        .selectExpr("* except (copy)",
                    "2 * event_id + copy as kafka_offset",       # unique at any event count
                    f"et_us + (1 + event_id % 3 + copy * {REDELIVERY_DELAY_S}) * 1000000 as kafka_us")
    )


def _json_number(name: str) -> str:
    return f"coalesce(cast({name} as string), 'null')"


# The message value, written the way the device firmware writes it.
READING_JSON = (
    "concat('{\"patient_id\": \"', patient_id, '\", \"device_id\": \"', device_id, "
    f"'\", \"timestamp\": \"', date_format(timestamp_micros(et_us), '{TIMESTAMP_FORMAT}'), "
    + ", ".join(f"'{lead}\"{c}\": ', {_json_number(c)}"
                for lead, c in [('\", ', "heart_rate"), (", ", "spo2"), (", ", "systolic_bp"),
                                (", ", "diastolic_bp"), (", ", "body_temp"), (", ", "steps"),
                                (", ", "fall_detected")])
    + ", '}')"
)


def messages(events: DataFrame) -> DataFrame:
    """Kafka-shaped messages (key, value, topic, partition, offset, timestamp)."""
    return readings(events).selectExpr(
        "cast(patient_id as binary) as key",
        f"cast({READING_JSON} as binary) as value",
        f"'{TOPIC}' as topic",
        f"cast(cast(substring(patient_id, 3) as bigint) % {KAFKA_PARTITIONS} as int) as partition",
        "kafka_offset as offset",
        "timestamp_micros(kafka_us) as timestamp",
    )


def patients(customer: DataFrame) -> DataFrame:
    """Patient registry, one row per customer (patient_id is unique)."""
    k = F.col("c_custkey")
    return customer.select(
        padded_id("P-", "c_custkey").alias("patient_id"),
        (22 + (k * 37) % 64).cast("int").alias("age"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(F.col("c_nationkey") % 4 == 0, "Cardiology")
         .when(F.col("c_nationkey") % 4 == 1, "General Medicine")
         .when(F.col("c_nationkey") % 4 == 2, "Geriatrics")
         .otherwise("Pulmonology").alias("ward"),
        F.when(k % 4 == 0, "Smartwatch").when(k % 4 == 1, "Fitness Band")
         .when(k % 4 == 2, "ECG Patch").otherwise("BP Monitor").alias("device_type"),
        padded_id("DEV-", "c_custkey").alias("device_id"),
    )
