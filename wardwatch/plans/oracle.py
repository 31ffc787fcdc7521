"""Independent SQL (DuckDB dialect) for every SQL-expressible query.

The texts re-derive the layers from the raw ``events`` / ``customer`` views
by a separate path: the reading fields come straight from the lens rows (no
JSON round trip), de-duplication is a ``row_number`` window, alerts are a
``UNION ALL`` of the five rules, features a plain ``GROUP BY``.

Dialect notes: DuckDB ``round`` on a double and ``printf('%.1f')`` are not
HALF_UP on the shortest decimal as Spark's are; :func:`r` and the message
formatting round through the double's shortest text as a DECIMAL instead.
``sum`` of integers is HUGEINT in DuckDB and is cast to BIGINT.
"""

from __future__ import annotations

BASE_US = 1704067200000000


def r(expr: str, n: int) -> str:
    """HALF_UP rounding of a double on its shortest decimal text (as Spark)."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38,17)), {n}) as double)"


def xavg(expr: str, scale: int) -> str:
    """Order-independent mean of values with <= ``scale`` decimals (as
    ``rules.exact_avg``): exact decimal sum, then one double division."""
    return (f"(cast(sum(cast({expr} as decimal(18,{scale}))) as double)"
            f" / nullif(cast(count({expr}) as double), 0))")


def fmt(expr: str, n: int) -> str:
    return f"printf('%.{n}f', {r(expr, n)})"


LENS = f"""
e as (
  select event_id, user_id, event_type, epoch_us(ts) as us,
         cast(round(value*100) as bigint) as v, user_id % 20 as p
  from events),
b as (
  select *, ({BASE_US} + (us-{BASE_US}) // 5000000 * 1000) as et_us,
    case when p<12 then 72 when p<17 then 90 else 100 end + v%7-3 as hr0,
    cast(case when p<12 then 97.5 when p<17 then 94.5 else 93.5 end as double)
      + cast(((v // 7)%5-2) as double)*0.5 as sp0,
    case when p<12 then 116 when p<17 then 131 else 134 end + (v // 11)%5-2 as sys0,
    case when p<12 then 76 when p<17 then 82 else 84 end + (v // 13)%5-2 as dia0,
    cast(case when p<12 then 36.75 when p<17 then 37.0 else 37.5 end as double)
      + cast(((v // 17)%3-1) as double)*0.25 as t0
  from e),
rd as (
  select event_id,
    concat('P-', lpad(cast(user_id as varchar), cast(greatest(6, length(cast(user_id as varchar))) as integer), '0')) as patient_id,
    concat('DEV-', lpad(cast(user_id as varchar), cast(greatest(6, length(cast(user_id as varchar))) as integer), '0')) as device_id,
    case when p<12 then 'low' when p<17 then 'medium' else 'high' end as profile,
    et_us,
    cast(case when event_id%400=1 then null when event_id%400=2 then -1
              when event_type='error' and event_id%11=0 then 125+event_id%31 else hr0 end as double) as heart_rate,
    cast(case when event_id%400=3 then 105.0
              when event_type='click' and event_id%13=0 then 86.0+cast(event_id%11 as double)*0.5
              else sp0 end as double) as spo2,
    cast(case when event_id%400=4 then 60
              when event_type='view' and event_id%17=0 then 145+event_id%41 else sys0 end as double) as systolic_bp,
    cast(case when event_id%400=4 then 80
              when event_type='view' and event_id%17=0 then 92+event_id%31 else dia0 end as double) as diastolic_bp,
    cast(case when event_id%400=5 then null
              when event_type='signup' and event_id%19=0 then 38.25+cast(event_id%7 as double)*0.25
              else t0 end as double) as body_temp,
    cast(500 + event_id // 10 as bigint) as steps,
    (event_type='purchase' and event_id%37=0) as fall_detected
  from b),
m as (
  select *, 2*event_id as kafka_offset, et_us + (1+event_id%3)*1000000 as kafka_us from rd
  union all
  select *, 2*event_id+1, et_us + (1+event_id%3+30)*1000000 from rd where event_id%97=0),
bronze as (
  select patient_id as kafka_key,
    concat('{{"patient_id": "', patient_id, '", "device_id": "', device_id,
           '", "timestamp": "', strftime(make_timestamp(et_us), '%Y-%m-%d %H:%M:%S.%g'),
           '", "heart_rate": ', coalesce(cast(heart_rate as varchar), 'null'),
           ', "spo2": ', coalesce(cast(spo2 as varchar), 'null'),
           ', "systolic_bp": ', coalesce(cast(systolic_bp as varchar), 'null'),
           ', "diastolic_bp": ', coalesce(cast(diastolic_bp as varchar), 'null'),
           ', "body_temp": ', coalesce(cast(body_temp as varchar), 'null'),
           ', "steps": ', coalesce(cast(steps as varchar), 'null'),
           ', "fall_detected": ', coalesce(cast(fall_detected as varchar), 'null'), '}}') as raw_json,
    'vitals' as topic,
    cast(cast(substr(patient_id, 3) as bigint) % 3 as integer) as kafka_partition,
    kafka_offset,
    make_timestamp(kafka_us) as kafka_time,
    cast(make_timestamp(kafka_us) as date) as ingest_date
  from m),
parsed as (
  select patient_id, device_id, heart_rate, spo2, systolic_bp, diastolic_bp, body_temp, steps,
         fall_detected, make_timestamp(kafka_us) as kafka_time, kafka_offset,
         make_timestamp(et_us) as event_time
  from m),
clean as (
  select patient_id, device_id, heart_rate, spo2, systolic_bp, diastolic_bp, body_temp, steps,
         coalesce(fall_detected, false) as fall_detected, kafka_time, kafka_offset, event_time
  from parsed
  where patient_id is not null and event_time is not null and steps is not null and steps >= 0
    and systolic_bp > diastolic_bp
    and heart_rate between 30 and 220 and spo2 between 70 and 100
    and systolic_bp between 70 and 250 and diastolic_bp between 40 and 150
    and body_temp between 34.0 and 42.0),
silver as (
  select patient_id, device_id, event_time, heart_rate, spo2, systolic_bp, diastolic_bp,
         body_temp, steps, fall_detected, kafka_time, cast(event_time as date) as event_date
  from (select *, row_number() over (partition by patient_id, event_time
                                     order by kafka_time, kafka_offset) as rn from clean)
  where rn = 1),
fired as (
  select *, 'HIGH_HR' as alert_type,
         case when heart_rate > 140 then 'CRITICAL' else 'WARNING' end as severity,
         concat('Heart rate ', {fmt('heart_rate', 0)}, ' bpm (limit 120)') as message
  from clean where heart_rate > 120
  union all
  select *, 'LOW_SPO2', case when spo2 < 88 then 'CRITICAL' else 'WARNING' end,
         concat('SpO2 ', {fmt('spo2', 1)}, '% (limit 92%)')
  from clean where spo2 < 92
  union all
  select *, 'HIGH_BP',
         case when systolic_bp > 180 or diastolic_bp > 120 then 'CRITICAL' else 'WARNING' end,
         concat('BP ', {fmt('systolic_bp', 0)}, '/', {fmt('diastolic_bp', 0)}, ' mmHg (limit 140/90)')
  from clean where systolic_bp > 140 or diastolic_bp > 90
  union all
  select *, 'FEVER', case when body_temp > 39.5 then 'CRITICAL' else 'WARNING' end,
         concat('Temperature ', {fmt('body_temp', 1)}, ' C (limit 38.0)')
  from clean where body_temp > 38.0
  union all
  select *, 'FALL', 'CRITICAL', 'Fall detected by wearable'
  from clean where fall_detected),
alerts as (
  select concat(patient_id, '-', strftime(event_time, '%Y%m%d%H%M%S%g'), '-', alert_type) as alert_id,
         patient_id, device_id, event_time, alert_type, severity, message,
         heart_rate, spo2, systolic_bp, diastolic_bp, body_temp, fall_detected,
         make_timestamp(epoch_us(kafka_time) + 2000000) as alert_time,
         {r('(epoch_us(kafka_time) + 2000000 - epoch_us(event_time)) / 1000000.0', 2)} as latency_sec,
         cast(event_time as date) as event_date
  from fired),
features as (
  select date_trunc('minute', event_time) as window_start,
         date_trunc('minute', event_time) + interval 1 minute as window_end,
         patient_id,
         count(*) as readings,
         {r('avg(heart_rate)', 1)} as avg_hr, max(heart_rate) as max_hr,
         {r('avg(spo2)', 2)} as avg_spo2, min(spo2) as min_spo2,
         {r('avg(systolic_bp)', 1)} as avg_sys, {r('avg(diastolic_bp)', 1)} as avg_dia,
         max(systolic_bp) as max_sys,
         {r('avg(body_temp)', 2)} as avg_temp, max(body_temp) as max_temp,
         cast(max(steps) - min(steps) as bigint) as steps_in_window,
         cast(sum(case when fall_detected then 1 else 0 end) as bigint) as falls,
         cast(sum(case when heart_rate > 120 or spo2 < 92 or systolic_bp > 140
                         or diastolic_bp > 90 or body_temp > 38.0 or fall_detected
                       then 1 else 0 end) as bigint) as abnormal_readings,
         cast(date_trunc('minute', event_time) as date) as event_date
  from clean
  group by date_trunc('minute', event_time), patient_id),
labelled as (
  select *, cast(case when rule_points >= 4 then 2.0 when rule_points >= 2 then 1.0 else 0.0 end as double)
         as label
  from (select *,
    (case when avg_hr > 110 or avg_hr < 45 then 2 when avg_hr >= 95 then 1 else 0 end
     + case when avg_spo2 < 92 then 2 when avg_spo2 < 95 then 1 else 0 end
     + case when avg_sys > 140 or avg_dia > 90 then 2 when avg_sys >= 130 or avg_dia >= 85 then 1 else 0 end
     + case when avg_temp > 38.0 then 2 when avg_temp >= 37.3 then 1 else 0 end
     + case when max_hr > 120 then 1 else 0 end
     + case when min_spo2 < 92 then 1 else 0 end
     + case when falls > 0 then 3 else 0 end) as rule_points
    from features
    where avg_hr is not null and max_hr is not null and avg_spo2 is not null and min_spo2 is not null
      and avg_sys is not null and avg_dia is not null and avg_temp is not null and falls is not null)),
patients as (
  select concat('P-', lpad(cast(c_custkey as varchar), cast(greatest(6, length(cast(c_custkey as varchar))) as integer), '0')) as patient_id,
         cast(22 + (c_custkey*37) % 64 as integer) as age,
         case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
         case c_nationkey % 4 when 0 then 'Cardiology' when 1 then 'General Medicine'
                              when 2 then 'Geriatrics' else 'Pulmonology' end as ward,
         case c_custkey % 4 when 0 then 'Smartwatch' when 1 then 'Fitness Band'
                            when 2 then 'ECG Patch' else 'BP Monitor' end as device_type,
         concat('DEV-', lpad(cast(c_custkey as varchar), cast(greatest(6, length(cast(c_custkey as varchar))) as integer), '0')) as device_id
  from customer),
recent as (
  select * from (select *, row_number() over (partition by patient_id order by window_start desc) as rn
                 from labelled) where rn <= 5),
vote as (
  select patient_id, label as risk_label, votes from (
    select patient_id, label, count(*) as votes,
           row_number() over (partition by patient_id order by count(*) desc, label desc) as k
    from recent group by patient_id, label) where k = 1),
summary as (
  select patient_id,
         {r('avg(label * 50.0)', 1)} as risk_score,
         count(*) as windows_used,
         max(window_end) as last_window_end,
         {r(xavg('avg_hr', 1), 1)} as avg_hr,
         {r(xavg('avg_spo2', 2), 2)} as avg_spo2,
         {r(xavg('avg_sys', 1), 1)} as avg_sys,
         {r(xavg('avg_dia', 1), 1)} as avg_dia,
         {r(xavg('avg_temp', 2), 2)} as avg_temp,
         max(rule_points) as max_rule_points
  from recent group by patient_id),
patient_risk as (
  select s.*, v.risk_label,
         case cast(v.risk_label as integer) when 0 then 'Low' when 1 then 'Medium'
                                            when 2 then 'High' end as risk_level
  from summary s join vote v using (patient_id))
"""


def with_lens(body: str) -> str:
    """Prefix the lens CTEs; a body starting with ',' adds CTEs of its own."""
    body = body.strip()
    sep = "" if body.startswith(",") else "\n"
    return f"with {LENS.strip()}{sep}{body}\n"


QUERIES: dict[str, str] = {}


def _q(name: str, body: str) -> None:
    QUERIES[name] = with_lens(body)


# --- layers -------------------------------------------------------------------
_q("patients", "select * from patients")
_q("bronze_raw", "select * from bronze")
_q("parsed_readings", "select * from parsed")
_q("clean_readings", "select * from clean")
_q("silver_vitals", "select * from silver")
_q("alerts", "select * from alerts")
_q("vitals_1min", "select * from features")

# --- reports ------------------------------------------------------------------
_q("q1_patient_vitals", f"""
select v.patient_id, p.ward, count(*) as readings,
       {r('avg(v.heart_rate)', 1)} as avg_hr, {r('avg(v.spo2)', 1)} as avg_spo2,
       {r('avg(v.systolic_bp)', 0)} as avg_sys, {r('avg(v.diastolic_bp)', 0)} as avg_dia,
       {r('avg(v.body_temp)', 2)} as avg_temp
from silver v left join patients p on v.patient_id = p.patient_id
group by v.patient_id, p.ward
order by v.patient_id""")

_q("q2_alert_counts", f"""
select alert_type, severity, count(*) as alerts, count(distinct patient_id) as patients_affected,
       {r(xavg('latency_sec', 2), 2)} as avg_latency_sec
from alerts group by alert_type, severity order by alerts desc""")

_q("q3_top_risky", """
select a.patient_id, p.age, p.ward, count(*) as total_alerts,
       cast(sum(case when a.severity = 'CRITICAL' then 1 else 0 end) as bigint) as critical_alerts,
       array_to_string(list_sort(list(distinct a.alert_type)), ', ') as alert_types
from alerts a left join patients p on a.patient_id = p.patient_id
group by a.patient_id, p.age, p.ward
order by critical_alerts desc, total_alerts desc, a.patient_id
limit 5""")

_q("q4_ward_hourly", f"""
select p.ward, strftime(w.window_start, '%Y-%m-%d %H:00') as hour_utc,
       count(distinct w.patient_id) as patients,
       {r(xavg('w.avg_hr', 1), 1)} as avg_hr,
       {r(xavg('w.avg_spo2', 2), 2)} as avg_spo2,
       cast(sum(w.abnormal_readings) as bigint) as abnormal_readings
from features w join patients p on w.patient_id = p.patient_id
group by p.ward, strftime(w.window_start, '%Y-%m-%d %H:00')
order by hour_utc, p.ward""")

_q("q5_daily_summary", f"""
select event_date, patient_id, count(*) as minutes_monitored,
       {r(xavg('avg_hr', 1), 1)} as avg_hr, max(max_hr) as peak_hr,
       min(min_spo2) as lowest_spo2, max(max_temp) as highest_temp,
       cast(sum(falls) as bigint) as falls
from features group by event_date, patient_id
order by lowest_spo2 asc nulls last, peak_hr desc nulls last, event_date, patient_id
limit 10""")

_q("q6_data_quality", """
select b.bronze_messages, s.silver_clean_readings,
       b.bronze_messages - s.silver_clean_readings as dropped_or_pending
from (select count(*) as bronze_messages from bronze) b,
     (select count(*) as silver_clean_readings from silver) s""")

_LEVEL_RANK = "case risk_level when 'High' then 1 when 'Medium' then 2 else 3 end"
_q("q7_risk_mix", f"""
select risk_level, count(*) as patients, {_LEVEL_RANK} as level_rank
from patient_risk group by risk_level order by level_rank, risk_level""")

_q("q7_risk_members", f"""
select risk_level, patient_id, {_LEVEL_RANK} as level_rank
from patient_risk order by level_rank, risk_level, patient_id""")

# --- layer checks -------------------------------------------------------------
_q("reconcile_layers", """
select count(*) as bronze_messages, max(kafka_time) as cutoff,
       (select count(*) from silver where kafka_time <= (select max(kafka_time) from bronze))
         as silver_up_to_cutoff,
       count(*) - (select count(*) from silver
                   where kafka_time <= (select max(kafka_time) from bronze)) as dropped
from bronze""")

_q("alert_matrix", """
select alert_type, severity, count(*) as alerts from alerts
group by alert_type, severity order by alert_type, severity""")

_q("latest_readings", """
select event_time, patient_id, heart_rate, spo2, systolic_bp, diastolic_bp, body_temp, steps,
       fall_detected
from silver order by event_time desc, patient_id limit 5""")

_q("latest_alerts", """
select event_time, patient_id, alert_type, severity, message, latency_sec
from alerts order by event_time desc, alert_id, latency_sec limit 5""")

_q("latest_windows", """
select window_start, patient_id, readings, avg_hr, avg_spo2, avg_sys, avg_dia, avg_temp,
       abnormal_readings
from features order by window_start desc, patient_id limit 5""")

# --- risk (rule-label variant) ------------------------------------------------
_q("risk_labels", """
select window_start, window_end, patient_id, rule_points, label from labelled""")

_q("label_distribution", """
select case cast(label as integer) when 0 then 'Low' when 1 then 'Medium' when 2 then 'High' end
         as risk_level, count(*) as windows
from labelled group by label""")

_q("recent_windows", """
select patient_id, window_start, cast(rn as integer) as rn from recent""")

_q("risk_vote", """
select patient_id, risk_label, votes from vote""")

_q("patient_summary", """
select * from summary""")

_q("patient_risk_rules", """
select patient_id, risk_level, risk_score, avg_hr, avg_spo2, avg_sys, avg_dia, avg_temp,
       max_rule_points, windows_used, last_window_end
from patient_risk order by risk_score desc, patient_id""")

_q("cluster_features", f"""
select patient_id, {xavg('avg_hr', 1)} as c_hr, {xavg('avg_spo2', 2)} as c_spo2,
       {xavg('avg_sys', 1)} as c_sys, {xavg('avg_temp', 2)} as c_temp,
       cast(sum(abnormal_readings) as double) / nullif(cast(sum(readings) as double), 0)
         as c_abnormal_rate
from labelled group by patient_id""")

_q("risk_counts", """
select risk_level, count(*) as patients from patient_risk group by risk_level""")

# --- monitoring (history window of 2 minutes before the newest Silver time) --
_NOW = "(select max(event_time) from silver)"
_SINCE = f"({_NOW} - interval 2 minute)"

_q("kpi_row", f"""
select (select count(distinct patient_id) from silver
        where event_time >= {_NOW} - interval 1 minute) as patients_active,
       (select count(*) from silver) as silver_rows,
       (select {xavg('latency_sec', 2)} from alerts where event_time >= {_SINCE}) as avg_latency_sec,
       (select count(*) from alerts where event_time >= {_SINCE} and severity = 'CRITICAL')
         as critical_alerts,
       (select count(*) from patient_risk where risk_level = 'High') as high_risk_patients""")

_FOCUS = f"""
focus as (
  select coalesce(a.pid, r.pid) as patient_id,
         case when a.pid is not null then 'alert' else 'reading' end as source
  from (select (select patient_id from alerts where event_time >= {_SINCE}
                order by event_time desc, alert_id desc, patient_id desc limit 1) as pid) a,
       (select (select patient_id from silver where event_time >= {_SINCE}
                order by event_time desc, patient_id desc limit 1) as pid) r)"""

_q("focus_patient", f""",{_FOCUS.strip()}
select f.patient_id, f.source, p.ward, p.age
from focus f left join patients p on p.patient_id = f.patient_id""")

_q("vital_series", f""",{_FOCUS.strip()}
select s.patient_id, s.event_time, 'heart_rate' as metric, s.heart_rate as value,
       cast(120 as double) as threshold, s.heart_rate > 120 as breach
from silver s join focus f on s.patient_id = f.patient_id where s.event_time >= {_SINCE}
union all
select s.patient_id, s.event_time, 'spo2', s.spo2, cast(92 as double), s.spo2 < 92
from silver s join focus f on s.patient_id = f.patient_id where s.event_time >= {_SINCE}""")

_q("alerts_by_type", f"""
select alert_type, count(*) as alerts,
       case alert_type when 'HIGH_HR' then 'High heart rate (tachycardia)'
                       when 'LOW_SPO2' then 'Low SpO2 (hypoxia)'
                       when 'HIGH_BP' then 'High blood pressure'
                       when 'FEVER' then 'Fever' when 'FALL' then 'Fall detected'
                       else alert_type end as name
from alerts where event_time >= {_SINCE} group by alert_type""")

_q("newest_alerts", f"""
select strftime(event_time, '%H:%M:%S') as time_utc, event_time, patient_id, alert_type,
       severity, message, latency_sec
from alerts where event_time >= {_SINCE}
order by event_time desc, alert_id, latency_sec limit 15""")

_q("risk_board", """
select r.patient_id, r.risk_level, r.risk_score, p.age, p.ward,
       r.avg_hr, r.avg_spo2, r.avg_sys, r.avg_dia, r.avg_temp
from patient_risk r left join patients p on p.patient_id = r.patient_id
order by r.risk_score desc, r.patient_id""")

# --- replay (gap 240 ms, trailing 30 s, clock 2025-06-01 12:00:00) ------------
_q("replay_shift", """
, bnd as (select min(epoch_us(event_time)) as lo,
                 max(epoch_us(event_time)) - min(epoch_us(event_time)) + 1000000 as len
          from silver),
  clk as (select epoch_us(timestamp '2025-06-01 12:00:00') as now_us)
select s.patient_id, s.event_time,
       make_timestamp(now_us - ((((now_us % len + len) % len) - (epoch_us(s.event_time) - lo))
                                % len + len) % len) as replay_time
from silver s, bnd, clk""")

_q("replay_alerts_shift", """
, bnd as (select min(epoch_us(event_time)) as lo,
                 max(epoch_us(event_time)) - min(epoch_us(event_time)) + 1000000 as len
          from silver),
  clk as (select epoch_us(timestamp '2025-06-01 12:00:00') as now_us)
select a.alert_id, a.event_time, a.alert_time,
       make_timestamp(now_us - ((((now_us % len + len) % len) - (epoch_us(a.event_time) - lo))
                                % len + len) % len) as replay_time
from alerts a, bnd, clk""")

_SEGMENTS = """
seg_t as (select epoch_us(event_time) as us from silver),
seg_g as (select us, case when us - lag(us) over (order by us) > 240000 then 1 else 0 end as brk
          from seg_t),
seg_n as (select us, 1 + sum(brk) over (order by us) as segment from seg_g),
segments as (
  select cast(segment as bigint) as segment, make_timestamp(min(us)) as seg_start,
         make_timestamp(max(us)) as seg_end, count(*) as readings,
         (max(us) - min(us)) / 1000000.0 as duration_sec
  from seg_n group by segment),
longest as (select * from segments order by duration_sec desc, seg_start limit 1),
slice as (
  select patient_id, device_id, event_time, heart_rate, spo2, systolic_bp, diastolic_bp,
         body_temp, steps, fall_detected, kafka_time
  from silver, longest
  where event_time >= greatest(seg_start, seg_end - interval 30 second)
    and event_time <= seg_end)"""

_q("gap_segments", f", {_SEGMENTS.strip()}\nselect * from segments")
_q("longest_segment", f", {_SEGMENTS.strip()}\nselect * from longest")
_q("replay_slice", f", {_SEGMENTS.strip()}\nselect * from slice")
_q("replay_alerts", f""", {_SEGMENTS.strip()}
select a.* exclude (event_date) from alerts a
where a.event_time >= (select min(event_time) from slice)
  and a.event_time <= (select max(event_time) from slice)""")

# --- quality profile ----------------------------------------------------------
_VALID = """(patient_id is not null and event_time is not null and steps is not null
    and steps >= 0 and systolic_bp > diastolic_bp
    and heart_rate between 30 and 220 and spo2 between 70 and 100
    and systolic_bp between 70 and 250 and diastolic_bp between 40 and 150
    and body_temp between 34.0 and 42.0)"""

_q("invalid_share", f"""
select count(*) as messages, count(*) filter (where not coalesce({_VALID}, false)) as invalid,
       cast(count(*) filter (where not coalesce({_VALID}, false)) as double)
         / nullif(count(*), 0) as share
from parsed""")

_q("alert_share", """
select count(*) as valid_readings,
       count(*) filter (where heart_rate > 120 or spo2 < 92 or systolic_bp > 140
                        or diastolic_bp > 90 or body_temp > 38.0 or fall_detected) as with_alert,
       count(*) filter (where heart_rate > 120) as high_hr,
       count(*) filter (where spo2 < 92) as low_spo2,
       count(*) filter (where systolic_bp > 140 or diastolic_bp > 90) as high_bp,
       count(*) filter (where body_temp > 38.0) as fever,
       count(*) filter (where fall_detected) as fall,
       cast(count(*) filter (where heart_rate > 120 or spo2 < 92 or systolic_bp > 140
                             or diastolic_bp > 90 or body_temp > 38.0 or fall_detected) as double)
         / nullif(count(*), 0) as share
from clean""")

_q("label_agreement", """
select profile, count(*) as windows,
       count(*) filter (where label = case profile when 'low' then 0.0 when 'medium' then 1.0
                                                   else 2.0 end) as agreeing,
       cast(count(*) filter (where label = case profile when 'low' then 0.0
                                                        when 'medium' then 1.0 else 2.0 end)
            as double) / nullif(count(*), 0) as share
from (select *, case cast(substr(patient_id, 3) as bigint) % 20 < 12 when true then 'low'
                else case when cast(substr(patient_id, 3) as bigint) % 20 < 17 then 'medium'
                          else 'high' end end as profile
      from labelled)
group by profile""")

# --- model variant: what does not depend on the fitted model --------------------
_TENTH = ("cast('0x' || substr(md5(concat_ws('|', patient_id, cast(epoch_us(window_start) as varchar))), 1, 8) "
          "as bigint) % 10")
_q("model_split", f"""
select patient_id, window_start, case when {_TENTH} < 8 then 'train' else 'test' end as side
from labelled""")

_q("model_checks", f"""
select p.n as patients, p.n as votes_agree, p.n as named, w.n as windows, w.train as train_windows,
       w.n as scores_in_range, w.n - w.train as test_windows
from (select count(distinct patient_id) as n from labelled) p,
     (select count(*) as n, count(*) filter (where {_TENTH} < 8) as train from labelled) w""")

# --- streaming layers (one available-now batch) --------------------------------
_q("stream_silver", "select patient_id, event_time, event_date, true as delivered from silver")
_q("stream_alerts", "select * from alerts")
_q("stream_vitals_1min", """
select * from features
where window_end <= (select max(event_time) from clean) - interval 1 minute""")

# --- offsets, rejects, accounts -----------------------------------------------
_q("stream_from_offsets", "select * from bronze")

_q("rejected_by_reason", """
select reason, count(*) as messages from (
  select case when patient_id is null then 'patient_id missing' when event_time is null then 'event_time missing'
              when steps is null then 'steps missing' when not coalesce(steps >= 0, false) then 'steps below zero'
              when not coalesce(systolic_bp > diastolic_bp, false) then 'systolic_bp below diastolic_bp'
              when not coalesce(heart_rate between 30 and 220, false) then 'heart_rate out of range'
              when not coalesce(spo2 between 70 and 100, false) then 'spo2 out of range'
              when not coalesce(systolic_bp between 70 and 250, false) then 'systolic_bp out of range'
              when not coalesce(diastolic_bp between 40 and 150, false) then 'diastolic_bp out of range'
              when not coalesce(body_temp between 34.0 and 42.0, false) then 'body_temp out of range' end as reason
  from parsed) where reason is not null group by reason""")

_q("stream_accounting", """
select (select count(*) from bronze) as messages, (select count(*) from parsed) - (select count(*) from clean) as invalid,
       cast(0 as bigint) as late, (select count(*) from clean) - (select count(*) from silver) as duplicates,
       (select count(*) from silver) as written, true as adds_up""")

_CLOSED = """
, closed as (select * from labelled where window_end <= (select max(event_time) from clean) - interval 1 minute),
  last5 as (select * from (select *, row_number() over (partition by patient_id order by window_start desc) as rn from closed)
            where rn <= 5),
  voted as (select patient_id, label as risk_label from (
    select patient_id, label, row_number() over (partition by patient_id order by count(*) desc, label desc) as k
    from last5 group by patient_id, label) where k = 1)"""
_q("stream_patient_risk", f"""{_CLOSED}
select l.patient_id, case cast(max(v.risk_label) as integer) when 0 then 'Low' when 1 then 'Medium' when 2 then 'High' end as risk_level,
       {r('avg(label * 50.0)', 1)} as risk_score, {r(xavg('avg_hr', 1), 1)} as avg_hr, {r(xavg('avg_spo2', 2), 2)} as avg_spo2,
       {r(xavg('avg_sys', 1), 1)} as avg_sys, {r(xavg('avg_dia', 1), 1)} as avg_dia, {r(xavg('avg_temp', 2), 2)} as avg_temp,
       max(rule_points) as max_rule_points, count(*) as windows_used, max(window_end) as last_window_end
from last5 l join voted v on l.patient_id = v.patient_id group by l.patient_id""")

# --- commit log and zone map ----------------------------------------------------
QUERIES["snapshot_read"] = QUERIES["patient_risk_rules"]
_q("recent_slice", """
select * from alerts where event_time >= (select max(event_time) from alerts) - interval 2 minute""")
_q("layer_inventory", """
select 'raw_vitals' as table_name, count(*) as rows, min(kafka_time) as oldest, max(kafka_time) as newest from bronze
union all select 'vitals', count(*), min(event_time), max(event_time) from silver
union all select 'alerts', count(*), min(event_time), max(event_time) from alerts
union all select 'vitals_1min', count(*), min(window_start), max(window_start) from features""")
_q("replay_bundle", f""", {_SEGMENTS.strip()}
select 'vitals' as table_name, count(*) as rows from slice
union all select 'alerts', count(*) from alerts
  where event_time >= (select min(event_time) from slice) and event_time <= (select max(event_time) from slice)
union all select 'patient_risk', count(*) from patient_risk
union all select 'patients', count(*) from patients
union all select 'recording', 1""")
_q("layer_reader", "select * from silver")
QUERIES["sql_alert_counts"] = QUERIES["rollup_alert_counts"] = QUERIES["q2_alert_counts"]
QUERIES["rollup_ward_hourly"] = QUERIES["q4_ward_hourly"]
_q("active_patients", """
select grain, case grain when 'all' then null else date_trunc(grain, event_time) end as start,
       count(distinct patient_id) as active_patients, count(*) as readings
from clean, (select unnest(['minute', 'hour', 'day', 'all']) as grain) group by 1, 2""")

# --- the model held against its own outputs ---------------------------------------
_q("training_gate", """
select count(*) as windows, count(*) filter (where avg_hr is not null and max_hr is not null and avg_spo2 is not null
         and min_spo2 is not null and avg_sys is not null and avg_dia is not null and avg_temp is not null
         and falls is not null) as complete,
       count(*) filter (where avg_hr is not null) >= 40 as enough
from features""")
_q("tree_agreement", "select count(*) as windows, count(*) as agreeing from labelled")
_q("model_verified", """
select count(distinct patient_id) as patients, count(distinct patient_id) as nearest, true as names_follow, true as metrics_follow
from labelled""")
