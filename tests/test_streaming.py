"""Stateful streaming tests on fixed multi-file sequences: lateness against the
one-minute watermark, de-duplication across batches and across a restart
from the checkpoint."""

import datetime as dt
import json
import os
import tempfile
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from wardwatch.sources import lake
from wardwatch.streaming import job


def msg(offset, when, patient="P-1", hr=72.0):
    value = json.dumps(dict(patient_id=patient, device_id="D-1",
                            timestamp=when.strftime("%Y-%m-%d %H:%M:%S.000"),
                            heart_rate=hr, spo2=97.0, systolic_bp=120.0, diastolic_bp=80.0,
                            body_temp=36.8, steps=100 + offset, fall_detected=False))
    return dict(key=patient.encode(), value=value.encode(), topic="vitals", partition=0,
                offset=offset, timestamp=when.replace(tzinfo=dt.timezone.utc))


SCHEMA = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()),
                    ("partition", pa.int32()), ("offset", pa.int64()),
                    ("timestamp", pa.timestamp("us", tz="UTC"))])


def write_batches(folder, batches, start_index=0):
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 1000
    for i, rows in enumerate(batches, start=start_index):
        path = os.path.join(folder, f"batch-{i:03d}.parquet")
        pq.write_table(pa.Table.from_pylist(rows, SCHEMA), path)
        os.utime(path, (base + 10 * i, base + 10 * i))   # arrival order = file order


def at(minute, second):
    return dt.datetime(2026, 1, 1, 0, minute, second)


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="wardwatch-stream-test-")


def run(spark, src, sink, name):
    q = job.start(job.layers(job.file_source(spark, src, max_files_per_trigger=1))[name],
                  name, sink, available_now=True)
    q.awaitTermination()
    return q


def test_late_rows_against_one_minute_watermark(spark, workdir):
    src = os.path.join(workdir, "in")
    write_batches(src, [[msg(0, at(0, 10))], [msg(1, at(10, 0))], [msg(2, at(0, 20))],
                        [msg(3, at(0, 30)), msg(4, at(20, 0))]])
    sink = job.Sink(os.path.join(workdir, "lake"), os.path.join(workdir, "ckpt"))
    q = run(spark, src, sink, "gold_vitals_1min")
    out = lake.read_layer(spark, sink.path("gold_vitals_1min"), "vitals_1min").collect()
    got = {r["window_start"].strftime("%H:%M"): r["readings"] for r in out}
    # the 9 min 40 s late row still counts (its window was not evicted yet);
    # the next late row is dropped; the 00:20 window is still open
    assert got == {"00:00": 2, "00:10": 1}
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"]
                  for p in q.recentProgress if p["stateOperators"])
    assert dropped == 1


def test_dedup_within_batch_next_batch_and_after_restart(spark, workdir):
    src = os.path.join(workdir, "in")
    a, b, c = at(0, 10), at(0, 20), at(0, 40)
    write_batches(src, [[msg(0, a), msg(1, a)], [msg(2, a), msg(3, b, patient="P-2")]])
    sink = job.Sink(os.path.join(workdir, "lake"), os.path.join(workdir, "ckpt"))
    run(spark, src, sink, "silver_vitals")
    first = lake.read_layer(spark, sink.path("silver_vitals"), "vitals").count()
    assert first == 2
    write_batches(src, [[msg(4, a), msg(5, c, patient="P-3")]], start_index=2)
    run(spark, src, sink, "silver_vitals")       # restart from the same checkpoint
    rows = lake.read_layer(spark, sink.path("silver_vitals"), "vitals").collect()
    assert sorted((r["patient_id"], r["event_time"]) for r in rows) == \
        [("P-1", a), ("P-2", b), ("P-3", c)]


def test_alerts_stream_equals_batch(spark, workdir, tiny):
    from wardwatch.operators import transforms as tx
    from wardwatch.plans.layers import Layers
    L = Layers(spark, tiny)
    src = os.path.join(workdir, "in")
    L.messages.write.parquet(src)
    sink = job.Sink(os.path.join(workdir, "lake"), os.path.join(workdir, "ckpt"))
    job.run_bounded(spark, job.file_source(spark, src), sink, alert_time=tx.replay_as_of(),
                    only=["gold_alerts", "bronze_raw_vitals"])
    streamed = lake.read_layer(spark, sink.path("gold_alerts"), "alerts")
    assert streamed.exceptAll(L.alerts).count() == 0 and L.alerts.exceptAll(streamed).count() == 0
    bronze = lake.read_layer(spark, sink.path("bronze_raw_vitals"), "raw_vitals")
    assert bronze.count() == L.bronze.count()


def test_kafka_options():
    o = job.kafka_options("broker:9092", "vitals")
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "vitals",
                 "startingOffsets": "earliest", "failOnDataLoss": "true"}
    assert job.kafka_options("b", "t", max_offsets_per_trigger=9, fail_on_data_loss=False).items() >= {
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "9"}.items()


def test_command_line_once_writes_all_four_layers(spark, workdir, tiny):
    from wardwatch.plans.layers import Layers
    from wardwatch.streaming.__main__ import main
    L = Layers(spark, tiny)
    src = os.path.join(workdir, "in")
    L.messages.write.parquet(src)
    main(["--lake", os.path.join(workdir, "lake"), "--checkpoints", os.path.join(workdir, "ck"),
          "--files", src, "--once"])
    counts = {t: lake.read_layer(spark, os.path.join(workdir, "lake", t), t).count()
              for t in ("raw_vitals", "vitals", "alerts", "vitals_1min")}
    assert counts["raw_vitals"] == L.bronze.count()
    assert counts["vitals"] == L.silver.count()
    assert counts["alerts"] == L.alerts.count()
    assert 0 < counts["vitals_1min"] <= L.features.count()
    # external tables over the running sinks read through the sink manifests
    made = lake.register_tables(spark, os.path.join(workdir, "lake"), database="ww_stream")
    assert set(made) == {"raw_vitals", "vitals", "alerts", "vitals_1min"}
    assert spark.sql("select count(*) from ww_stream.vitals").first()[0] == counts["vitals"]


def test_running_queries_pick_up_new_files(spark, workdir):
    """Processing-time triggers (not available-now): files that land while the
    four queries run reach every layer; stopping leaves committed output."""
    inbox = os.path.join(workdir, "in")
    os.makedirs(inbox)
    sink = job.Sink(os.path.join(workdir, "lake"), os.path.join(workdir, "ckpt"))
    qs = [job.start(df, name, sink, trigger="1 second")
          for name, df in job.layers(job.file_source(spark, inbox)).items()]
    try:
        write_batches(inbox, [[msg(0, at(0, 10), hr=130.0), msg(1, at(0, 20))],
                              [msg(2, at(3, 0))]])
        deadline = time.time() + 120
        for q in qs:
            q.processAllAvailable()
        assert time.time() < deadline
    finally:
        for q in qs:
            q.stop()
    n = {t: lake.read_layer(spark, sink.path(name), t).count()
         for name, t in job.TABLES.items()}
    assert n["raw_vitals"] == 3 and n["vitals"] == 3 and n["alerts"] == 1
    assert n["vitals_1min"] == 1        # window 00:00 closed by the 00:03 reading; 00:03 still open


def test_files_of_a_batch_are_bounded(spark, workdir):
    """However many tasks hold the rows, a date gets at most files_per_date files."""
    import glob
    src = os.path.join(workdir, "in")
    rows = [msg(i, at(0, 10) + dt.timedelta(days=i % 3), patient=f"P-{i}", hr=150.0) for i in range(300)]
    write_batches(src, [rows[:100], rows[100:200], rows[200:]])
    sink = job.Sink(os.path.join(workdir, "lake"), os.path.join(workdir, "ckpt"), files_per_date=2)
    for name in ("bronze_raw_vitals", "gold_alerts"):
        job.run_bounded(spark, job.file_source(spark, src), sink, only=[name])
        for date in glob.glob(sink.path(name) + "/*_date=*"):
            assert 1 <= len(glob.glob(date + "/*.parquet")) <= 2
        assert lake.read_layer(spark, sink.path(name), job.TABLES[name]).count() == 300


def test_a_failing_layer_stops_the_others(spark, workdir):
    src = os.path.join(workdir, "in")
    write_batches(src, [[msg(0, at(0, 10))]])
    sink = job.Sink(os.path.join(workdir, "lake"), os.path.join(workdir, "ckpt"))
    os.makedirs(os.path.dirname(sink.path("gold_alerts")))
    with open(sink.path("gold_alerts"), "w") as f:        # a file where the layer's folder should be
        f.write("x")
    with pytest.raises(Exception):
        job.run_bounded(spark, job.file_source(spark, src), sink)
    assert not spark.streams.active


def test_scratch_folders_end_with_the_driver(tmp_path):
    import subprocess
    import sys
    code = ("from wardwatch.session import build, scratch; s = build('local[1]', 1, "
            f"spark__checkpoint__dir='file://{tmp_path}/shared'); p = scratch(s, 'x'); s.range(3).write.parquet(p + '/t'); "
            "print('AT', p); s.stop()")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout
    path = out.split("AT ")[1].strip().removeprefix("file:")
    assert path.startswith(str(tmp_path)) and not os.path.exists(path)
