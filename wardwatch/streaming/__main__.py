"""Run the four streaming layers until stopped (or once, with --once).

    python -m wardwatch.streaming --lake /lake --checkpoints /lake/_checkpoints \
        --kafka broker:9092 --topic vitals
    python -m wardwatch.streaming --lake /lake --checkpoints /ck --files /incoming --once
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..session import prepare
from . import job


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--lake", required=True, help="lake root (raw_vitals, vitals, alerts, vitals_1min)")
    ap.add_argument("--checkpoints", required=True, help="one checkpoint folder per query below this")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="folder of Kafka-shaped Parquet message files")
    ap.add_argument("--topic", default="vitals")
    ap.add_argument("--max-offsets-per-trigger", type=int, default=None,
                    help="throttle of a batch; by default it takes all there is")
    ap.add_argument("--allow-data-loss", action="store_true",
                    help="go on when Kafka no longer has the next offsets (default: stop)")
    ap.add_argument("--max-files-per-trigger", type=int, default=None)
    ap.add_argument("--once", action="store_true",
                    help="process what is available, then stop; one-minute windows still open then "
                         "are not written (they stay in the state for the next run)")
    ap.add_argument("--files-per-date", type=int, default=None,
                    help="files that a batch writes for each date, at most (default: its tasks' own files)")
    ap.add_argument("--state-partitions", type=int, default=None,
                    help="shuffle partitions of the stateful queries; fixed at the first start "
                         "of a checkpoint, so size it for the target patient count")
    ap.add_argument("--state-in-memory", action="store_true",
                    help="keep de-dup and window state on the heap instead of in RocksDB")
    a = ap.parse_args(argv)

    spark = prepare(SparkSession.builder.appName("wardwatch-streaming").getOrCreate())
    if a.state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(a.state_partitions))
    if not a.state_in_memory:
        job.use_rocksdb(spark)
    messages = (job.kafka_source(spark, a.kafka, a.topic,
                                 max_offsets_per_trigger=a.max_offsets_per_trigger,
                                 fail_on_data_loss=not a.allow_data_loss)
                if a.kafka else job.file_source(spark, a.files, a.max_files_per_trigger))
    sink = job.Sink(a.lake, a.checkpoints, a.files_per_date)
    if a.once:
        job.run_bounded(spark, messages, sink)
        return
    started = job.start_all(messages, sink)
    try:
        spark.streams.awaitAnyTermination()
    finally:                             # one layer ended or failed: stop the others
        for q in started:
            q.stop()


if __name__ == "__main__":
    main()
