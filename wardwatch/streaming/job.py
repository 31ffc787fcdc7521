"""The four streaming layers: Bronze, Silver, Gold alerts, Gold one-minute
features, each an independent append-mode Parquet query with its own
checkpoint, partitioned by date.

The layer logic is the batch code (``operators``); only Silver and the
features add the streaming parts (watermark + state).  Sources: Kafka (the
connector jar must be on the classpath) or a folder of Kafka-shaped message
files, which is what tests and bounded replays use.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules
from ..functions.schema import MESSAGE_SCHEMA
from ..operators import features as feat
from ..operators import transforms as tx
from ..sources.offsets import log_source

# fixed values: trigger of each layer in the monitored system (alerts fastest)
TRIGGERS = {"bronze_raw_vitals": "10 seconds", "silver_vitals": "5 seconds",
            "gold_alerts": "3 seconds", "gold_vitals_1min": "10 seconds"}
TABLES = {"bronze_raw_vitals": "raw_vitals", "silver_vitals": "vitals",
          "gold_alerts": "alerts", "gold_vitals_1min": "vitals_1min"}
PARTITION = {"bronze_raw_vitals": "ingest_date", "silver_vitals": "event_date",
             "gold_alerts": "event_date", "gold_vitals_1min": "event_date"}
DEDUP_WATERMARK = "2 minutes"
WINDOW_WATERMARK = "1 minute"


def kafka_options(bootstrap: str, topic: str, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """Offsets that have aged out stop the query unless ``fail_on_data_loss`` is
    off; a batch takes all there is unless ``max_offsets_per_trigger`` throttles."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """Kafka messages (key, value, topic, partition, offset, timestamp, ...)."""
    return spark.readStream.format("kafka").options(**kafka_options(bootstrap, topic, **kw)).load()


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Kafka-shaped message files (Parquet) as a stream; the file count per
    micro-batch is the rate limit, as offsets per trigger are for Kafka."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def layers(messages: DataFrame, alert_time: Column | None = None) -> dict[str, DataFrame]:
    """Streaming DataFrames of the four layers over one message source.

    Alerts and features read the clean readings, not Silver: a re-delivered
    reading is one Silver row but counts twice there, as in the monitored
    system (pass Silver yourself to change that).
    """
    clean = tx.clean(tx.parse(messages))
    return {
        "bronze_raw_vitals": tx.bronze(messages),
        "silver_vitals": tx.silver_stream(clean, DEDUP_WATERMARK),
        "gold_alerts": tx.alerts(clean, alert_time),
        "gold_vitals_1min": feat.one_minute(clean, watermark=WINDOW_WATERMARK),
    }


@dataclass
class Sink:
    """Where the layers go.  A task writes its rows as they come, up to
    ``rows_per_file`` a file; with ``files_per_date`` set, a batch instead writes at
    most so many files for each date in it, at the price of a shuffle onto as many tasks."""
    lake_root: str
    checkpoint_root: str
    files_per_date: int | None = None
    rows_per_file: int = 5_000_000

    def path(self, name: str) -> str:
        return f"{self.lake_root.rstrip('/')}/{TABLES[name]}"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{name}"


def start(df: DataFrame, name: str, sink: Sink, trigger: str | None = None,
          available_now: bool = False) -> StreamingQuery:
    """Append ``df`` as date-partitioned Parquet with its own checkpoint.

    No ``coalesce(1)``: that would run parse and rules in one task.  The stateless
    layers are written by the scan's own tasks, without a shuffle, so a backlog of one
    date uses every core; few, larger files come from ``lake.compact``, a batch job writing to
    a different folder (a file-sink folder only exposes files in its manifest).
    """
    date = PARTITION[name]
    if sink.files_per_date:
        deal = F.pmod(F.xxhash64(*[c for c in df.columns if c != date]), F.lit(sink.files_per_date))
        df = df.repartition(date, deal)
    w = (df.writeStream.queryName(name).format("parquet").option("maxRecordsPerFile", sink.rows_per_file)
         .option("path", sink.path(name))
         .option("checkpointLocation", sink.checkpoint(name))
         .partitionBy(date).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger or TRIGGERS[name])
    return w.start()


def start_all(messages: DataFrame, sink: Sink, available_now: bool = False,
              alert_time: Column | None = None, only: list[str] | None = None) -> list[StreamingQuery]:
    """Start the (selected) four layer queries; they share code, not execution:
    each reads the source with its own offsets and checkpoint."""
    dfs = layers(messages, alert_time)
    started: list[StreamingQuery] = []
    try:
        for name, df in dfs.items():
            if only is None or name in only:
                started.append(start(df, name, sink, available_now=available_now))
    except Exception:
        for q in started:
            q.stop()
        raise
    return started


def run_log(spark: SparkSession, log: str, sink: Sink, name: str, alert_time: Column | None = None,
            **options) -> list[dict]:
    """Bring one layer up to the end of a message log (``sources.offsets``) and stop;
    the progress of each micro-batch.  An available-now trigger would end after one capped batch."""
    messages = log_source(spark, log, checkpoint=sink.checkpoint(name), **options)
    query = start(layers(messages, alert_time)[name], name, sink, trigger="0 seconds")
    try:
        query.processAllAvailable()
        return [p for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()


def run_bounded(spark: SparkSession, messages: DataFrame, sink: Sink,
                alert_time: Column | None = None, only: list[str] | None = None) -> None:
    """Process everything available now and stop (a replay / backfill run).  If
    one layer fails, the others are stopped too.  One-minute windows that the
    watermark has not passed at the end stay in the state, unwritten."""
    started = start_all(messages, sink, available_now=True, alert_time=alert_time, only=only)
    try:
        for q in started:
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
    finally:
        for q in started:
            q.stop()


def start_judged(messages: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Clean readings and rejected messages as two outputs of one pass: one sink with a
    folder each (``outcome=clean``, ``outcome=rejected``).  The sink's manifest takes a batch's
    files of both at once, and a batch that is run again replaces them by its id."""
    w = (tx.judged(messages).writeStream.queryName("judged").format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy("outcome").outputMode("append"))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")).start()


def read_judged(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(clean readings, rejected messages with their reasons) of :func:`start_judged`."""
    both = spark.read.parquet(path)
    return (both.filter("outcome = 'clean'").drop("outcome", "reason", "raw_json", "kafka_partition"),
            both.filter("outcome = 'rejected'").drop("outcome"))


ACCOUNT = "batch_id bigint, messages bigint, invalid bigint, late bigint, duplicates bigint, written bigint"


def run_accounted(spark: SparkSession, messages: DataFrame, sink: Sink) -> DataFrame:
    """Bring Silver up to date and account for every message, batch by batch: each is
    invalid, late (behind the watermark), a duplicate, or written.  What comes in and
    goes out is observed in the query itself, the rest is the state operator's; the rows are
    also added to ``_accounts`` beside the layers."""
    seen = tx.parse(messages).observe("delivered", F.count(F.lit(1)).alias("messages"),
                                      F.count_if(~rules.valid_reading()).alias("invalid"))
    out = tx.silver_stream(tx.clean(seen), DEDUP_WATERMARK).observe("kept", F.count(F.lit(1)).alias("written"))
    query = start(out, "silver_vitals", sink, available_now=True)
    query.awaitTermination()
    rows = []
    for p in query.recentProgress:
        seen, kept, state = p["observedMetrics"].get("delivered"), p["observedMetrics"].get("kept"), p["stateOperators"][0]
        if seen is None:
            continue
        seen, kept = (m.asDict() if hasattr(m, "asDict") else m for m in (seen, kept))
        rows.append((p["batchId"], seen["messages"], seen["invalid"], state["numRowsDroppedByWatermark"],
                     state["customMetrics"].get("numDroppedDuplicateRows", 0), kept["written"]))
    accounts = spark.createDataFrame(rows, ACCOUNT)
    accounts.coalesce(1).write.mode("append").parquet(f"{sink.lake_root.rstrip('/')}/_accounts")
    return accounts


def use_rocksdb(spark: SparkSession) -> None:
    """Keep de-dup and window state off-heap, for many patients."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
