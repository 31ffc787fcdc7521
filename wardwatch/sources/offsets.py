"""A message log with offsets, and a stream that reads it as Kafka is read.

Where no broker can be reached (bounded replays, tests, backfills from an archive) messages lie
in a folder: ``batch=N/partition=P/*.parquet``, each file a run of ascending
offsets of one partition.  A batch counts once its _SUCCESS marker is there.  The
stream keeps one position a partition, starts at the earliest (or latest, or given)
offsets, takes at most ``maxOffsetsPerTrigger`` messages a micro-batch, shared out
over the partitions, and fails where messages it has not read yet were removed,
unless ``failOnDataLoss`` is off: the settings that users of Kafka know.
"""

from __future__ import annotations

import json
import sys
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, islice

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.schema import MESSAGE_SCHEMA

FORMAT = "message_log"
MAX_OFFSETS = 20_000           # of a micro-batch, as in the monitored system
ROWS_PER_FILE = 5_000
ROWS_PER_TASK = 10_000         # a task of a micro-batch reads about so many messages, of several runs if they are short
_ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
                    ("offset", pa.int64()), ("timestamp", pa.timestamp("us", tz="UTC"))])


@dataclass
class Run:
    """A file's messages: one partition's offsets from ``first`` to ``last``."""
    path: str
    partition: str
    first: int
    last: int
    rows: int

    def between(self, lo: int, hi: int) -> int:
        """About how many of its messages have offsets from ``lo`` up to, not including, ``hi``."""
        return self.rows * (min(hi, self.last + 1) - max(lo, self.first)) // (self.last + 1 - self.first)


class Log:
    """What lies in a log's folder; footers are read when they are needed, once."""

    def __init__(self, path: str):
        self.fs, self.root = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        self._batches: dict[str, dict[str, list[str]]] = {}
        self._runs: dict[str, Run] = {}
        self._ordered: dict[tuple[str, str], tuple[list[Run], list[int], list[int]]] = {}

    def _list(self, path: str) -> list[fs.FileInfo]:
        return sorted(self.fs.get_file_info(fs.FileSelector(path, allow_not_found=True)), key=lambda i: i.path)

    def batches(self) -> dict[str, dict[str, list[str]]]:
        """Files by complete batch and partition, batches in order."""
        there = {}
        for info in self._list(self.root):
            if info.base_name.startswith("batch=") and info.type == fs.FileType.Directory:
                there[info.base_name] = self._batches.get(info.base_name) or self._complete(info.path)
        self._batches = {name: files for name, files in there.items() if files is not None}
        self._ordered = {at: runs for at, runs in self._ordered.items() if at[0] in self._batches}
        return self._batches

    def _complete(self, path: str) -> dict[str, list[str]] | None:
        if self.fs.get_file_info(f"{path}/_SUCCESS").type != fs.FileType.File:
            return None
        return {p.base_name.removeprefix("partition="): [f.path for f in self._list(p.path) if f.path.endswith(".parquet")]
                for p in self._list(path) if p.base_name.startswith("partition=")}

    def run(self, path: str, partition: str) -> Run:
        if path not in self._runs:
            with self.fs.open_input_file(path) as f:
                meta = pq.ParquetFile(f).metadata
            at = meta.schema.to_arrow_schema().get_field_index("offset")
            stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
            self._runs[path] = Run(path, partition, min((s.min for s in stats), default=0),
                                   max((s.max for s in stats), default=-1), meta.num_rows)
        return self._runs[path]

    def partitions(self) -> list[str]:
        return sorted({p for files in self.batches().values() for p in files} | set(self.starts()), key=int)

    def runs(self, partition: str, position: int, end: int | None = None) -> Iterator[Run]:
        """The partition's runs that reach ``position`` or beyond and begin before ``end``, in
        order of offsets.  They are found by bisection: a micro-batch's work does not grow with the log."""
        for name, files in list(self._batches.items()):
            if (name, partition) not in self._ordered:
                some = sorted((self.run(f, partition) for f in files.get(partition, [])), key=lambda r: r.first)
                self._ordered[name, partition] = some, [r.first for r in some], list(accumulate((r.last for r in some), max))
            some, firsts, reach = self._ordered[name, partition]
            last = len(some) if end is None else bisect_left(firsts, end)
            yield from (r for r in islice(some, bisect_left(reach, position), last) if r.last >= position and r.rows)

    def starts(self) -> dict[str, int]:
        """The first offset that is kept of partitions whose head was removed."""
        at = f"{self.root}/_starts.json"
        if self.fs.get_file_info(at).type != fs.FileType.File:
            return {}
        with self.fs.open_input_stream(at) as f:
            return json.loads(f.read())

    def offsets(self, run: Run) -> pa.Array:
        with self.fs.open_input_file(run.path) as f:
            return pq.read_table(f, columns=["offset"]).column("offset").combine_chunks()


def append(messages: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Add messages (of higher offsets than any in the log) as its next batch.  One
    writer a log; a batch that fails half-way has no marker and is never read."""
    log = Log(path)
    numbers = [int(i.base_name.split("=")[1]) for i in log._list(log.root) if i.base_name.startswith("batch=")]
    (messages.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset")
     .withColumn("own", F.col("partition"))            # the folder takes one of them away
     .write.option("maxRecordsPerFile", rows_per_file).partitionBy("partition")
     .parquet(f"{path.rstrip('/')}/batch={max(numbers, default=-1) + 1:012d}"))


def expire(path: str, batches: int) -> None:
    """Remove the oldest ``batches`` batches; readers that still need them will know."""
    log = Log(path)
    old = list(log.batches().items())[:batches]
    starts = log.starts()
    for _, files in old:
        for partition, some in files.items():
            last = max((log.run(f, partition).last for f in some), default=-1)
            starts[partition] = max(starts.get(partition, 0), last + 1)
    with log.fs.open_output_stream(f"{log.root}/_starts.json") as f:
        f.write(json.dumps(starts).encode())
    for name, _ in old:
        log.fs.delete_dir(f"{log.root}/{name}")


class DataLoss(RuntimeError):
    pass


class LogReader(DataSourceStreamReader):
    """Positions are the next offsets to read, by partition."""

    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}
        self.log = Log(options["path"])
        self.cap = int(options.get("maxoffsetspertrigger", MAX_OFFSETS))
        self.strict = str(options.get("failondataloss", "true")).lower() != "false"
        self.starting = options.get("startingoffsets", "earliest")
        self.checkpoint = options.get("checkpoint")
        self.position: dict[str, int] | None = None

    def _earliest(self) -> dict[str, int]:
        starts = self.log.starts()
        return {p: max(starts.get(p, 0), next((r.first for r in self.log.runs(p, 0)), 0)) for p in self.log.partitions()}

    def initialOffset(self) -> dict:
        at = self._earliest()
        if self.starting == "latest":
            at = {p: max((r.last + 1 for r in self.log.runs(p, 0)), default=first) for p, first in at.items()}
        elif self.starting != "earliest":
            at |= {p: int(o) for p, o in json.loads(self.starting).items()}
        return at

    def _planned(self) -> dict[str, int] | None:
        """The end of the newest batch that Spark's own log of offsets holds: after a
        restart the cap counts from there."""
        if not self.checkpoint:
            return None
        where = Log(self.checkpoint)
        names = [i for i in where._list(f"{where.root}/offsets") if i.base_name.isdigit()]
        if not names:
            return None
        with where.fs.open_input_stream(max(names, key=lambda i: int(i.base_name)).path) as f:
            line = f.read().decode().strip().split("\n")[-1]
        return {p: int(o) for p, o in json.loads(line).items()}

    def latestOffset(self) -> dict:
        if self.position is None:
            self.position = self._planned() or self.initialOffset()
        parts = self.log.partitions()
        for p in parts:                                # a partition that came later is read from its start
            self.position.setdefault(p, self.log.starts().get(p, 0))
        at, left = dict(self.position), self.cap
        for share in (max(1, self.cap // max(1, len(parts))), self.cap):
            for p in parts:
                at[p], taken = self._advance(p, at[p], min(share, left))
                left -= taken
        self.position = at
        return at

    def _advance(self, partition: str, at: int, most: int) -> tuple[int, int]:
        """How far ``most`` messages of a partition reach from ``at``."""
        taken = 0
        for run in self.log.runs(partition, at):
            if taken >= most:
                break
            if run.first >= at and run.rows <= most - taken:
                at, taken = run.last + 1, taken + run.rows
                continue
            offsets = self.log.offsets(run)
            rest = offsets.filter(pc.greater_equal(offsets, at))[: most - taken]
            if len(rest):
                at, taken = rest[-1].as_py() + 1, taken + len(rest)
        return at, taken

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.position = self.position or dict(end)
        self.log.batches()
        starts, out, size = self.log.starts(), [], 0
        for p, hi in end.items():
            lo = start.get(p, starts.get(p, 0))
            if lo < starts.get(p, 0) and lo < hi:
                if self.strict:
                    raise DataLoss(f"partition {p}: offsets from {lo} on are due, those before {starts[p]} were removed")
                lo = starts[p]
            for run in self.log.runs(p, lo, hi) if lo < hi else ():
                rows = run.between(lo, hi)
                if not out or size + rows > ROWS_PER_TASK:
                    out.append([])
                    size = 0
                out[-1].append((run.path, lo, hi))
                size += rows
        return [InputPartition(pieces) for pieces in out]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for path, lo, hi in partition.value:
            with self.log.fs.open_input_file(path) as f:
                t = pq.ParquetFile(f).read()
            t = t.rename_columns(["partition" if c == "own" else c for c in t.column_names]).select(_ARROW.names)
            at = t.column("offset")
            t = t.filter(pc.and_(pc.greater_equal(at, lo), pc.less(at, hi))).cast(_ARROW)
            yield from t.to_batches()


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return MESSAGE_SCHEMA

    def streamReader(self, schema: StructType) -> LogReader:
        return LogReader(dict(self.options))


def log_source(spark: SparkSession, path: str, checkpoint: str | None = None, starting_offsets: str = "earliest",
               max_offsets_per_trigger: int = MAX_OFFSETS, fail_on_data_loss: bool = True) -> DataFrame:
    """Stream of Kafka-shaped messages from the log at ``path``.  ``checkpoint`` is the
    query's checkpoint folder: with it the cap holds from a restart's first batch on."""
    # the process that plans a Python source gets no package of ours: send the classes themselves
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LogSource)
    options = {"path": path, "startingOffsets": starting_offsets, "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
               "failOnDataLoss": str(fail_on_data_loss).lower()}
    if checkpoint:
        options["checkpoint"] = checkpoint
    return spark.readStream.format(FORMAT).options(**options).load()
