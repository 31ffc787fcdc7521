"""A commit log over the lake's batch tables: several tables change in one step.

``_log/N.json`` is version N: for every table the parts (folders of files) that
make it up.  A writer first stages its parts, then adds the next version by
put-if-absent; whoever comes second looks at what was committed meanwhile and
either goes on (appends, other tables) or fails with :class:`Conflict`.  A reader
pins one version and sees all tables as of it, whatever is written meanwhile; what a
writer staged before it died is in no version, and :meth:`CommitLog.vacuum` removes it.

Each part has a zone map, a small table of its files with their rows, bytes and first and
last event time, written by Spark beside it.  Readers of a recent slice choose
files by it, and the inventory sums it up, without opening any data file.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ZONES = "file string, rows bigint, bytes bigint, first timestamp, last timestamp"
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


class Conflict(RuntimeError):
    """A table that this commit replaces, or adds to, was replaced meanwhile."""


@dataclass
class Change:
    """New rows of a table: added to it, or in its place.  ``time`` names the column that
    its zone map is kept on; rows are then clustered by it."""
    df: DataFrame
    time: str | None = None
    append: bool = False


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # --- files -----------------------------------------------------------------
    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    @property
    def _fs(self):
        return self._path(self.root).getFileSystem(self._conf)

    def _name(self, version: int) -> str:
        return f"{self.root}/_log/{version:020d}.json"

    def _put(self, version: int, text: str) -> bool:
        """Create the version's file, whole or not at all; False if it is there."""
        fs, target = self._fs, self._path(self._name(version))
        fs.mkdirs(target.getParent())
        staged = self._path(f"{self.root}/_log/.{uuid.uuid4().hex}")
        if fs.getUri().getScheme() == "file":          # a hard link is never made twice
            local = staged.toUri().getPath()
            with open(local, "w") as f:
                f.write(text)
            try:
                os.link(local, target.toUri().getPath())
                return True
            except FileExistsError:
                return False
            finally:
                os.remove(local)
        out = fs.create(staged, False)
        out.write(bytearray(text.encode()))
        out.close()
        options = self._jvm.org.apache.hadoop.fs.Options
        no_overwrite = self.spark.sparkContext._gateway.new_array(options.Rename, 1)
        no_overwrite[0] = options.Rename.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf).rename(
                staged, target, no_overwrite)
            return True
        except Py4JJavaError:
            fs.delete(staged, False)
            if fs.exists(target):
                return False
            raise

    # --- versions -----------------------------------------------------------------
    def versions(self) -> list[int]:
        at = self._path(f"{self.root}/_log")
        if not self._fs.exists(at):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(at)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self) -> int:
        """The newest version; 0 before the first commit."""
        return max(self.versions(), default=0)

    def entry(self, version: int) -> dict:
        if version == 0:
            return {"version": 0, "tables": {}, "wrote": {}}
        stream = self._fs.open(self._path(self._name(version)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def pin(self, version: int | None = None) -> Snapshot:
        return Snapshot(self.spark, self.entry(self.version() if version is None else version))

    # --- writing -------------------------------------------------------------------
    def stage(self, table: str, change: Change) -> dict:
        """Write a part and its zone map; no version refers to them yet."""
        part = f"{self.root}/{table}/{uuid.uuid4().hex}"
        df = change.df
        if change.time:
            df = df.repartitionByRange(change.time).sortWithinPartitions(change.time)
        df.write.parquet(f"{part}/rows")
        written = self.spark.read.schema(change.df.schema).parquet(f"{part}/rows")
        when = F.col(change.time) if change.time else F.lit(None).cast("timestamp")
        (written.groupBy(F.col("_metadata.file_path").alias("file"))
         .agg(F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes"),
              F.min(when).alias("first"), F.max(when).alias("last")).write.parquet(f"{part}/zones"))
        zones = self.spark.read.schema(ZONES).parquet(f"{part}/zones")
        total = zones.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                          F.unix_micros(F.max("last")).alias("last")).first()
        return {"path": part, "files": total["files"], "rows": total["rows"], "last": total["last"]}

    def commit(self, changes: dict[str, Change], base: int | None = None) -> int:
        """Make all changes in one new version and return it.  ``base`` is the version that
        they were made from (default: the newest as the commit begins)."""
        base = self.version() if base is None else base
        staged = {table: self.stage(table, change) for table, change in changes.items()}
        while True:
            now = self.version()
            tables = self.entry(now)["tables"]
            for version in range(base + 1, now + 1):
                wrote = self.entry(version)["wrote"]
                lost = [t for t, c in changes.items() if wrote.get(t) == "replace" or (t in wrote and not c.append)]
                if lost:
                    raise Conflict(f"{', '.join(lost)}: changed by version {version}, this commit is based on {base}")
            for table, change in changes.items():
                schema, old = json.loads(change.df.schema.json()), tables.get(table) if change.append else None
                if old and [(f["name"], f["type"]) for f in old["schema"]["fields"]] != [
                        (f["name"], f["type"]) for f in schema["fields"]]:
                    raise ValueError(f"{table}: the rows to add have other columns")
                tables[table] = {"time": change.time, "schema": schema,
                                 "parts": (old["parts"] if old else []) + [staged[table]]}
            wrote = {t: "append" if c.append else "replace" for t, c in changes.items()}
            if self._put(now + 1, json.dumps({"version": now + 1, "at": time.time(), "wrote": wrote, "tables": tables})):
                return now + 1

    def vacuum(self, keep: int = 10, grace_seconds: float = 24 * 3600) -> list[str]:
        """Remove versions but the newest ``keep``, and parts in none of those that are
        older than ``grace_seconds`` (a commit under way has parts in no version yet)."""
        versions, fs = self.versions(), self._fs
        kept = {p["path"].split("/")[-1] for v in versions[-keep:] for t in self.entry(v)["tables"].values() for p in t["parts"]}
        for version in versions[:-keep]:
            fs.delete(self._path(self._name(version)), False)
        removed, before = [], (time.time() - grace_seconds) * 1000
        for table in fs.listStatus(self._path(self.root)):
            if table.getPath().getName().startswith("_"):
                continue
            for part in fs.listStatus(table.getPath()):
                if part.getPath().getName() not in kept and part.getModificationTime() <= before:
                    fs.delete(part.getPath(), True)
                    removed.append(f"{table.getPath().getName()}/{part.getPath().getName()}")
        return removed


class Snapshot:
    """All tables as of one version."""

    def __init__(self, spark: SparkSession, entry: dict):
        self.spark, self.version, self.tables = spark, entry["version"], entry["tables"]

    def _schema(self, name: str) -> StructType:
        return StructType.fromJson(self.tables[name]["schema"])

    def table(self, name: str) -> DataFrame:
        """The whole table; KeyError if this version has none of that name."""
        paths = [f"{p['path']}/rows" for p in self.tables[name]["parts"]]
        return self.spark.read.schema(self._schema(name)).parquet(*paths)

    def zones(self, name: str, since: int | None = None) -> DataFrame:
        """Files of the table; with ``since`` (microseconds) of the parts that reach it."""
        paths = [f"{p['path']}/zones" for p in self.tables[name]["parts"]
                 if since is None or (p["last"] is not None and p["last"] >= since)]
        return self.spark.read.schema(ZONES).parquet(*paths) if paths else self.spark.createDataFrame([], ZONES)

    def recent_files(self, name: str, since: dt.datetime) -> list[str]:
        """Files with a row at or after ``since`` (without a zone: UTC)."""
        since = since.replace(tzinfo=dt.timezone.utc) if since.tzinfo is None else since
        at = round((since - EPOCH) / dt.timedelta(microseconds=1))
        return [r["file"] for r in self.zones(name, at).filter(F.unix_micros("last") >= at).select("file").collect()]

    def newest(self, name: str) -> dt.datetime | None:
        """The newest event time, by the log alone."""
        last = max((p["last"] for p in self.tables[name]["parts"] if p["last"] is not None), default=None)
        return None if last is None else EPOCH + dt.timedelta(microseconds=last)

    def recent(self, name: str, since: dt.datetime) -> DataFrame:
        """Rows at or after ``since``, from the files that can hold one."""
        since = since.replace(tzinfo=dt.timezone.utc) if since.tzinfo is None else since
        files, at = self.recent_files(name, since), round((since - EPOCH) / dt.timedelta(microseconds=1))
        if not files:
            return self.spark.createDataFrame([], self._schema(name))
        return (self.spark.read.schema(self._schema(name)).parquet(*files)
                .filter(F.col(self.tables[name]["time"]) >= F.timestamp_micros(F.lit(at))))

    def inventory(self) -> DataFrame:
        """table_name, files, rows, bytes, oldest and newest of each table."""
        out = None
        for name in sorted(self.tables):
            one = self.zones(name).agg(
                F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("files"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
                F.min("first").alias("oldest"), F.max("last").alias("newest"))
            out = one if out is None else out.unionByName(one)
        return out if out is not None else self.spark.createDataFrame(
            [], "table_name string, files bigint, rows bigint, bytes bigint, oldest timestamp, newest timestamp")
