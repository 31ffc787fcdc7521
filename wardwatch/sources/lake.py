"""Lake access: layer reader, external tables in the catalog, the
recent-slice reader, the patients CSV, versioned snapshot writes and the
layer inventory."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schema import LAYER_PARTITION, LAYER_SCHEMAS, PATIENT_SCHEMA


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_layer(spark: SparkSession, path: str, table: str, tolerant: bool = False,
               **options: str) -> DataFrame:
    """A lake layer with its declared schema.  A missing folder reads as an
    empty table (not UNABLE_TO_INFER_SCHEMA); partition columns are recovered
    from the folder names.  A file that can't be read is an error: a streaming
    sink's manifest lists finished files only.  ``tolerant`` leaves such files
    out instead; :func:`skipped_files` names them."""
    schema = LAYER_SCHEMAS[table]
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).options(ignoreCorruptFiles=str(tolerant).lower(), basePath=path, **options)
            .parquet(path))


def skipped_files(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Files of a layer that a tolerant read got no row from: (file, length)."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet").load(path).select(F.col("path").alias("file"), "length"))
    read = read_layer(spark, path, table, tolerant=True).select(
        F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("file")).distinct()
    return listed.withColumn("file", F.regexp_replace("file", "^file:/+", "file:/")).join(read, "file", "left_anti")


def read_patients(spark: SparkSession, path: str) -> DataFrame:
    """Patients registry CSV with header and declared types."""
    return spark.read.schema(PATIENT_SCHEMA).option("header", True).csv(path)


def write_patients(patients: DataFrame, path: str) -> None:
    patients.write.mode("overwrite").option("header", True).csv(path)


def register_tables(spark: SparkSession, lake_root: str, patients_path: str | None = None,
                    database: str = "wardwatch") -> list[str]:
    """External tables over the lake folders (dropping one never deletes data).

    The column list is explicit, so a layer that has not been written yet
    still registers; a layer whose folder is missing is skipped.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    made = []
    for table, schema in LAYER_SCHEMAS.items():
        path = f"{lake_root.rstrip('/')}/{table}"
        if not _exists(spark, path):
            continue
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
        if _exists(spark, f"{path.rstrip('/')}/_spark_metadata"):
            # a streaming sink: keep reads on its manifest (only committed
            # files); date folders are discovered at read time
            spark.sql(f"CREATE TABLE {database}.{table} ({cols}) USING PARQUET LOCATION '{path}'")
        else:
            spark.sql(f"CREATE TABLE {database}.{table} ({cols}) USING PARQUET "
                      f"PARTITIONED BY ({LAYER_PARTITION[table]}) LOCATION '{path}'")
            spark.sql(f"MSCK REPAIR TABLE {database}.{table}")
        made.append(table)
    if patients_path and _exists(spark, patients_path):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in PATIENT_SCHEMA.fields)
        spark.sql(f"DROP TABLE IF EXISTS {database}.patients")
        spark.sql(f"CREATE TABLE {database}.patients ({cols}) USING CSV "
                  f"OPTIONS (header 'true') LOCATION '{patients_path}'")
        made.append("patients")
    return made


def _time_column(table: str) -> str:
    return {"raw_vitals": "kafka_time", "vitals_1min": "window_start"}.get(table, "event_time")


def read_recent(spark: SparkSession, path: str, table: str, minutes: float,
                now: dt.datetime) -> DataFrame:
    """Rows of the last ``minutes`` before ``now``: files modified since
    (now - minutes - 2 min), date partitions from that day on, then the
    exact event-time cut.  ``now`` without a zone is UTC."""
    now = now.replace(tzinfo=dt.timezone.utc) if now.tzinfo is None else now.astimezone(dt.timezone.utc)
    since = now - dt.timedelta(minutes=minutes)
    files_since = since - dt.timedelta(minutes=2)
    layer = read_layer(spark, path, table, modifiedAfter=files_since.strftime("%Y-%m-%dT%H:%M:%S"),
                       timeZone="UTC")
    since_us = round((since - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) / dt.timedelta(microseconds=1))
    return (layer.filter(F.col(LAYER_PARTITION[table]) >= F.lit(since.date()))
            .filter(F.col(_time_column(table)) >= F.timestamp_micros(F.lit(since_us))))


def write_snapshot(df: DataFrame, root: str, run_id: str | None = None) -> str:
    """Write a full snapshot under ``root/run_id=...``; readers take the
    newest complete one, so a reader never sees half a snapshot (a plain
    overwrite leaves a window with no data)."""
    run_id = run_id or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    path = f"{root.rstrip('/')}/run_id={run_id}"
    df.write.mode("error").parquet(path)
    return path


def newest_snapshot(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest snapshot by the time its _SUCCESS marker was written
    (a folder without one is not complete); None if there is none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    found = []
    for s in fs.listStatus(p):
        name, marker = s.getPath().getName(), jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")
        if s.isDirectory() and name.startswith("run_id=") and fs.exists(marker):
            found.append((fs.getFileStatus(marker).getModificationTime(), len(name), name))
    return f"{root.rstrip('/')}/{max(found)[2]}" if found else None


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest snapshot written by :func:`write_snapshot`."""
    path = newest_snapshot(spark, root)
    if path is None:
        raise FileNotFoundError(f"no complete snapshot under {root}")
    return spark.read.parquet(path)


def register_snapshot(spark: SparkSession, root: str, table: str = "patient_risk",
                      database: str = "wardwatch") -> DataFrame:
    """Expose the newest complete snapshot under ``root`` as ``database.table``
    (an external table re-pointed at each new run), so SQL text written
    against the lake tables - e.g. the risk-mix report - runs unchanged."""
    path = newest_snapshot(spark, root)
    if path is None:
        raise FileNotFoundError(f"no complete snapshot under {root}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{table}")
    spark.sql(f"CREATE TABLE {database}.{table} USING PARQUET LOCATION '{path}'")
    return spark.table(f"{database}.{table}")


def inventory(spark: SparkSession, layers: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Per layer: files, rows, newest write - from the scan's file metadata.

    ``layers`` maps a name to (layer, table, path); of a table that is written as
    snapshots (any but the four layers) the newest one counts.  Only
    ``_metadata`` is read, so row counts come from Parquet footers; the layers
    are a union of small per-file aggregates.
    """
    parts = []
    for layer, table, path in layers.values():
        if table not in LAYER_SCHEMAS:
            path = newest_snapshot(spark, path)
        if path is None or not _exists(spark, path):
            parts.append(spark.createDataFrame(
                [(layer, table, 0, 0, None)],
                "layer string, table string, parquet_files bigint, rows bigint, "
                "last_write timestamp"))
            continue
        df = read_layer(spark, path, table) if table in LAYER_SCHEMAS else spark.read.parquet(path)
        per_file = (df.select(F.col("_metadata.file_path").alias("f"),
                              F.col("_metadata.file_modification_time").alias("m"))
                    .groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.max("m").alias("m")))
        parts.append(per_file.agg(F.count(F.lit(1)).alias("parquet_files"),
                                  F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                                  F.max("m").alias("last_write"))
                     .select(F.lit(layer).alias("layer"), F.lit(table).alias("table"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compact(spark: SparkSession, src: str, table: str, dst: str,
            rows_per_file: int = 5_000_000) -> DataFrame:
    """Rewrite a streaming layer into fewer, larger files in another folder
    (a file-sink folder only exposes files listed in its manifest, so
    compacted output cannot go back into it).

    Rows are range-clustered by (partition column, time) so each output file
    covers one date and a time range; ``maxRecordsPerFile`` bounds file size.
    The copy is written beside ``dst`` and takes its place only when it has every
    row; an unreadable source file is an error, and then ``dst`` stays as it was.
    Returns the compacted layer read back.
    """
    part, time_col = LAYER_PARTITION[table], _time_column(table)
    layer = read_layer(spark, src, table)
    staged = f"{dst.rstrip('/')}.staged-{uuid.uuid4().hex[:12]}"
    (layer.repartitionByRange(part, time_col)
          .sortWithinPartitions(part, time_col)
          .write.option("maxRecordsPerFile", rows_per_file)
          .partitionBy(part).parquet(staged))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(dst).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had, has = layer.count(), read_layer(spark, staged, table).count()
    if had != has:
        fs.delete(path(staged), True)
        raise RuntimeError(f"{src} has {had} rows, its copy {has}: not published")
    fs.delete(path(dst), True)
    fs.mkdirs(path(dst).getParent())
    if not fs.rename(path(staged), path(dst)):
        raise RuntimeError(f"could not publish {staged} as {dst}")
    return read_layer(spark, dst, table)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int,
                   key: str = "patient_id", partition_col: str | None = None,
                   order: list[str] | None = None) -> DataFrame:
    """Save a layer as a catalog table bucketed (and sorted) by ``key``.

    Tables bucketed on the same key with the same bucket count join and
    group on that key without a shuffle: the per-patient reports over a
    bucketed Silver / alerts / features copy and a bucketed registry run
    as co-located, map-side plans.  Used for the compacted batch copy of a
    layer (file-sink folders of running streams cannot be bucketed).
    """
    w = df.write.mode("overwrite").option("path", path).bucketBy(buckets, key)
    w = w.sortBy(key, *(order or []))
    if partition_col:
        w = w.partitionBy(partition_col)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
