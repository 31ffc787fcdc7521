"""Session helpers: the few settings every operator relies on, and the shared
folder for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on.  ``window``, ``to_date`` and
    ``date_format`` read the session time zone; device times are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "wardwatch",
          **extra: str) -> SparkSession:
    """Session for tests, bench and local runs (cluster jobs bring their own)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         # Python call-site capture costs ~4 JVM round trips per Column call;
         # plan building of the layer stack spent ~1.5 s in it per query
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.driver.memory", "8g"))
    for k, v in extra.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written intermediates.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only when neither is set in a local session (tests) a private folder is
    created and registered, so later calls agree on it; on a cluster a
    machine-local folder would be invisible to executors, so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:                # no context access (Connect): the setting must exist
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return found
    found = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not found:
        found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not found:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            found = tempfile.mkdtemp(prefix="wardwatch-ckpt-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir() or found
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, empty sub-folder of the shared folder (one per run, never reused);
    it is deleted when the driver ends.  Tables go below it."""
    path = shared_dir(spark).rstrip("/") + f"/{name}-{uuid.uuid4().hex[:12]}"
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:                # no context access (Connect): the folder stays
        return path
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    fs.mkdirs(folder)                # only a folder that exists can be marked
    fs.deleteOnExit(folder)
    return path


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_package_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    bundle = Path(tempfile.mkdtemp(prefix="ship-")) / "wardwatch_package.zip"
    with zipfile.ZipFile(bundle, "w") as z:
        for file in sorted((root / "wardwatch").rglob("*.py")):
            z.write(file, file.relative_to(root))
    sc.addPyFile(str(bundle))
    sc._package_shipped = True
