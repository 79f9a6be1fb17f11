"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "citylake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and AQE; `conf` keys use `__` for dots.

    No master is forced: on a cluster spark-submit names it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first partition column, from folder names alone: no file is opened."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    names = [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder that every executor can reach.

    The cluster names that folder in `spark.checkpoint.dir`. Only a local-mode
    session may fall back to this machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = os.path.join(tempfile.gettempdir(), "citylake")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
