"""Session settings the engine relies on, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording the Python line of every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Lets the CSV source decode GBK files.
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(app: str = "barlake", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A :func:`shared_folder` that goes when the session's JVM ends."""
    folder = shared_folder(spark, name)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Where the session names no such folder, one below the warehouse folder is taken, which a
    cluster shares as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.conf.get("spark.sql.warehouse.dir") + "/barlake-work"
    return f"{root.rstrip('/')}/barlake-{name}-{uuid.uuid4().hex}"
