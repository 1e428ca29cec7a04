"""Folders that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def hadoop(spark: SparkSession, at: str):
    """A path and its file system, whatever store it is in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one that spark.checkpoint.dir names; it goes with the driver's JVM."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="statuta-")
    at = f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path, files = hadoop(spark, at)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return at


def put(df: DataFrame, at: str) -> DataFrame:
    """Writes df and gives it back as read."""
    df.write.mode("overwrite").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
