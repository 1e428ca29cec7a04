"""Questions as a stream: anonymised on arrival, counted by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.sources.questions import prepare


def anonymized(stream: DataFrame) -> DataFrame:
    """Stateless, so any output mode and trigger will do."""
    return prepare(stream)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Writes what has arrived to Parquet, each row once however often the query is started again."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def counts(stream: DataFrame, width: str = "1 hour", late: str = "10 minutes", time: str = "ts", by: str = "event_type") -> DataFrame:
    """Events per window and kind; state older than the watermark is dropped with its windows."""
    windows = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by)
    return windows.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n")


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream of the Parquet table called name in a folder, one file or a folder of files, with its own schema."""
    known = spark.read.parquet(f"{folder}/{name}").schema
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return spark.readStream.schema(known).parquet(f"{folder}/{name}")
    return spark.readStream.schema(known).option("pathGlobFilter", name).parquet(folder)
