"""Cached law XML, one file per law, by Spark's own XML reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_laws(spark: SparkSession, path: str, row_tag: str = "Article", schema: str | None = None) -> DataFrame:
    """One row per element row_tag; give a schema for anything but a look, as inferring reads the data twice."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("attributePrefix", "_")
    return (reader.schema(schema) if schema else reader).load(path)
