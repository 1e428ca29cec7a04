"""A partitioned table that takes new rows by key: only the partitions that they fall into are written again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statuta.sources.scratch import hadoop, put, scratch

#: Partitions that one merge may touch; more are merged in turns.
TURN = 1000


def _latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order, F.struct(*rest).alias("_rest")))["_rest"].alias("_rest"))
    return best.select(*keys, *(F.col(f"_rest.{c}").alias(c) for c in rest)).select(*rows.columns)


def exists(spark: SparkSession, at: str) -> bool:
    path, files = hadoop(spark, at)
    return files.exists(path)


def upsert(new: DataFrame, at: str, keys: tuple[str, ...], partitions: tuple[str, ...], order: tuple[str, ...]) -> int:
    """Merges rows into the table at a folder, and gives the number of partitions written.

    Of rows with one key the last by the columns of order stays, whether it was there or is new, so a
    merge that is run twice changes nothing.  A key must not change its partitions' columns, and
    these must not be null.  Partitions are found by their values, at most TURN at a time on the
    driver; the table is read with these values as a filter, so others are not opened, and written
    by Spark's dynamic overwrite, which leaves them as they are.  What a merge reads it has put
    aside before it writes.  Keys are compared with null as a value.
    """
    spark, cols = new.sparkSession, list(partitions)
    name = list(dict.fromkeys([*keys, *partitions]))
    new = put(_latest(new, name, list(order)), scratch(spark, "upsert") + "/new")
    found = new.select(*cols).distinct().sort(*cols)
    done = 0
    turn: list = []

    def merge() -> None:
        nonlocal done
        inside = _among(new.schema, cols, turn)
        rows = new.where(inside)
        if exists(spark, at):
            rows = table(spark, at, new.schema).where(inside).unionByName(rows)
        ready = put(_latest(rows, name, list(order)), scratch(spark, "upsert") + "/merged")
        ready.repartition(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(at)
        done += len(turn)
        turn.clear()

    for row in found.toLocalIterator():
        turn.append(tuple(row))
        if len(turn) == TURN:
            merge()
    if turn:
        merge()
    return done


def _among(schema: StructType, cols: list[str], values: list[tuple]) -> Column:
    """Whether the columns hold one of the tuples, in a form that prunes partitions: each column by its own values, then all of them."""
    lit = lambda c, x: F.lit(x).cast(schema[c].dataType)
    out = F.lit(True)
    for i, c in enumerate(cols):
        out = out & F.col(c).isin([lit(c, x) for x in sorted({v[i] for v in values})])
    if len(cols) > 1:
        out = out & F.struct(*cols).isin([F.struct(*(lit(c, x).alias(c) for c, x in zip(cols, v, strict=True))) for v in values])
    return out


def table(spark: SparkSession, at: str, schema: StructType) -> DataFrame:
    """The table, with the types of schema in its partitions' columns too."""
    return spark.read.schema(schema).parquet(at)
