"""Sessions of a stream, and keyed state with timers.

Both read a stream whose rows may come late or twice, keep state until the watermark has passed it,
and write every result once, however often the query is started again on its checkpoint.  What
comes later than the watermark allows is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from statuta.functions.times import micros
from statuta.sources.scratch import hadoop, put


def sessions(stream: DataFrame, gap: str, late: str, time: str = "ts", by: str = "user_id", ident: str = "event_id", kind: str = "event_type") -> DataFrame:
    """Sessions that have ended: by, start, end (of the last row), n, n_kinds, each row counted once by its ident.

    A session ends when gap has passed without a row of its key.  Copies of a row are dropped while
    the watermark, late behind the newest row, has not passed them; a session is given out once it
    has.  Rows without a time belong to none.  A null key is one key.
    """
    once = stream.where(F.col(time).isNotNull()).withWatermark(time, late).dropDuplicatesWithinWatermark([ident])
    found = once.groupBy(F.session_window(time, gap).alias("w"), by).agg(F.max(time).alias("last"), F.count(F.lit(1)).alias("n"), F.approx_count_distinct(kind).alias("n_kinds"))
    return found.select(by, F.col("w.start").alias("start"), F.col("last").alias("end"), "n", "n_kinds")


@dataclass
class Settlement:
    """What belongs to a key, gathered until a timer goes off: wait_ms after the opening row's time.

    ``rows``, a stream, needs the columns key, time, opens (whether a row opens the key) and amount.  The result
    has key, opened (the opening row's time, null if there was none), n (other rows) and amount (their
    sum, in units of the column).  Without an opening row the earliest row's time counts.  Rows without a
    key or a time are left out.

    Each micro-batch adds its sums by key to those of the keys that are open, and writes them as a new
    version below the checkpoint; it gives out the keys whose timer lies before the watermark, late
    behind the newest row, and the next one takes up the others.  State is five numbers a key, sums are partial before
    they meet, so a key of any number of rows takes no memory, and no row passes through Python.  A
    batch writes all open keys once.  One that ends early is repeated from the version before, over what it left.
    """

    rows: DataFrame
    wait_ms: int
    late: str

    def writer(self, path: str, checkpoint: str) -> DataStreamWriter:
        known = self.rows.where(F.col("time").isNotNull() & F.col("key").isNotNull())
        return known.writeStream.foreachBatch(lambda rows, number: self._add(rows, number, path, f"{checkpoint}/keys"))

    def _add(self, rows: DataFrame, number: int, path: str, at: str) -> None:
        spark = rows.sparkSession
        top, files = hadoop(spark, at)
        versions = sorted(int(s.getPath().getName()) for s in files.listStatus(top)) if files.exists(top) else []
        before = [v for v in versions if v < number]
        opens = F.coalesce("opens", F.lit(False))
        amount = F.when(opens, F.lit(0)).otherwise(F.coalesce("amount", F.lit(0))).cast("long")
        each = rows.select("key", F.when(opens, F.col("time")).alias("opened"), F.col("time").alias("first"), F.col("time").alias("last"), F.when(opens, 0).otherwise(1).cast("long").alias("n"), amount.alias("amount"))
        mark = None
        if before:
            mark = spark.read.parquet(f"{at}/{before[-1]}/mark").first()[0]
            held = spark.read.schema(each.schema).parquet(f"{at}/{before[-1]}/sums")
            if mark is not None:
                each, held = each.where(micros(each, "first") > mark), held.where(~self._due(held, mark))
            each = each.unionByName(held)
        sums = each.groupBy("key").agg(F.min("opened").alias("opened"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"), F.sum("amount").alias("amount"))
        sums = put(sums, f"{at}/{number}/sums")
        newest = sums.agg(F.max(micros(sums, "last"))).first()[0]
        late = pd.Timedelta(self.late) // pd.Timedelta(microseconds=1)
        mark = max((m for m in (mark, None if newest is None else newest - late) if m is not None), default=None)
        put(spark.range(1).select(F.lit(mark).cast("long").alias("mark")), f"{at}/{number}/mark")
        _publish(sums.where(F.lit(False) if mark is None else self._due(sums, mark)).select("key", "opened", "n", "amount"), path, number)
        for v in before[:-1]:
            files.delete(hadoop(spark, f"{at}/{v}")[0], True)

    def _due(self, sums: DataFrame, mark: int) -> Column:
        """Whether the timer lies before the watermark."""
        return F.coalesce(micros(sums, "opened"), micros(sums, "first")) + self.wait_ms * 1000 < mark


def _publish(rows: DataFrame, path: str, number: int) -> None:
    """Puts the rows into a folder as the files of one batch; those of an earlier try go first."""
    spark, made = rows.sparkSession, f"{path}/_made-{number}"
    rows.write.mode("overwrite").parquet(made)
    (top, files), (source, _) = hadoop(spark, path), hadoop(spark, made)
    listed = lambda at, begin: [s.getPath() for s in files.listStatus(at) if s.getPath().getName().startswith(begin)]
    for old in listed(top, f"batch-{number}-"):
        files.delete(old, False)
    for part in listed(source, "part-"):
        to = hadoop(spark, f"{path}/batch-{number}-{part.getName()}")[0]
        if not files.rename(part, to):
            raise RuntimeError(f"cannot put {to} in place")
    files.delete(source, True)


def settled(rows: DataFrame, wait_ms: int, late: str) -> Settlement:
    """What a stream of rows has settled, for ``run_available``: every key whose timer lies before the watermark."""
    return Settlement(rows, wait_ms, late)


def run_available(found: DataFrame | Settlement, path: str, checkpoint: str) -> None:
    """Writes what is ready to Parquet and stops; a later run on the same checkpoint goes on from there."""
    writer = found.writer(path, checkpoint) if isinstance(found, Settlement) else found.writeStream.format("parquet").option("path", path).outputMode("append")
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def arriving(spark: SparkSession, table: DataFrame, folder: str, time: str, parts: int) -> Iterator[DataFrame]:
    """The table as a stream that grows: parts times, the next slice by time is written to the folder, and the stream given out.

    Slices are cut at equal steps between the least and the largest time; rows without one come with the first.
    """
    low, high = table.agg(F.min(time), F.max(time)).first()
    for k in range(parts):
        first, last = k == 0, k == parts - 1
        edge = lambda i: F.lit(None if low is None else low + (high - low) * i / parts).cast(table.schema[time].dataType)
        since = F.lit(True) if first else F.coalesce(F.col(time) >= edge(k), F.lit(False))
        before = F.lit(True) if last else F.coalesce(F.col(time) < edge(k + 1), F.lit(first))
        table.where(since & before).write.mode("append").parquet(folder)
        yield spark.readStream.schema(table.schema).parquet(folder)
