"""Mixing sources to target weights by systematic sampling, in DataFrame operations alone.

Every document of a source expects target / source_size copies.  Within its source the expected
copies are prefix-summed in an order that interleaves sizes evenly (size class, then a digest of
the id), one offset drawn from the source's name is added, and a document is taken once for every
integer boundary its interval crosses.

The order is cut into blocks of (source, size class, first digits of the digest).  Only the block
totals meet per source (their number is bounded by classes times SALTS, whatever the input), and
only light columns are ranked inside a block, so a source with a third of all rows is spread over
hundreds of blocks.

Null text has size 0.  A null source is a source of its own, the last in order.  Repeated rows
are taken row by row.  An empty table gives an empty result.  Extra columns are ignored by
``plan`` and kept by ``sample``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuta.llm.common import cut

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
CLASSES_PER_E = 6
SALTS = 64
SEED = "mix-1"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Per source (columns src, source_size, one row each): its target by water-filling.

    A level L gives source i min(MOST * size_i, L * weight_i).  Sources are ranked by the level
    that fills them; the first whose share of what the fuller ones leave fits sets the level.
    The windows run over one row per source.
    """
    by_name = W.orderBy(F.col("src").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    out = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * MOST)
    out = out.withColumn("full_at", F.col("cap").cast("double") / F.col("weight"))
    by_fill = W.orderBy(F.col("full_at").asc(), F.col("src").asc_nulls_last())
    before = by_fill.rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(F.lit(1))
    out = (
        out.withColumn("rank", F.row_number().over(by_fill))
        .withColumn("goal", F.sum("source_size").over(every).cast("double") * SHARE)
        .withColumn("left", F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("double"))
        .withColumn("heavy", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.col("heavy").cast("double"))
    )
    fits = F.col("level") * F.col("weight") <= F.col("cap").cast("double")
    chosen = F.min(F.when(fits, F.struct("rank", "level"))).over(every)["level"]
    return out.select("src", "source_size", F.least(F.col("cap").cast("double"), chosen * F.col("weight")).alias("target"))


def _digest(id_col: str, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))


def _offset(seed: str) -> Column:
    """One number in [0, 1) per source, from its name; null and text never share one by design of the prefix."""
    name = F.concat(F.lit(f"{seed}:"), F.when(F.col("src").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "src")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def plan(docs: DataFrame, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken per row, and the columns in keep."""
    rows = docs.select("doc_id", F.col("source").alias("src"), words(F.col("text")).alias("size"), _digest("doc_id", seed).alias("digest"), *keep)
    size_class = F.floor(F.log(F.col("size") + 1.0) * CLASSES_PER_E).cast("int")
    salt = F.floor(F.conv(F.substring("digest", 1, 2), 16, 10).cast("int") * SALTS / 256).cast("int")
    rows = rows.withColumn("class", size_class).withColumn("salt", salt)
    rows = rows.withColumn("block", F.concat_ws(":", "class", "salt", F.when(F.col("src").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "src"))))
    if not keep:
        rows = cut(rows)  # texts are read once, for their sizes
    blocks = rows.groupBy("block", "src", "class", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    blocks = cut(blocks)
    source = targets(blocks.groupBy("src").agg(F.sum("words").alias("source_size")))
    before = W.partitionBy("src").orderBy("class", "salt").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("block", "src", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    blocks = blocks.join(source.withColumnRenamed("src", "of"), F.col("src").eqNullSafe(F.col("of")))
    blocks = blocks.select("block", "start", "source_size", "target", _offset(seed).alias("offset"))
    out = rows.drop("src").join(blocks, "block")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(1.0))
    rank = F.row_number().over(W.partitionBy("block").orderBy("digest", "doc_id", "size"))
    out = out.withColumn("at", F.col("start") + rank).withColumn("rate", rate)
    upto = lambda i: F.floor(i.cast("double") * F.col("rate") + F.col("offset"))
    out = out.withColumn("copies", (upto(F.col("at")) - upto(F.col("at") - 1)).cast("long"))
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *keep)


def sample(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of docs."""
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("row"))
    mixed = plan(rows, seed, keep=("row",))
    return mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
