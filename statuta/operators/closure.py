"""Transitive closure of links: what is reached, over how many links at least, and what lies on a cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.sources.scratch import hadoop, scratch


def closure(edges: DataFrame, most: int | None = None) -> tuple[DataFrame, int]:
    """From edges (source, target): source, target, depth and cyclic for all that is reached, and the number of rounds.

    Semi-naive: each round joins only the pairs found in the round before with the edges, and keeps
    those that no round has found, so a pair is found once, at its least depth, and cycles end by
    themselves.  Every round is a table of its own in the shared folder, which cuts the lineage; none
    is written twice.  There are as many rounds as the longest of the shortest ways has links, or
    most, if given.  cyclic tells whether source and target reach each other.  Null ends are no
    links, and repeated links count once; a link to itself is a cycle.  An empty table gives no rows.

    The result holds every pair, so it is as large as the links make it.
    """
    spark = edges.sparkSession
    at = scratch(spark, "closure")
    links = edges.select("source", "target").dropna().distinct()
    links.write.parquet(f"{at}/links")
    links = spark.read.parquet(f"{at}/links")
    step = links.select(F.col("source").alias("target"), F.col("target").alias("next"))
    rounds, now = 0, links.withColumn("depth", F.lit(1))
    while True:
        now.write.parquet(f"{at}/pairs/depth_{rounds + 1:06d}")
        now = spark.read.parquet(f"{at}/pairs/depth_{rounds + 1:06d}")
        if now.isEmpty():
            path, files = hadoop(spark, f"{at}/pairs/depth_{rounds + 1:06d}")
            files.delete(path, True)
            break
        rounds += 1
        if rounds == most:
            break
        known = spark.read.parquet(*(f"{at}/pairs/depth_{k + 1:06d}" for k in range(rounds)))
        further = now.join(step, "target").select("source", F.col("next").alias("target")).distinct()
        now = further.join(known.select("source", "target"), ["source", "target"], "left_anti").withColumn("depth", F.lit(rounds + 1))
    if not rounds:
        return links.withColumns({"depth": F.lit(1), "cyclic": F.lit(False)}), 0
    pairs = spark.read.parquet(*(f"{at}/pairs/depth_{k + 1:06d}" for k in range(rounds)))
    back = pairs.select(F.col("target").alias("source"), F.col("source").alias("target"), F.lit(True).alias("cyclic"))
    return pairs.join(back, ["source", "target"], "left").select("source", "target", "depth", F.coalesce("cyclic", F.lit(False)).alias("cyclic")), rounds
