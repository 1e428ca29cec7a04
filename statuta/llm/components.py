"""Connected components of an edge table, by large-star and small-star steps on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import attach, cut


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of any orderable type: node, and the smallest node that it reaches, as root.

    Each round links every neighbour of a node to the smallest of them (first those larger than
    the node, then those not larger) until the edges are stars.  Minima are pre-aggregated before
    they are shuffled, no node's neighbours are ever gathered, and the few nodes with more than a
    fixed share of all edges get their minimum by broadcast, so no task holds a star's edges.
    The number of rounds grows with the logarithm of the longest path; it has no bound of its own,
    as every round that changes the edges links nodes to smaller ones.  Nodes without an edge to
    another node, and edges with null, are left out; an empty table gives an empty result.
    """
    now = cut(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smaller = F.count_if(F.col("b") < F.col("a"))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"), F.count(F.lit(1)).alias("n"), smaller.alias("smaller")))
        # Stars are done: a node has one smaller neighbour and no other, or larger ones alone.
        total, left = least.agg(F.sum("n"), F.count_if((F.col("smaller") > 1) | (F.col("smaller") > 0) & (F.col("n") > F.col("smaller")))).first()
        if not left:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(least.where("smaller = 0").select(F.col("a").alias("node"), F.col("a").alias("root")))
        # Large star: the larger neighbours of a node go to its smallest neighbour or itself.
        large = attach(both.where(F.col("b") > F.col("a")), least, ["a"], "n", total).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = cut(large)
        # Small star: the smaller neighbours of a node, and itself, go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n"))
        small = attach(large, least, ["a"], "n", total).where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = cut(small.unionByName(least.select("a", F.col("low").alias("b"))).distinct())
