"""Tiers of a corpus: union, differences and set comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union(*tiers: DataFrame) -> DataFrame:
    """All tiers under one schema; fields that one lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tiers)


def diff(old: DataFrame, new: DataFrame, key: str = "article_id", fields: tuple[str, ...] | None = None) -> DataFrame:
    """key, status (added, removed, changed, same) and the changed fields, by one full outer join."""
    fields = fields or tuple(c for c in old.columns if c != key and c in new.columns)
    a = old.select(key, F.struct(*fields).alias("old"))
    b = new.select(key, F.struct(*fields).alias("new"))
    both = a.join(b, key, "full_outer")
    changed = F.array_compact(F.array(*(F.when(~F.col(f"old.{f}").eqNullSafe(F.col(f"new.{f}")), F.lit(f)) for f in fields)))
    in_both = F.col("old").isNotNull() & F.col("new").isNotNull()
    status = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.size(changed) > 0, "changed").otherwise("same")
    return both.select(key, status.alias("status"), F.when(in_both, changed).otherwise(F.array().cast("array<string>")).alias("changed"))


def only_in(a: DataFrame, b: DataFrame, key: str = "article_id") -> DataFrame:
    return a.join(b.select(key), key, "left_anti")


def in_both(a: DataFrame, b: DataFrame, key: str = "article_id") -> DataFrame:
    return a.join(b.select(key), key, "left_semi")


def keys_except(a: DataFrame, b: DataFrame, key: str = "article_id") -> DataFrame:
    return a.select(key).exceptAll(b.select(key))


def keys_common(a: DataFrame, b: DataFrame, key: str = "article_id") -> DataFrame:
    return a.select(key).intersect(b.select(key))
