"""Translations, cases and amendments beside their articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(articles: DataFrame, details: DataFrame, name: str, key: str = "article_id") -> DataFrame:
    """Adds name, the array of an article's details in the order of their fields; articles without any keep an empty one.

    Details are gathered per article before they are joined, so no article is repeated.
    """
    fields = [c for c in details.columns if c != key]
    gathered = details.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))
    empty = F.array().cast(gathered.schema[name].dataType)
    return articles.join(gathered, key, "left").withColumn(name, F.coalesce(F.col(name), empty))
