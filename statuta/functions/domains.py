"""Checks against fixed domains of values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statuta import schema


def translation_status_ok(value: Column) -> Column:
    return F.coalesce(value.isin(*schema.TRANSLATION_STATUS), F.lit(False))


def relevance_ok(value: Column) -> Column:
    return F.coalesce(value.isin(*schema.RELEVANCE), F.lit(False))


def relevance_rank(value: Column) -> Column:
    """1 for the most relevant; null outside the domain."""
    out = F.lit(None).cast("int")
    for rank, name in reversed(list(enumerate(schema.RELEVANCE, 1))):
        out = F.when(value == name, F.lit(rank)).otherwise(out)
    return out


def english_name(value: Column) -> Column:
    """The English name, null while it is pending."""
    return F.when(value != schema.ENGLISH_PENDING, value)
