"""Sketches that are stored by day and merged upwards: distinct values, and quantiles.

The states are Spark's own: HyperLogLog for distinct values, with a relative standard error of about
1.04 / sqrt(2**LG_K), and KLL for quantiles, whose ranks are off by less than RANK_ERROR with 99 %.
A state has a fixed size whatever it has seen, is made by partial aggregates, and merging states
gives what one state over all rows would give within the same bounds; so days add up to months,
and keys to totals, without another look at the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
#: Of distinct counts: three standard errors of a sketch of 2**LG_K registers.
ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
K = 400
RANK_ERROR = 0.01


def daily(rows: DataFrame, time: str, distinct: str, value: str, *by: str) -> DataFrame:
    """by, day, n, hll and kll: a row per key and day. Rows without a time are left out; null values are in n alone."""
    day = F.col(time).cast("date").alias("day")
    known = rows.where(F.col(time).isNotNull())
    return known.groupBy(*by, day).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(distinct, F.lit(LG_K)).alias("hll"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(K)).alias("kll"))


def merged(states: DataFrame, *by: str | Column) -> DataFrame:
    """The states of ``daily``, or of this, brought together per group of by."""
    return states.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll").alias("kll"))


def distinct(state: Column) -> Column:
    """About how many distinct values the state has seen."""
    return F.hll_sketch_estimate(state)


def quantile(state: Column, share: float) -> Column:
    """A value that about this share of the values does not exceed; null if it has seen none."""
    return F.when(F.kll_sketch_get_n_double(state) > 0, F.kll_sketch_get_quantile_double(state, F.lit(share)))


def rank(state: Column, value: Column) -> Column:
    """About the share of values that do not exceed value."""
    return F.when(F.kll_sketch_get_n_double(state) > 0, F.kll_sketch_get_rank_double(state, value))
