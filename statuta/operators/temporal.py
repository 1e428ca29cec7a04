"""Joins by time: points in intervals, overlapping intervals, and the value in force at a point.

Neither plans a nested loop.  Intervals are filed under bins whose width follows their own length,
so that each stands in two bins at most; a point asks one bin for each width that is in use.  A bin
that holds more than one in HOT points is split: its points are dealt by their rows' hash, its intervals
are copied to every share.  There are fewer than HOT such bins for a width, which bounds what is broadcast.

The value in force is carried along the order of time inside cells of a key, then over the cells of
a key, one row each, and reaches the rows that came before a cell's first value by a join on the
cell.  So no task needs all rows of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuta.functions.times import micros

#: Bits between two widths of bins.
STEP = 4
#: A bin with more than one in HOT rows is split.
HOT = 1000
#: Microseconds of a cell.
CELL = 12 * 3_600_000_000


def _binned(spans: DataFrame) -> DataFrame:
    """Intervals from _begin to before _end with _bits, the width of their bins, and _bin: two rows each at most."""
    length = F.col("_end") - F.col("_begin")
    bits = F.lit(64 - STEP)
    for b in range(64 - 2 * STEP, -1, -STEP):
        bits = F.when(length <= (1 << b), b).otherwise(bits)
    ends = F.array_distinct(F.array(F.expr("shiftright(_begin, _bits)"), F.expr("shiftright(_end - 1, _bits)")))
    return spans.where("_begin < _end").withColumn("_bits", bits.cast("int")).withColumn("_bin", F.explode(ends))


def _split(points: DataFrame, spans: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a _share, by which the hot bins of points are dealt."""
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = points.count()
    bound = max(1, total // HOT)
    hot = F.broadcast(sizes.where(F.col("_n") > bound).select(*keys, F.ceil(F.col("_n") / bound).cast("int").alias("_shares")))
    shares = F.coalesce("_shares", F.lit(1))
    dealt = points.join(hot, keys, "left").withColumn("_share", F.pmod(F.xxhash64(*points.columns), shares).cast("int")).drop("_shares")
    copied = spans.join(hot, keys, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_shares")
    return dealt, copied


def within(points: DataFrame, spans: DataFrame, at: str, begin: str, end: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Every pair of a point and an interval with begin <= at < end and equal by columns, which come once.

    Times are timestamps, dates or numbers.  Null times and null keys match nothing, nor do
    intervals that end where they begin, or before.  Repeated rows match each.  Apart from by, the
    tables must not share column names, and no name may begin with an underscore.  Either table may
    be empty.
    """
    keyed = lambda df: df.dropna(subset=list(by)) if by else df
    left = keyed(points.withColumn("_at", micros(points, at))).where("_at IS NOT NULL")
    right = _binned(keyed(spans.withColumn("_begin", micros(spans, begin)).withColumn("_end", micros(spans, end))))
    used = [r[0] for r in right.select("_bits").distinct().collect()]  # 16 at most
    left = left.withColumn("_bits", F.explode(F.lit(sorted(used)).cast("array<int>"))).withColumn("_bin", F.expr("shiftright(_at, _bits)"))
    keys = [*by, "_bits", "_bin"]
    left, right = _split(left, right, keys)
    both = left.join(right, [*keys, "_share"]).where((F.col("_begin") <= F.col("_at")) & (F.col("_at") < F.col("_end")))
    return both.select(*by, *(c for c in points.columns if c not in by), *(c for c in spans.columns if c not in by))


def overlapping(a: DataFrame, b: DataFrame, a_span: tuple[str, str], b_span: tuple[str, str], by: tuple[str, ...] = ()) -> DataFrame:
    """Every pair of intervals that share an instant: the later of two beginnings lies inside the other interval.

    So a pair comes once, from one of two joins of points with intervals: b's beginning in a, or a's
    beginning in b and after b's.  Nulls, ends and names are as in ``within``.
    """
    first = within(b.where(micros(b, b_span[0]) < micros(b, b_span[1])), a, b_span[0], *a_span, by)
    second = within(a.where(micros(a, a_span[0]) < micros(a, a_span[1])), b, a_span[0], *b_span, by)
    names = [*by, *(c for c in a.columns if c not in by), *(c for c in b.columns if c not in by)]
    both = second.where(micros(second, a_span[0]) > micros(second, b_span[0]))
    return first.select(*names).unionByName(both.select(*names))


def in_force(rows: DataFrame, values: DataFrame, at: str, since: str, by: tuple[str, ...], order: tuple[str, ...] = (), cell: int = CELL) -> DataFrame:
    """Every row with the latest value of its key at or before its time, as a struct ``value``, or null.

    Of values at one time the last by the columns of order counts, nulls first.  Rows with a null
    key or time have none; values with one are in force nowhere.  Repeated rows stay.
    """
    fields = F.struct(*(c for c in values.columns))
    right = values.select(*by, micros(values, since).alias("_at"), *(c for c in order if c not in by), fields.alias("_value")).dropna(subset=[*by, "_at"])
    # One value of a key and time: the last.
    right = right.groupBy(*by, "_at").agg(F.max(F.struct(*order, "_value"))["_value"].alias("_value"))
    right = right.withColumn("_cell", F.floor(F.col("_at") / cell))
    left = rows.select(*by, micros(rows, at).alias("_at"), F.struct(*rows.columns).alias("_row")).withColumn("_cell", F.floor(F.col("_at") / cell))
    known = left.dropna(subset=[*by, "_at"])
    none = left.where(~_all_set([*by, "_at"])).select("_row", F.lit(None).cast(right.schema["_value"].dataType).alias("value"))
    both = known.withColumn("_value", F.lit(None).cast(right.schema["_value"].dataType)).withColumn("_side", F.lit(1)).unionByName(
        right.withColumn("_row", F.lit(None).cast(left.schema["_row"].dataType)).withColumn("_side", F.lit(0))
    )
    inside = W.partitionBy(*by, "_cell").orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    local = both.withColumn("_now", F.last("_value", ignorenulls=True).over(inside)).where("_side = 1")
    cells = both.groupBy(*by, "_cell").agg(F.max_by("_value", F.when(F.col("_side") == 0, F.col("_at"))).alias("_last"))
    earlier = W.partitionBy(*by).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    carried = cells.select(*by, "_cell", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    found = local.join(carried, [*by, "_cell"], "left").select("_row", F.coalesce("_now", "_carried").alias("value"))
    return found.unionByName(none).select("_row.*", "value")


def _all_set(names: list[str]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.col(n).isNotNull()
    return out
