"""As-of join with a tolerance: each left row meets the latest right row at or before it, if that is near enough.

Right rows are first reduced to one per key and time (their number, and the greatest payload).  The
lead over a key's distinct times ends the interval in which each of them is the latest; the
tolerance caps it.  Intervals of one key are disjoint, so a time lies in one at most.

An interval is filed under the time bucket that it starts in and, where it crosses into the next
one, under that as well, with a bucket width that follows its own length: widths are powers of two
STEP bits apart, the narrowest that holds the interval is taken.  So it has two pieces at most, and
no (key, width, bucket) has more than 2**STEP + 2 pieces, however dense or bursty its key is.  A
left row asks for the widths that its key uses at about its time (a small table tells), then meets
the pieces of its bucket in an equi-join, and containment leaves one match.

A key with a third of all rows is no group by itself anywhere: the lead is taken inside cells of
CELL microseconds and then over the cells' borders, two a cell; the table of widths has one row per
key and coarse bucket; both joins are sort-merge joins of exchanged tables, whose large partitions
Spark splits while it runs (spark.sql.adaptive.skewJoin, which is on by default).  Nothing goes to the driver or into a broadcast of the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuta.functions.times import micros
from statuta.llm.common import Shelf

HOUR = 3_600_000_000
#: Times of a key are ordered inside cells of this many microseconds, then cell by cell.
CELL = 12 * HOUR
#: Bits between two bucket widths.
STEP = 5
TOLERANCE = 720 * HOUR
FLOOR = 6 * HOUR


def _floor(t: Column, width: int) -> Column:
    return t - F.pmod(t, F.lit(width))


def _widths(tolerance: int) -> list[int]:
    """Bits of the bucket widths, the widest first; that one holds every interval."""
    top = tolerance.bit_length()
    return [*range(top, 0, -STEP), 0]


def intervals(right: DataFrame, tolerance: int) -> DataFrame:
    """From (key, at, best, n), unique by key and at: the same with until, the exclusive end of the interval."""
    cell = W.partitionBy("key", "cell").orderBy("at")
    rows = right.withColumn("cell", F.floor(F.col("at") / CELL)).withColumn("next", F.lead("at").over(cell)).withColumn("before", F.lag("at").over(cell))
    border = rows.where(F.col("next").isNull() | F.col("before").isNull())
    across = border.withColumn("next", F.lead("at").over(W.partitionBy("key").orderBy("at"))).withColumn("last", F.lead("cell").over(W.partitionBy("key").orderBy("at")))
    # Of the border rows only the last of a cell is new: its successor starts another cell, or there is none.
    across = across.where(F.col("last").isNull() | (F.col("last") != F.col("cell"))).drop("last")
    every = rows.where(F.col("next").isNotNull()).unionByName(across)
    most = F.col("at") + (tolerance + 1)
    return every.select("key", "at", "best", "n", F.least(F.coalesce("next", most), most).alias("until"))


def _pieces(spans: DataFrame, bits: list[int]) -> DataFrame:
    length = F.col("until") - F.col("at")
    width = F.lit(bits[0])
    for b in bits[1:]:
        width = F.when(length <= (1 << b), b).otherwise(width)
    rows = spans.withColumn("bits", width.cast("int"))
    ends = F.array_distinct(F.array(F.expr("shiftright(at, bits)"), F.expr("shiftright(until - 1, bits)")))
    return rows.withColumn("bucket", F.explode(ends))


def join(left: DataFrame, right: DataFrame, tolerance: int = TOLERANCE) -> DataFrame:
    """Rows of left, each with best, n and at of its match, or nulls.

    left: key, ts (long) and any other columns, which must not be called best, n, at, until, bits
    or bucket.  right: key, at (long), best (a struct; the greatest wins, null fields lose).  A match
    has at <= ts <= at + tolerance and the latest such at; n counts the right rows of the key at that
    time.  Null keys or times match nothing.  Rows of left come once for each width that their key
    uses, of which one at most has the match: a maximum by the row's id brings them together.
    """
    bits = _widths(tolerance)
    once = right.where(F.col("key").isNotNull() & F.col("at").isNotNull()).groupBy("key", "at").agg(F.count(F.lit(1)).alias("n"), F.max("best").alias("best"))
    # As tables, both are exchanged as they are for their joins, whose large partitions Spark can split only then.
    shelf = Shelf(left.sparkSession, "asof")
    pieces = shelf.put(_pieces(intervals(once, tolerance), bits), "pieces")
    coarse = F.expr(f"shiftright(shiftleft(bucket, bits), {bits[0]})")
    used = shelf.put(pieces.groupBy("key", coarse.alias("slot")).agg(F.collect_set("bits").alias("used")), "used")
    # Rows that can't match may be many, and are dealt by what they hold.
    own = F.xxhash64(*left.columns)
    ready = F.col("key").isNotNull() & F.col("ts").isNotNull()
    rows = left.withColumn("slot", F.when(ready, F.shiftright("ts", bits[0])).otherwise(own))
    rows = rows.join(used.hint("merge"), ["key", "slot"], "left").drop("slot")
    rows = rows.withColumn("bits", F.explode_outer("used")).drop("used").withColumn("bucket", F.when(F.col("bits").isNull(), own).otherwise(F.expr("shiftright(ts, bits)")))
    pieces = pieces.select(F.col("key").alias("_key"), F.col("bits").alias("_bits"), F.col("bucket").alias("_bucket"), "at", "until", "best", "n").hint("merge")
    inside = (F.col("at") <= F.col("ts")) & (F.col("ts") < F.col("until"))
    found = rows.join(pieces, (F.col("key") == F.col("_key")) & (F.col("bits") == F.col("_bits")) & (F.col("bucket") == F.col("_bucket")) & inside, "left")
    return found.select(*left.columns, "at", "best", "n")


def clicks_to_orders(clicks: DataFrame, sales: DataFrame, tolerance: int = TOLERANCE) -> DataFrame:
    """click_id, client_id, ts_us, sale_id, lag_us, total_cents, n_tied: each click with the latest order of its client.

    Times of rows whose id has an odd crc32 are floored to FLOOR.  Each sale is an order; one whose
    crc32 is not divisible by 3 is a second one as well, with sale_id -1 - sale_id (and priority
    6 - priority, which is not returned).  At one time the larger total_cents wins, then the larger
    sale_id, null loses; n_tied counts all the client's orders at the matched time.

    A null client, click time or order time matches nothing, and the click stays, unmatched (n_tied
    0, the others null).  Copies of a click count once: the result has one row per click_id, null
    being one id (copies that differ give the greatest (client_id, ts)).  A null id counts as one
    with an even crc32 divisible by 3; a total that is null, or no finite number, has no cents.
    Repeated sales are orders of their own.  Empty tables give no rows, or unmatched ones.  Other
    columns, long or null, and whatever their names, are not read.
    """
    h = lambda c: F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(0))
    time = lambda df, c, i: F.when(h(i) % 2 == 1, _floor(micros(df, c), FLOOR)).otherwise(micros(df, c))
    total = F.col("total").cast("double")
    cents = F.when(F.abs(total) < 9e15, F.floor(total * 100 + 0.5))
    ids = F.when(h("sale_id") % 3 != 0, F.array(F.col("sale_id"), -1 - F.col("sale_id"))).otherwise(F.array("sale_id"))
    orders = sales.select(F.col("client_id").cast("long").alias("key"), time(sales, "sold_at", "sale_id").alias("at"), cents.alias("total_cents"), F.explode(ids).alias("sale_id"))
    orders = orders.select("key", "at", F.struct("total_cents", F.col("sale_id").cast("long").alias("sale_id")).alias("best"))
    left = clicks.select(F.col("client_id").cast("long").alias("key"), F.col("click_id").cast("long").alias("click_id"), time(clicks, "ts", "click_id").alias("ts"))
    rows = join(left, orders, tolerance)
    hit = F.when(F.col("n").isNotNull(), F.struct("at", "n", "best"))
    rows = rows.groupBy("click_id").agg(F.max(F.struct("key", "ts")).alias("own"), F.max(F.struct("key", "ts", hit.alias("hit")))["hit"].alias("hit"))
    return rows.select(
        "click_id", F.col("own.key").alias("client_id"), F.col("own.ts").alias("ts_us"), F.col("hit.best.sale_id").alias("sale_id"),
        (F.col("own.ts") - F.col("hit.at")).alias("lag_us"), F.col("hit.best.total_cents").alias("total_cents"), F.coalesce("hit.n", F.lit(0)).cast("long").alias("n_tied"),
    )
