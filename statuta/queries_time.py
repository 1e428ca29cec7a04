"""Queries by time over the shop's tables and the events: intervals, values in force, sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from statuta.operators import temporal
from statuta.queries import query, table
from statuta.sources import upsert
from statuta.sources.scratch import scratch
from statuta.streaming import sessions as stream

_AFTER = "INTERVAL 30 MINUTES"


@query(
    f"SELECT s.sale_id, s.client_id, count(*) AS n_clicks, count(DISTINCT c.kind) AS n_kinds, min(epoch_us(c.ts) - epoch_us(s.sold_at)) AS first_us FROM sales s JOIN clicks c ON c.client_id = s.client_id AND c.ts >= s.sold_at AND c.ts < s.sold_at + {_AFTER} GROUP BY ALL"
)
def clicks_after_sales(spark, sf_dir):
    """What a client clicks within half an hour of each of its sales."""
    clicks = table(spark, sf_dir, "clicks").select("client_id", "ts", "kind")
    sales = table(spark, sf_dir, "sales").select("client_id", "sale_id", "sold_at", (F.col("sold_at") + F.expr(_AFTER)).alias("until"))
    pairs = temporal.within(clicks, sales, "ts", "sold_at", "until", ("client_id",))
    lag = temporal.micros(pairs, "ts") - temporal.micros(pairs, "sold_at")
    return pairs.groupBy("sale_id", "client_id").agg(F.count(F.lit(1)).alias("n_clicks"), F.count_distinct("kind").alias("n_kinds"), F.min(lag).alias("first_us"))


@query(
    "SELECT v.vendor_id, v.nation_id, count(*) AS n FROM (SELECT vendor_id, nation_id, floor(balance) AS low, floor(balance) + 25 AS high FROM vendors) v "
    "JOIN (SELECT floor(balance) AS low, floor(balance) + 25 AS high FROM vendors WHERE nation_id = 3) o ON o.low < v.high AND v.low < o.high GROUP BY ALL"
)
def balances_that_overlap(spark, sf_dir):
    """Ranges of money instead of time, and no column that must be equal: how many vendors of one nation are about as rich as each vendor."""
    ranges = lambda df: (F.floor("balance").alias(f"{df}_low"), (F.floor("balance") + 25).alias(f"{df}_high"))
    vendors = table(spark, sf_dir, "vendors")
    a = vendors.select("vendor_id", "nation_id", *ranges("a"))
    pairs = temporal.overlapping(a, vendors.where("nation_id = 3").select(*ranges("b")), ("a_low", "a_high"), ("b_low", "b_high"))
    return pairs.groupBy("vendor_id", "nation_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH v AS (SELECT *, row_number() OVER (PARTITION BY client_id, valid_at ORDER BY seq DESC NULLS LAST, change_id DESC NULLS LAST) AS place FROM client_changes WHERE client_id IS NOT NULL AND valid_at IS NOT NULL) "
    "SELECT c.sale_id, c.client_id, v.change_id, v.segment, v.op = 'D' AS gone FROM sales c ASOF LEFT JOIN (SELECT * FROM v WHERE place = 1) v ON v.client_id = c.client_id AND c.sold_at >= v.valid_at"
)
def client_in_force(spark, sf_dir):
    """The client as it was known at the time of each sale."""
    changes = table(spark, sf_dir, "client_changes").select("client_id", "valid_at", "seq", "change_id", "segment", "op")
    sales = table(spark, sf_dir, "sales").select("sale_id", "client_id", "sold_at")
    found = temporal.in_force(sales, changes, "sold_at", "valid_at", ("client_id",), ("seq", "change_id"))
    return found.select("sale_id", "client_id", "value.change_id", "value.segment", (F.col("value.op") == "D").alias("gone"))


#: Starts of each stream on its checkpoint; between two, more rows have come.
STARTS = 3
_LATE = "10 days"


@query(
    "WITH e AS (SELECT DISTINCT click_id, client_id, ts, kind FROM clicks WHERE ts IS NOT NULL), "
    "g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY client_id ORDER BY ts)), "
    "s AS (SELECT *, sum(fresh) OVER (PARTITION BY client_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nth FROM g) "
    "SELECT client_id, min(ts) AS start, max(ts) AS \"end\", count(*) AS n, count(DISTINCT kind) AS n_kinds FROM s GROUP BY client_id, nth "
    "HAVING max(ts) + INTERVAL 30 MINUTES <= (SELECT max(ts) FROM clicks) - INTERVAL 10 DAYS"
)
def click_sessions(spark, sf_dir):
    """Sessions of the clicks as a stream that comes in three slices by arrival, started anew for each."""
    at = scratch(spark, "sessions")
    clicks = table(spark, sf_dir, "clicks").select("click_id", "client_id", "ts", "kind", "arrived_at")
    clicks = clicks.withColumn("ts", F.col("ts").cast("timestamp"))
    for rows in stream.arriving(spark, clicks, f"{at}/in", "arrived_at", STARTS):
        found = stream.sessions(rows, "30 minutes", _LATE, "ts", "client_id", "click_id", "kind")
        stream.run_available(found, f"{at}/out", f"{at}/state")
    out = spark.read.parquet(f"{at}/out")
    return out.select("client_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n", "n_kinds")


@query(
    "WITH r AS (SELECT sale_id AS key, sold_at AS t, true AS opens, NULL AS quantity FROM sales UNION ALL SELECT sale_id, shipped_at, false, quantity FROM sale_lines), "
    "k AS (SELECT * FROM r WHERE key IS NOT NULL AND t IS NOT NULL) "
    "SELECT key AS sale_id, min(t) FILTER (WHERE opens) AS opened, CAST(count_if(NOT opens) AS BIGINT) AS n, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS quantity FROM k GROUP BY key "
    "HAVING coalesce(min(t) FILTER (WHERE opens), min(t)) + INTERVAL 30 DAYS < (SELECT max(t) FROM k) - INTERVAL 10 DAYS"
)
def settled_sales(spark, sf_dir):
    """What has been shipped of a sale thirty days after it, by sums and a timer for each sale; lines without a sale count from the first."""
    at = scratch(spark, "settled")
    sales = table(spark, sf_dir, "sales").select(F.col("sale_id").alias("key"), F.col("sold_at").alias("time"), F.lit(True).alias("opens"), F.lit(None).cast("long").alias("amount"))
    lines = table(spark, sf_dir, "sale_lines").select(F.col("sale_id").alias("key"), F.col("shipped_at").alias("time"), F.lit(False).alias("opens"), F.col("quantity").cast("long").alias("amount"))
    for some in stream.arriving(spark, sales.unionByName(lines), f"{at}/in", "time", STARTS):
        stream.run_available(stream.settled(some, 30 * 86_400_000, _LATE), f"{at}/out", f"{at}/state")
    return spark.read.parquet(f"{at}/out").select(F.col("key").alias("sale_id"), "opened", "n", F.col("amount").alias("quantity"))


@query(
    "WITH k AS (SELECT DISTINCT * FROM client_changes WHERE client_id IS NOT NULL AND valid_at IS NOT NULL), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY valid_at DESC, seq DESC NULLS LAST, change_id DESC NULLS LAST) AS place FROM k) "
    "SELECT client_id, CAST(client_id % 8 AS BIGINT) AS share, change_id, op, segment, city FROM r WHERE place = 1"
)
def clients_merged(spark, sf_dir):
    """The newest change of every client, in a table of eight partitions that takes the changes in three merges."""
    at = f"{scratch(spark, 'clients')}/table"
    changes = table(spark, sf_dir, "client_changes").where("client_id IS NOT NULL AND valid_at IS NOT NULL")
    rows = changes.select("client_id", (F.col("client_id") % 8).alias("share"), "valid_at", "seq", "change_id", "op", "segment", "city")
    for low, high in (("2024-03-01", "2024-04-01"), (None, "2024-03-01"), ("2024-04-01", None)):  # the second comes late
        some = rows.where(F.lit(True) if low is None else F.col("valid_at") >= F.lit(low).cast("timestamp_ntz")).where(F.lit(True) if high is None else F.col("valid_at") < F.lit(high).cast("timestamp_ntz"))
        upsert.upsert(some, at, ("client_id",), ("share",), ("valid_at", "seq", "change_id"))
    return upsert.table(spark, at, rows.schema).select("client_id", "share", "change_id", "op", "segment", "city")
