"""Queries over JSON values and sketches of the clicks."""

from __future__ import annotations

from pyspark.sql import functions as F

from statuta.functions import user, variants
from statuta.operators import sketches
from statuta.queries import query, table


def _clicks(spark, sf_dir, *names):
    return table(spark, sf_dir, "clicks").select("click_id", *names, variants.parsed(F.col("props")).alias("v"))


_OK = "(SELECT *, CASE WHEN json_valid(props) THEN props END AS j FROM clicks)"
_OUTSIDE = r"""regexp_replace(props, '"(?:[^"\\]|\\.)*"', '', 'g')"""


@query(
    "SELECT click_id, TRY_CAST(json_extract_string(j, '$.k') AS BIGINT) AS k, json_extract_string(j, '$.device.os') AS os, json_extract_string(j, '$.device.ver') AS ver, "
    f"CASE WHEN props IS NULL THEN 'missing' WHEN j IS NOT NULL THEN NULL WHEN trim(props) = '' THEN 'empty' WHEN contains({_OUTSIDE}, '\"') OR len(regexp_extract_all({_OUTSIDE}, '[\\[{{]')) > len(regexp_extract_all({_OUTSIDE}, '[\\]}}]')) THEN 'cut off' ELSE 'malformed' END AS reason FROM {_OK}"
)
def click_properties(spark, sf_dir):
    """Fields of the clicks' JSON; what is no JSON stays, with the reason."""
    v = F.col("v")
    rows = _clicks(spark, sf_dir, variants.reason(F.col("props")).alias("reason"))
    return rows.select("click_id", variants.field(v, "$.k", "long").alias("k"), variants.field(v, "$.device.os", "string").alias("os"), variants.field(v, "$.device.ver", "string").alias("ver"), "reason")


@query(
    "SELECT click_id, CAST(nth - 1 AS INTEGER) AS position, CAST(json_extract(item, '$.sku') AS BIGINT) AS sku, CAST(json_extract(item, '$.qty') AS BIGINT) AS qty "
    f"FROM (SELECT click_id, unnest(items) AS item, generate_subscripts(items, 1) AS nth FROM (SELECT click_id, json_extract(j, '$.items[*]') AS items FROM {_OK} WHERE json_type(j, '$.items') = 'ARRAY'))"
)
def click_items(spark, sf_dir):
    rows = variants.elements(_clicks(spark, sf_dir), "v", "$.items", "click_id")
    e = F.col("element")
    return rows.select("click_id", "position", variants.field(e, "$.sku", "long").alias("sku"), variants.field(e, "$.qty", "long").alias("qty"))


@query(f"SELECT kind, array_to_string(list_sort(json_keys(j)), ',') AS shape, count(*) AS n FROM {_OK} WHERE j IS NOT NULL GROUP BY ALL")
def click_shapes(spark, sf_dir):
    return variants.shapes(_clicks(spark, sf_dir, "kind").where("v IS NOT NULL"), "v", "kind")


@query(
    "SELECT strftime(ts, '%Y-%m') AS month, coalesce(kind, '-') AS kind, count(*) AS n, count(DISTINCT client_id) AS clients, true AS clients_ok, true AS median_ok "
    "FROM clicks WHERE ts IS NOT NULL GROUP BY ALL"
)
def monthly_sketches(spark, sf_dir):
    """Clients and the median value of every month and kind from sketches by day, beside exact counts that say whether they keep their bounds."""
    clicks = table(spark, sf_dir, "clicks").select("ts", F.coalesce("kind", F.lit("-")).alias("kind"), "client_id", "value")
    month = F.date_format("day", "yyyy-MM").alias("month")
    states = sketches.merged(sketches.daily(clicks, "ts", "client_id", "value", "kind"), month, "kind")
    found = states.select("month", "kind", sketches.distinct(F.col("hll")).alias("about"), sketches.quantile(F.col("kll"), 0.5).alias("median"))
    exact = clicks.where("ts IS NOT NULL").withColumn("month", F.date_format("ts", "yyyy-MM"))
    exact = exact.join(found, ["month", "kind"])
    below, upto = F.count_if(F.col("value") < F.col("median")), F.count_if(F.col("value") <= F.col("median"))
    half, slack = F.count("value") * 0.5, F.count("value") * sketches.RANK_ERROR + 1
    per = exact.groupBy("month", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("client_id").alias("clients"), F.first("about").alias("about"),
        F.coalesce((below <= half + slack) & (upto >= half - slack), F.lit(False)).alias("median_ok"),
    )
    return per.select("month", "kind", "n", "clients", (F.abs(F.col("about") - F.col("clients")) <= F.col("clients") * sketches.ERROR + 1).alias("clients_ok"), "median_ok")


@query(
    "WITH e AS (SELECT user_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS island FROM events) "
    "SELECT user_id, event_type, min(ts) AS started, max(ts) AS ended, CAST(count(*) AS INTEGER) AS n FROM e GROUP BY user_id, event_type, island"
)
def event_runs(spark, sf_dir):
    """Runs of events of one type per user, by a table function called from SQL."""
    user.register(spark)
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), F.col("ts").cast("timestamp").alias("t"), F.col("event_type").alias("kind"), "event_id")
    found = spark.sql("SELECT * FROM runs(TABLE({events}) PARTITION BY k ORDER BY (t, event_id))", events=events)
    return found.select(F.col("k").alias("user_id"), F.col("kind").alias("event_type"), F.col("started").cast("timestamp_ntz").alias("started"), F.col("ended").cast("timestamp_ntz").alias("ended"), "n")


@query("SELECT user_id, round(count(*) / sum(1 / value), 6) AS mean FROM events WHERE value > 0 GROUP BY user_id")
def harmonic_values(spark, sf_dir):
    """The harmonic mean of each user's values, by an aggregate of two steps called from SQL."""
    user.register(spark)
    events = table(spark, sf_dir, "events").select("user_id", "value", "event_id")
    parts = spark.sql("SELECT user_id, harmonic_part(value) AS s FROM {events} WHERE value > 0 GROUP BY user_id, pmod(hash(event_id), 64)", events=events)
    return spark.sql("SELECT user_id, round(harmonic(s), 6) AS mean FROM {parts} GROUP BY user_id", parts=parts)
