"""Joins by time against comparing all rows."""

import random
from datetime import datetime, timedelta

import pytest

from statuta.operators import temporal

POINTS, SPANS = "k long, t long, p int", "k long, b long, e long, s int"


def _tables(spark, seed=4, n=400):
    rng = random.Random(seed)
    key = lambda: rng.choice([0, 0, 0, 1, 2, None])
    time = lambda: rng.choice([None, 0, -5, 7, 10**6, rng.randrange(-100, 100), rng.randrange(10**9)])
    points = [(key(), time(), i) for i in range(n)]
    spans = [(key(), b, None if b is None or i % 23 == 0 else b + rng.choice([0, -3, 1, 2, 50, 10**5, 10**9]), i) for i in range(n // 4) for b in [time()]]
    points += points[:20]
    spans += spans[:5]
    return points, spans, spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS)


@pytest.mark.parametrize("by", [("k",), ()])
@pytest.mark.parametrize("hot", [3, 1000])
def test_points_in_intervals(spark, by, hot, monkeypatch):
    monkeypatch.setattr(temporal, "HOT", hot)  # with 3, the hot bin is dealt to several shares
    points, spans, left, right = _tables(spark)
    if not by:
        right = right.drop("k")
    got = sorted((r.p, r.s) for r in temporal.within(left, right, "t", "b", "e", by).collect())
    want = sorted((p, s) for k, t, p in points for c, b, e, s in spans if t is not None and b is not None and e is not None and b <= t < e and (not by or k is not None and k == c))
    assert got == want and len(want) > 500


def test_the_hot_bin_is_split_and_nothing_is_a_nested_loop(spark):
    points = spark.range(20_000).selectExpr("0L AS k", "id AS t", "id AS p")
    spans = spark.createDataFrame([(0, 0, 20_000, 1)], SPANS)
    both = temporal.within(points, spans, "t", "b", "e", ("k",))
    plan = both._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and both.count() == 20_000
    keyed = points.selectExpr("k", "15 AS _bits", "0L AS _bin")
    shares, copies = temporal._split(keyed.withColumn("p", keyed._bin), spans.selectExpr("k", "15 AS _bits", "0L AS _bin"), ["k", "_bits", "_bin"])
    assert copies.count() == 1000 and shares.groupBy("_share").count().count() <= 1000


def test_overlapping_intervals_come_once(spark):
    _, spans, _, a = _tables(spark)
    b = a.selectExpr("k", "b + 1 AS bb", "e AS be", "s AS z").where("z % 3 > 0")
    others = [(k, x + 1, e, s) for k, x, e, s in spans if s % 3 and x is not None and e is not None]
    got = sorted((r.s, r.z) for r in temporal.overlapping(a, b, ("b", "e"), ("bb", "be"), ("k",)).collect())
    want = sorted((s, z) for k, x, e, s in spans for c, bb, be, z in others if k is not None and k == c and x is not None and e is not None and x < e and bb < be and x < be and bb < e)
    assert got == want and len(want) > 100


def test_intervals_of_dates_and_timestamps_whatever_the_zone(spark):
    rows = [(datetime(2024, 3, 10, 2, 30) + timedelta(minutes=i), i) for i in range(3)]  # an hour that New York has not
    points = spark.createDataFrame(rows, "t timestamp_ntz, p int")
    spans = spark.createDataFrame([(datetime(2024, 3, 10, 2, 31), datetime(2024, 3, 10, 2, 32))], "b timestamp_ntz, e timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r.p for r in temporal.within(points, spans, "t", "b", "e").collect()] == [1]
        days = spark.sql("SELECT DATE '2024-03-10' AS b, DATE '2024-03-11' AS e")
        assert temporal.within(points, days, "t", "b", "e").count() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("empty", ["left", "right", "both"])
def test_empty_sides(spark, empty):
    _, _, left, right = _tables(spark)
    left = left.where("false") if empty != "right" else left
    right = right.where("false") if empty != "left" else right
    for by in (("k",), ()):
        assert temporal.within(left, right if by else right.drop("k"), "t", "b", "e", by).collect() == []
    found = temporal.in_force(left, right, "t", "b", ("k",))
    assert found.count() == left.count() and found.where("value IS NOT NULL").isEmpty()


@pytest.mark.parametrize("cell", [10, 10**5, 10**12])
def test_the_value_in_force(spark, cell):
    points, spans, left, right = _tables(spark)
    got = [(r.k, r.t, r.p, None if r.value is None else tuple(r.value)) for r in temporal.in_force(left, right, "t", "b", ("k",), ("e", "s"), cell).collect()]
    low = lambda x: (x is not None, x or 0)
    want = []
    for k, t, p in points:
        known = [x for x in spans if k is not None and x[0] == k and t is not None and x[1] is not None and x[1] <= t]
        want.append((k, t, p, max(known, key=lambda x: (x[1], low(x[2]), x[3]), default=None)))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
