from pyspark.sql import functions as F

from statuta.functions import variants

ROWS = [
    (1, '{"a": {"b": [1, "2", null]}, "k": "12"}'), (2, '{"a": 1'), (3, '{"a": "x'), (4, "nope"), (5, ""), (6, None), (7, "[1, 2]"), (8, "3.5"), (9, '{"s": "} ] \\" {"}'), (10, '{"a": {"b": "no array"}, "k": 7.9}'), (11, '{"x": 1}}'), (12, "null"),
]


def test_values_and_reasons(spark):
    rows = spark.createDataFrame(ROWS, "i int, t string").select("i", variants.parsed(F.col("t")).alias("v"), variants.reason(F.col("t")).alias("why"))
    assert {r.i: r.why for r in rows.collect() if r.why} == {2: "cut off", 3: "cut off", 4: "malformed", 5: "empty", 6: "missing"}
    got = {r.i: (r.k, r.s) for r in rows.select("i", variants.field(F.col("v"), "$.k", "long").alias("k"), variants.field(F.col("v"), "$.s", "string").alias("s")).collect()}
    assert got[1] == (12, None) and got[9] == (None, '} ] " {') and got[7] == got[8] == got[6] == (None, None) and got[10][0] == 7
    assert [(r.i, r.position, r.e) for r in variants.elements(rows, "v", "$.a.b", "i").select("i", "position", variants.field(F.col("element"), "$", "long").alias("e")).orderBy("position").collect()] == [(1, 0, 1), (1, 1, 2), (1, 2, None)]
    shapes = {r["shape"]: r["n"] for r in variants.shapes(rows.where("why IS NULL"), "v").collect()}
    assert shapes["a,k"] == 2 and shapes["s"] == 1 == shapes["x"]
    assert "a: OBJECT" in variants.merged_schema(rows.where("i = 1"), "v").first()[0]
    assert variants.elements(rows.limit(0), "v", "$.a").collect() == []


def test_sketches_of_days_add_up_within_their_bounds(spark):
    from statuta.operators import sketches

    for n in (3_000, 300_000):
        rows = spark.range(n).selectExpr("timestamp_seconds(1700000000 + id * 104729 % 2000000) AS t", "id * 7919 % 1000003 AS who", "double(id * 7919 % 1000003) AS x", "id % 2 AS k")
        days = sketches.daily(rows, "t", "who", "x", "k").cache()
        assert days.groupBy("k").count().agg({"count": "max"}).first()[0] > 20
        state = sketches.merged(sketches.merged(days, "k")).select("n", sketches.distinct(F.col("hll")).alias("d"), *(sketches.quantile(F.col("kll"), q).alias(f"q{i}") for i, q in enumerate((0.01, 0.5, 0.99))), sketches.rank(F.col("kll"), F.lit(1e9)).alias("r")).first()
        assert state.n == n and abs(state.d - n) <= n * sketches.ERROR and state.r == 1
        for i, q in enumerate((0.01, 0.5, 0.99)):
            assert abs(rows.where(F.col("x") <= state[f"q{i}"]).count() - q * n) <= n * sketches.RANK_ERROR + 1
    nothing = sketches.merged(sketches.daily(rows.selectExpr("t", "CAST(NULL AS LONG) AS who", "CAST(NULL AS DOUBLE) AS x"), "t", "who", "x"))
    assert nothing.select(sketches.distinct(F.col("hll")), sketches.quantile(F.col("kll"), 0.5)).first()[:] == (0, None)
