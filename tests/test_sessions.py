"""Sessions and keyed state as streams, against batch SQL and by hand."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from statuta.streaming import sessions

T = datetime(2024, 5, 1)
CLICKS = "event_id long, user_id long, event_type string, ts timestamp"


def _minutes(rows):
    return [(i, u, k, None if m is None else T + timedelta(minutes=m)) for i, u, k, m in rows]


def _runs(spark, tmp_path, slices, made):
    """The rows given out in each run of a stream that gets one slice more before every run."""
    out, seen = [], 0
    for rows in slices:
        spark.createDataFrame(rows, made.ddl).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(made.ddl).parquet(str(tmp_path / "in"))
        sessions.run_available(made.of(stream), str(tmp_path / "out"), str(tmp_path / "state"))
        every = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=repr)
        out.append(every)
        assert len(every) >= seen
        seen = len(every)
    return out


class Sessions:
    ddl = CLICKS

    @staticmethod
    def of(stream):
        return sessions.sessions(stream, "10 minutes", "30 minutes")


def test_sessions_over_restarts_with_late_and_repeated_rows(spark, tmp_path):
    at = lambda m: T + timedelta(minutes=m)
    first = _minutes([(1, 1, "a", 0), (2, 1, "b", 9), (3, 1, "a", 19), (4, 2, "a", 0), (4, 2, "a", 0), (9, 3, "x", None)])
    # Row 2 comes again, row 5 joins two parts of a session late, row 6 moves the watermark to minute 70.
    second = _minutes([(2, 1, "b", 9), (5, 1, "c", 25), (6, 1, "a", 100), (7, None, "n", 90)])
    # Row 8 is later than the watermark allows and is left out; row 10 moves the watermark to minute 170.
    third = _minutes([(8, 2, "z", 5), (10, 5, "a", 200)])
    runs = _runs(spark, tmp_path, [first, second, third], Sessions)
    assert runs[0] == []
    # A row at the very end of the gap still belongs to the session.
    assert runs[1] == sorted([(1, at(0), at(25), 4, 3), (2, at(0), at(0), 1, 1)], key=repr)
    assert runs[2] == sorted([*runs[1], (1, at(100), at(100), 1, 1), (None, at(90), at(90), 1, 1)], key=repr)


class Settled:
    ddl = "key long, time timestamp, opens boolean, amount long"

    @staticmethod
    def of(stream):
        return sessions.settled(stream, 60 * 60_000, "30 minutes")


def test_settlement_by_timers_over_restarts(spark, tmp_path):
    row = lambda key, m, opens, amount=None: (key, None if m is None else T + timedelta(minutes=m), opens, amount)
    first = [row(1, 0, True), row(1, 5, False, 3), row(2, 10, False, 7), row(None, 1, False, 1), row(3, None, True)]
    second = [row(1, 59, False, 4), row(1, 59, False, 4), row(4, 80, True), row(2, 70, True)]
    third = [row(9, 300, True)]
    runs = _runs(spark, tmp_path, [first, second, third], Settled)
    at = lambda m: T + timedelta(minutes=m)
    # The watermark is at minute 50 after the second run, and at 270 after the third.
    assert runs[:2] == [[], []]
    assert runs[2] == sorted([(1, at(0), 3, 11), (2, at(70), 1, 7), (4, at(80), 0, 0)], key=repr)


def test_a_key_of_many_rows_keeps_three_numbers(spark, tmp_path):
    many = [(1, T + timedelta(seconds=i % 60), False, 1) for i in range(20_000)]
    runs = _runs(spark, tmp_path, [many, [(2, T + timedelta(days=9), True, None)]], Settled)
    assert runs[1] == [(1, None, 20_000, 20_000)]


def test_many_keys_settle_without_work_in_python_for_each(spark, tmp_path):
    began = time.monotonic()
    keys = spark.range(200_000).select(F.col("id").alias("key"), F.timestamp_seconds(F.col("id") % 60 + 1_700_000_000).alias("time"), (F.col("id") % 2 == 0).alias("opens"), F.lit(5).cast("long").alias("amount"))
    last = spark.range(1).select(F.lit(-1).cast("long").alias("key"), F.timestamp_seconds(F.lit(1_800_000_000)).alias("time"), F.lit(True).alias("opens"), F.lit(None).cast("long").alias("amount"))
    for rows in (keys, keys, last):
        rows.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(Settled.ddl).parquet(str(tmp_path / "in"))
        sessions.run_available(Settled.of(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == got.select("key").distinct().count() == 200_000
    assert got.agg(F.sum("n"), F.sum("amount"), F.count("opened")).first() == (200_000, 1_000_000, 100_000)
    assert time.monotonic() - began < 60


def test_a_settlement_that_ended_early_is_repeated_over_what_it_left(spark, tmp_path):
    row = lambda key, s, opens, amount=None: (key, T + timedelta(seconds=s), opens, amount)
    slices = [[row(1, 0, True), row(1, 5.000001, False, 3)], [row(1, 9, False, 4), row(2, 9000, True)], [row(3, 90_000, False, 1)]]
    runs = _runs(spark, tmp_path, slices, Settled)
    assert runs[1] == [(1, T, 2, 7)] and runs[2] == [(1, T, 2, 7), (2, T + timedelta(seconds=9000), 0, 0)]
    for end in ("2", ".2.crc"):
        (tmp_path / "state" / "commits" / end).unlink()
    stream = spark.readStream.schema(Settled.ddl).parquet(str(tmp_path / "in"))
    sessions.run_available(Settled.of(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == runs[2]


def test_settlement_keeps_microseconds_and_times_without_a_zone(spark, tmp_path):
    ddl = "key long, time timestamp_ntz, opens boolean, amount long"
    # The timer of key 1 goes off at the watermark itself, which is not before it; that of key 2 a microsecond earlier.
    rows = [(1, T + timedelta(microseconds=3), True, None), (2, T + timedelta(microseconds=2), True, None), (3, T + timedelta(minutes=90, microseconds=3), True, None)]
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "in"))
    sessions.run_available(Settled.of(spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "state"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(2, T + timedelta(microseconds=2), 0, 0)]


@pytest.mark.parametrize("parts", [1, 4])
def test_slices_hold_every_row_once(spark, tmp_path, parts):
    table = spark.createDataFrame([(i, T + timedelta(minutes=i) if i % 5 else None) for i in range(40)], "i int, t timestamp_ntz")
    for _ in sessions.arriving(spark, table, str(tmp_path), "t", parts):
        pass
    assert sorted(r.i for r in spark.read.parquet(str(tmp_path)).collect()) == list(range(40))
    assert list(sessions.arriving(spark, table.limit(0), str(tmp_path / "none"), "t", 2))
