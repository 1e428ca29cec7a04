from datetime import datetime

from conftest import SF

from statuta.streaming import questions


def test_each_row_once_over_restarts(spark, tmp_path):
    rows = questions.source(spark, SF, "conversations.parquet").selectExpr("conv_id", "turn", "text AS question")
    for _ in range(2):
        questions.run_available(questions.anonymized(rows), str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(f"{SF}/conversations.parquet").count()


def test_windows_close_behind_the_watermark(spark, tmp_path):
    folder, at = tmp_path / "in", lambda h, m: datetime(2024, 1, 1, h, m)
    ddl = "ts timestamp, event_type string"
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    batches = [[(at(0, 5), "a"), (at(0, 50), "a")], [(at(2, 30), "b")], [(at(0, 10), "a"), (at(4, 0), "b")]]
    for rows in batches:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(str(folder))
        stream = spark.readStream.schema(ddl).parquet(str(folder))
        questions.run_available(questions.counts(stream), out, state)
    got = {(r["start"].hour, r["event_type"]): r["n"] for r in spark.read.parquet(out).collect()}
    assert got == {(0, "a"): 2, (2, "b"): 1}  # what came too late is not counted


def test_tables_that_are_folders(spark, tmp_path):
    spark.read.parquet(f"{SF}/conversations.parquet").repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    rows = questions.source(spark, str(tmp_path), "conversations.parquet").selectExpr("conv_id", "turn", "text AS question")
    questions.run_available(questions.anonymized(rows), str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(f"{SF}/conversations.parquet").count()
