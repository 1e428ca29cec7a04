"""The log of questions: raw and anonymised text, feedback, click and dwell time; appended as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.functions.anonymize import stored_forms

#: Our own layout; only the four inputs are given.
COLUMNS = ("question_id", "question", "feedback", "clicked", "dwell_seconds")


def prepare(questions: DataFrame, backfill: bool = False) -> DataFrame:
    """raw (null where it holds personal data) and anonymized, beside the other columns."""
    raw, anonymized = stored_forms(F.col("question"), backfill)
    return questions.withColumns({"raw": raw, "anonymized": anonymized}).drop("question")


def append(questions: DataFrame, path: str) -> None:
    prepare(questions).write.mode("append").parquet(path)


def append_jdbc(questions: DataFrame, url: str, table: str, driver: str) -> None:
    """The same into a database whose JDBC driver is on the class path."""
    prepare(questions).write.mode("append").jdbc(url, table, properties={"driver": driver})
