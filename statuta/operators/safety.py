"""Text that a code page cannot hold."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unencodable(texts: pd.Series, charset: str = "cp932") -> pd.Series:
    """The distinct characters of each text that the charset lacks, by code point; null for null."""

    def bad(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            text.encode(charset)
            return ""
        except UnicodeEncodeError:
            return "".join(sorted({c for c in set(text) if not _fits(c, charset)}))

    return texts.map(bad, na_action="ignore")


def _fits(c: str, charset: str) -> bool:
    try:
        c.encode(charset)
        return True
    except UnicodeEncodeError:
        return False


def check_encoding(rows: DataFrame, text_col: str, charset: str = "cp932") -> DataFrame:
    """Adds unsafe (the characters) and safe.  Spark's encode() has no cp932, so this is a Pandas UDF."""

    @F.pandas_udf("string")
    def scan(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield unencodable(part, charset)

    return rows.withColumn("unsafe", scan(F.col(text_col))).withColumn("safe", F.col("unsafe") == "")


def verdict(checked: DataFrame) -> tuple[int, str]:
    """Exit code and message of a scan: 0 and ``cp932-safe``, or 1 and ``FAIL`` with the count."""
    n = checked.where(~F.col("safe")).count()
    return (1, f"FAIL: {n} unsafe") if n else (0, "cp932-safe")
