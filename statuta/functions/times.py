"""Times as whole microseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a column of timestamps, dates or whole numbers; what has no zone is read as UTC, whatever the session's zone."""
    kind, t = df.schema[name].dataType, F.col(name)
    if isinstance(kind, TimestampType):
        return F.unix_micros(t)
    if isinstance(kind, DateType):
        return F.unix_date(t).cast("long") * 86_400_000_000
    if isinstance(kind, TimestampNTZType):
        seconds = F.unix_date(t.cast("date")).cast("long") * 86_400 + F.hour(t) * 3_600 + F.minute(t) * 60
        return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("long")
    return t.cast("long")
