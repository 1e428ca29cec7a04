"""Paragraphs, segments, captions and tables of article bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions import clauses, keys
from statuta.functions.numerals import heading_number


def without_markers(text: Column) -> Column:
    return F.regexp_replace(text, r"<!-- segment: [^>]*-->\n?", "")


def paragraphs(articles: DataFrame) -> DataFrame:
    """One row per heading of the third level: article_id, number, heading, text (markers taken out)."""
    parts = articles.select("article_id", "law_abbrev", "article_number", "last_verified", F.posexplode(F.split(F.col("body"), r"(?m)^### ")).alias("number", "part")).where("number > 0")
    text = F.trim(without_markers(F.regexp_replace("part", r"^[^\n]*\n?", "")), F.lit("\n "))
    return parts.select("article_id", "law_abbrev", "article_number", "last_verified", "number", F.regexp_extract("part", r"^[^\n]*", 0).alias("heading"), text.alias("text")).withColumn("named", heading_number(F.col("heading")))


def segments(rows: DataFrame) -> DataFrame:
    """One row per segment from article_id, number and text."""
    return rows.select("article_id", "number", F.explode(clauses.segments(F.col("article_id"), F.col("number"), F.col("text"))).alias("s")).select("article_id", "number", "s.*")


def marked(segment: Column) -> Column:
    """A segment's text behind its marker, as bodies hold it."""
    of = lambda label, values: F.when(F.size(values) > 0, F.concat(F.lit(f" {label}: "), F.concat_ws(",", values))).otherwise(F.lit(""))
    target = F.when(segment["override_flag"], F.concat(F.lit(" override_flag: true"), of("override_target", segment["override_target"]))).otherwise(F.lit(""))
    return F.concat(F.lit("<!-- segment: "), segment["type"], F.lit(" id: "), segment["id"], of("applies_provisions", segment["applies_provisions"]), target, F.lit(" -->\n"), segment["text"])


def flags(segments_col: Column) -> Column:
    """Struct of has_items and has_proviso from a paragraph's segments."""
    has = lambda kind: F.coalesce(F.exists(segments_col, lambda s: s["type"] == kind), F.lit(False))
    return F.struct(has("hashira").alias("has_items"), has("tadashi").alias("has_proviso"))


def covered(number: Column, last_verified: Column) -> Column:
    """Whether the stored corpus has segments for an article: from this date on branches of depth one too."""
    return keys.branch_depth(number) <= F.when(last_verified == "2026-06-01", 1).otherwise(0)


def caption(body: Column) -> Column:
    """The caption in a first-level heading, null without one."""
    return F.nullif(F.regexp_extract(without_markers(body), r"(?m)^# .*第[0-9-]+条\(（(.*)）\)", 1), F.lit(""))


def table_cells(rows: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """One row per cell of pipe tables: line, column, cell.  The dashes below a head are left out."""
    lines = rows.select(*keep, F.posexplode(F.split(F.col(text_col), "\n")).alias("line", "content")).where(F.col("content").rlike(r"^\|.*\|$") & ~F.col("content").rlike(r"^\|[\s:|-]+\|$"))
    inner = F.regexp_replace("content", r"^\||\|$", "")
    return lines.select(*keep, "line", F.posexplode(F.split(inner, r"\|")).alias("column", "cell")).withColumn("cell", F.trim("cell"))
