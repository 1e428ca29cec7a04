"""Reports over articles and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.operators import integrity


def modality_by_law(segments: DataFrame) -> DataFrame:
    """Segments per phase, law and modality."""
    return segments.groupBy("phase", "law_abbrev", "modality").agg(F.count(F.lit(1)).alias("n"))


def quality(articles: DataFrame) -> DataFrame:
    """How many articles break each rule; OK counts those that break none."""
    codes = F.when(F.size("violations") > 0, F.col("violations")).otherwise(F.array(F.lit("OK")))
    return integrity.validate(articles).select(F.explode(codes).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def section_rollup(articles: DataFrame) -> DataFrame:
    """Articles per part, chapter and section with subtotals; level tells subtotals from missing sections."""
    return articles.rollup("hen", "shou", "setsu").agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n"))


def lookup(laws: DataFrame, wanted: DataFrame) -> DataFrame:
    """law_id and phase for abbreviations; those not known stay, with nulls."""
    return wanted.join(laws.select("law_abbrev", "law_id", "phase"), "law_abbrev", "left")
