"""Citation edges, and what relative references stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuta.functions.keys import natural_key
from statuta.functions.numerals import KANJI, kanji_to_int


def edges(segments: DataFrame) -> DataFrame:
    """id, relation and target phrase for everything that a segment refers to."""
    of = lambda name, col: F.transform(F.coalesce(col, F.array().cast("array<string>")), lambda t: F.struct(F.lit(name).alias("relation"), t.alias("target")))
    every = F.concat(of("refers", F.col("references")), of("applies", F.col("applies_provisions")), of("overrides", F.col("override_target")))
    return segments.select("id", F.explode(every).alias("e")).select("id", "e.relation", "e.target")


def resolve(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """Adds targets (article numbers) and resolved to rows of law_abbrev, article_number and target.

    index: law_abbrev, article_number and complete, true where all articles of a law are in it.
    Only there are neighbours known; elsewhere, and for phrases that name no neighbour, targets is
    null and resolved false.  前条 is the article before, 前二条 the two before, 次条 the one behind,
    本条 the article itself.
    """
    order = W.partitionBy("law_abbrev").orderBy("key")
    placed = index.where("complete").select("law_abbrev", "article_number", natural_key(F.col("article_number")).alias("key")).withColumn("place", F.row_number().over(order))
    many = F.when(F.col("target").rlike(f"^前({KANJI}+)条$"), kanji_to_int(F.regexp_extract("target", f"^前({KANJI}+)条$", 1))).when(F.col("target") == "前条", 1)
    low = F.when(many.isNotNull(), F.col("place") - many).when(F.col("target") == "次条", F.col("place") + 1).when(F.col("target") == "本条", F.col("place"))
    high = F.when(many.isNotNull(), F.col("place") - 1).otherwise(low)
    rows = phrases.withColumn("row", F.monotonically_increasing_id()) if "row" not in phrases.columns else phrases
    own = rows.join(placed.select("law_abbrev", "article_number", "place"), ["law_abbrev", "article_number"], "left").withColumns({"low": low, "high": high})
    wanted = own.where(F.col("low").isNotNull()).select("row", "law_abbrev", F.explode(F.sequence("low", "high")).alias("place"))
    found = wanted.join(placed, ["law_abbrev", "place"]).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "article_number"))).alias("found"))
    out = own.join(found, "row", "left")
    whole = F.col("found").isNotNull() & (F.size("found") == F.col("high") - F.col("low") + 1)
    return out.select("law_abbrev", "article_number", "target", F.when(whole, F.transform("found", lambda x: x["article_number"])).alias("targets"), F.coalesce(whole, F.lit(False)).alias("resolved"))
