"""Validation of articles, and guards that fail loudly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta import schema
from statuta.functions import domains, keys


class IntegrityError(RuntimeError):
    pass


def violations() -> Column:
    """The codes of the rules that an article breaks, in order.

    V1 required keys, V2 article_id, V3 path, V4 source_url, V5 law_id, V6 dates, V7 paragraph
    numbers, V8 headings, V9 translation status, V10 segment domains, V11 first tag, V12 flags.
    A row that could not be read has V0 alone.
    """
    c = F.col
    numbers = F.transform("paragraphs", lambda p: p["number"])
    count = F.size("paragraphs")
    all_segments = F.flatten(F.transform("paragraphs", lambda p: F.coalesce(p["segments"], F.expr("array()").cast("array<" + schema.SEGMENT.simpleString() + ">"))))
    bad_flags = F.exists(
        "paragraphs",
        lambda p: p["segments"].isNotNull() & (F.size(p["segments"]) > 0)
        & ((F.exists(p["segments"], lambda s: s["type"] == "hashira") != p["has_items"]) | (F.exists(p["segments"], lambda s: s["type"] == "tadashi") != p["has_proviso"])),
    )
    rules = {
        "V1": F.size(F.array_except(F.array(*map(F.lit, schema.REQUIRED_KEYS)), F.coalesce("keys", F.array().cast("array<string>")))) > 0,
        "V2": ~c("article_id").eqNullSafe(keys.article_id(c("law_abbrev"), c("article_number"))),
        "V3": ~F.coalesce(c("path").endswith(F.concat(F.lit("/"), c("law_abbrev"), F.lit("/"), c("law_abbrev"), F.lit("-article-"), c("article_number"), F.lit(".md"))), F.lit(False)),
        "V4": ~c("source_url").eqNullSafe(keys.source_url(c("law_id"))),
        "V5": ~F.coalesce(c("law_id").rlike(r"^\d{3}(AC\d{10}|CO\d{10}|M\d{11}|CONSTITUTION)$"), F.lit(False)),
        "V6": c("version_date").try_cast("date").isNull() | c("last_verified").try_cast("date").isNull(),
        "V7": ~F.coalesce(numbers == F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")), F.lit(False)),
        "V8": ~F.coalesce(F.regexp_count("body", F.lit(r"(?m)^### ")) == count, F.lit(False)),
        "V9": ~domains.translation_status_ok(c("translation_status")),
        "V10": F.coalesce(F.exists(all_segments, lambda s: ~F.coalesce(s["type"].isin(*schema.SEGMENT_TYPES) & s["modality"].isin(*schema.MODALITIES), F.lit(False))), F.lit(False)),
        "V11": ~c("phase").eqNullSafe(F.get("tags", F.lit(0))),
        "V12": F.coalesce(bad_flags, F.lit(False)),
    }
    found = F.array_compact(F.array(*(F.when(bad, F.lit(code)) for code, bad in rules.items())))
    return F.when(c("corrupt").isNotNull(), F.array(F.lit("V0"))).otherwise(found)


def validate(articles: DataFrame) -> DataFrame:
    """path, violations and ok of every article; none is left out because another fails."""
    return articles.select("path", violations().alias("violations")).withColumn("ok", F.size("violations") == 0)


def exit_code(validated: DataFrame) -> int:
    """0 if all pass, 1 if any fails, 2 if there is nothing to check; one row reaches the driver."""
    n, failed = validated.agg(F.count(F.lit(1)), F.count_if(~F.col("ok"))).first()
    return 2 if not n else 1 if failed else 0


def duplicate_keys(articles: DataFrame) -> DataFrame:
    """Laws found in more than one phase."""
    return articles.groupBy("law_abbrev").agg(F.array_sort(F.collect_set("phase")).alias("phases")).where(F.size("phases") > 1)


def missing_keys(articles: DataFrame) -> DataFrame:
    return articles.where(F.col("law_id").isNull()).select("law_abbrev", "path")


def repeated_ids(articles: DataFrame) -> DataFrame:
    return articles.groupBy("tier", "article_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def manifest(articles: DataFrame, *more: Column) -> DataFrame:
    """One row per law.  Nothing is dropped on the way: the rows' sum is that of the articles."""
    return articles.groupBy("law_abbrev").agg(
        F.min("law_id").alias("law_id"), F.min("phase").alias("phase"), F.count(F.lit(1)).alias("n_articles"), F.min("version_date").alias("version_date"), F.max("last_verified").alias("last_verified"), *more
    )


def guarded_manifest(articles: DataFrame) -> DataFrame:
    """The manifest, once the guards have passed; raises IntegrityError.

    One pass over the articles gives the manifest with what the guards look at; it is small, one row
    a law, and kept, so that articles are read and parsed once.  An assertion inside the plan
    would be pruned together with its column.
    """
    seen = manifest(articles, F.array_sort(F.collect_set("phase")).alias("phases"), F.count_if(F.col("law_id").isNull()).alias("missing")).persist()
    for bad, what in ((F.size("phases") > 1, "laws in several phases"), (F.col("missing") > 0, "articles without law_id")):
        if rows := seen.where(bad).select("law_abbrev", "phases", "missing").take(5):
            seen.unpersist()
            raise IntegrityError(f"{what}: {[r.asDict() for r in rows]}")
    return seen.drop("phases", "missing")
