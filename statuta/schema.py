"""Types of the article model and the fixed value domains."""

from __future__ import annotations

from pyspark.sql import types as T

# Domains of the stored fields.
TRANSLATION_STATUS = ("official", "community", "draft", "none")
RELEVANCE = ("high", "medium", "low")
SEGMENT_TYPES = ("simple", "hashira", "junyou", "honbun", "tadashi", "tokusoku")
MODALITIES = (
    "doryoku_gimu", "gimu_negative", "koka_torikeshi", "koka_mukou", "gimu_kei", "kanou_negative",
    "kanou_kenri", "gimu", "jogai", "teigi", "unspecified",
)
DEFAULT_PHASE = "phase1-police"
ARCHIVE = "archive"
ENGLISH_PENDING = "(English name pending)"
SOURCE_BASE = "https://laws.e-gov.go.jp/law/"
REQUIRED_KEYS = (
    "law_id", "law_name_ja", "law_name_en", "article_number", "article_id", "version_date", "source_url", "source_format",
    "last_verified", "license", "translation_status", "machine_translated", "paragraphs", "cases", "amendments", "tags",
)
LEVELS = ("hen", "shou", "setsu", "kan", "moku")

_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()
_L = T.ArrayType(_S)

SEGMENT = T.StructType([
    T.StructField("id", _S), T.StructField("type", _S), T.StructField("text", _S), T.StructField("modality", _S), T.StructField("references", _L),
    T.StructField("applies_provisions", _L), T.StructField("override_flag", _B), T.StructField("override_target", _L),
])
PARAGRAPH = T.StructType([
    T.StructField("number", _I), T.StructField("has_proviso", _B), T.StructField("has_items", _B), T.StructField("is_added_by_amendment", _B),
    T.StructField("segments", T.ArrayType(SEGMENT)),
])
SECTION = T.StructType([f for x in LEVELS for f in (T.StructField(x, _I), T.StructField(f"{x}_name_ja", _S))])
FRONT = T.StructType([
    *(T.StructField(k, _S) for k in REQUIRED_KEYS[:11]), T.StructField("machine_translated", _B), T.StructField("paragraphs", T.ArrayType(PARAGRAPH)),
    T.StructField("cases", _L), T.StructField("amendments", _L), T.StructField("tags", _L), T.StructField("parent_section", SECTION),
])
ARTICLE = T.StructType([
    *(T.StructField(k, _S) for k in ("tier", "phase", "law_abbrev", "path")), *FRONT.fields, T.StructField("body", _S),
    T.StructField("keys", _L), T.StructField("corrupt", _S),
])
