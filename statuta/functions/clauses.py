"""Types, modalities and references of statute sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statuta.functions.numerals import KANJI

# The phrases that tell segment types apart, in the order of their rank.
LIST_LEAD = "次に掲げる|次の各号|次のとおり|次に定める"
OVERRIDE = "の規定にかかわらず"
APPLIED = "について準用する。"
PROVISO = "。ただし、"

# Modalities by how a sentence ends, the first that fits counts.
ENDINGS = (
    ("doryoku_gimu", "努めなければならない"),
    ("gimu_negative", "してはならない|罰しない"),
    ("koka_torikeshi", "取り消すことができる"),
    ("koka_mukou", "無効とする"),
    ("gimu_kei", "に処する|罰する"),
    ("kanou_negative", "ことができない|ことはできない"),
    ("kanou_kenri", "ことができる"),
    ("gimu", "なければならない|とする"),
    ("jogai", "この限りでない|適用しない|妨げない"),
    ("teigi", "をいう"),
)
RELATIVE = "前[一二三四五六七八九十]*[条項号]|次[条項]|本条|同項"
PROVISIONS = f"(第{KANJI}+条から第{KANJI}+条まで|第{KANJI}+条|前{KANJI}*条)の規定は"
TARGET = f"(第{KANJI}+条)(?:第{KANJI}+項)?の規定にかかわらず"


def paragraph_type(text: Column) -> Column:
    """hashira, tokusoku, junyou, proviso (to be split in two) or simple."""
    return (
        F.when(text.rlike(LIST_LEAD), "hashira").when(text.contains(OVERRIDE), "tokusoku").when(text.contains(APPLIED), "junyou")
        .when(text.contains(PROVISO), "proviso").when(text.isNotNull(), "simple")
    )


def modality(text: Column) -> Column:
    out = F.when(text.isNotNull(), F.lit("unspecified"))
    for name, pattern in reversed(ENDINGS):
        out = F.when(text.rlike(f"(?:{pattern})。?$"), F.lit(name)).otherwise(out)
    return out


def references(text: Column) -> Column:
    """Relative references, each once, in code-point order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(RELATIVE), F.lit(0))))


def applies_provisions(text: Column) -> Column:
    """Provisions that a mutatis mutandis sentence applies; of a list the last only.  Null for other sentences."""
    return F.when(paragraph_type(text) == "junyou", F.regexp_extract_all(text, F.lit(PROVISIONS), F.lit(1)))


def override_target(text: Column) -> Column:
    """The article that an overriding sentence sets aside, without its paragraph; null for other sentences."""
    return F.when((paragraph_type(text) == "tokusoku") & text.rlike(TARGET), F.regexp_extract(text, TARGET, 1))


def split_proviso(text: Column) -> Column:
    """An array of (type, text): main clause and proviso, or the paragraph as it is."""
    kind = paragraph_type(text)
    cut = F.locate(PROVISO, text)
    part = lambda t, x: F.struct(t.alias("type"), x.alias("text"))
    two = F.array(part(F.lit("honbun"), F.substr(text, F.lit(1), cut)), part(F.lit("tadashi"), F.substr(text, cut + 1)))
    return F.when(kind == "proviso", two).when(kind.isNotNull(), F.array(part(kind, text)))


def segment_id(article_id: Column, number: Column, kind: Column) -> Column:
    stem = F.concat(article_id, F.lit("-p"), number.cast("string"))
    return F.when(kind.isin("hashira", "honbun", "tadashi"), F.concat(stem, F.lit("-"), kind)).otherwise(stem)


def segments(article_id: Column, number: Column, text: Column) -> Column:
    """The segments of one paragraph with everything derived from their text."""
    return F.transform(
        split_proviso(text),
        lambda s: F.struct(
            segment_id(article_id, number, s["type"]).alias("id"), s["type"].alias("type"), s["text"].alias("text"), modality(s["text"]).alias("modality"),
            references(s["text"]).alias("references"), F.when(s["type"] == "junyou", applies_provisions(s["text"])).alias("applies_provisions"),
            F.when(s["type"] == "tokusoku", F.lit(True)).alias("override_flag"),
            F.when(s["type"] == "tokusoku", F.array_compact(F.array(override_target(s["text"])))).alias("override_target"),
        ),
    )


def is_repealed(text: Column) -> Column:
    return F.trim(text) == "削除"
