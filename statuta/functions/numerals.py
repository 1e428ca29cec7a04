"""Kanji numerals and the headings written with them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = "一二三四五六七八九"
KANJI = f"[{DIGITS}十百千万]"
HEADING = rf"^第({KANJI}+)条((?:の{KANJI}+)*)(?:第({KANJI}+)項)?"
LEVEL_SIGNS = {"hen": "編", "shou": "章", "setsu": "節", "kan": "款", "moku": "目"}


def kanji_to_int(text: Column) -> Column:
    """三十六 is 36, 百五 is 105, 千二百三十四 is 1234; null for null, empty and other text."""
    unit = lambda c: F.when(c == "十", 10).when(c == "百", 100).when(c == "千", 1000).otherwise(0)

    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("part"), F.lit(0).alias("digit"))

    def merge(s: Column, c: Column) -> Column:
        digit = F.instr(F.lit(DIGITS), c)
        many = F.greatest(s["digit"], F.lit(1))
        in_units = s["part"] + many * unit(c)
        return (
            F.when(c == "万", F.struct((s["total"] + F.greatest(s["part"] + s["digit"], F.lit(1)) * 10000).alias("total"), F.lit(0).alias("part"), F.lit(0).alias("digit")))
            .when(unit(c) > 0, F.struct(s["total"].alias("total"), in_units.alias("part"), F.lit(0).alias("digit")))
            .otherwise(F.struct(s["total"].alias("total"), s["part"].alias("part"), digit.alias("digit")))
        )

    value = F.aggregate(F.split(text, ""), start, merge, lambda s: s["total"] + s["part"] + s["digit"])
    return F.when(text.rlike(rf"^{KANJI}+$"), value)


def heading_number(heading: Column) -> Column:
    """Struct of article_number (1-3 for 第一条の三) and paragraph (null if the heading names none)."""
    main = kanji_to_int(F.regexp_extract(heading, HEADING, 1)).cast("string")
    branches = F.filter(F.split(F.regexp_extract(heading, HEADING, 2), "の"), lambda x: x != "")
    number = F.concat_ws("-", F.concat(F.array(main), F.transform(branches, lambda x: kanji_to_int(x).cast("string"))))
    return F.struct(F.when(heading.rlike(HEADING), number).alias("article_number"), kanji_to_int(F.regexp_extract(heading, HEADING, 3)).alias("paragraph"))


def section_key(name: Column, level: str) -> Column:
    """Order of a section from its name: 第六章の二 is [6, 2], so it stands behind 第六章 and before 第七章."""
    pattern = rf"第({KANJI}+){LEVEL_SIGNS[level]}((?:の{KANJI}+)*)"
    branches = F.filter(F.split(F.regexp_extract(name, pattern, 2), "の"), lambda x: x != "")
    return F.when(name.rlike(pattern), F.concat(F.array(kanji_to_int(F.regexp_extract(name, pattern, 1))), F.transform(branches, kanji_to_int)))


def int_to_kanji(n: Column) -> Column:
    """36 is 三十六; from 1 to 9999, null for other numbers."""
    digit = lambda unit: (F.floor(n / unit) % 10).cast("int")
    sign = lambda unit: F.substr(F.lit(DIGITS), digit(unit), F.lit(1))
    units = [F.when(digit(u) == 0, "").when(digit(u) == 1, s).otherwise(F.concat(sign(u), F.lit(s))) for u, s in ((1000, "千"), (100, "百"), (10, "十"))]
    return F.when(n.between(1, 9999), F.concat(*units, F.when(digit(1) == 0, "").otherwise(sign(1))))
