import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statuta.functions import anonymize as A
from statuta.functions import clauses, domains, keys, numerals


def values(spark, rows, ddl, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*cols).collect()]


def test_paths(spark):
    cases = [("keihou", "36", "data/phase1-police/keihou/keihou-article-36.md"), ("keihou", "36-2", "data/phase1-police/keihou/keihou-article-36-2.md"), ("keiji-soshou-hou", "198", "data/phase1-police/keiji-soshou-hou/keiji-soshou-hou-article-198.md"), (None, "1", None), ("a", None, None)]
    got = values(spark, cases, "a string, n string, want string", keys.article_path(F.col("a"), F.col("n")), "want")
    assert all(a == b for a, b in got)
    rooted = values(spark, [("keihou", "36")], "a string, n string", keys.article_path(F.col("a"), F.col("n"), "/repo//data/./"), keys.article_path(F.col("a"), F.col("n"), "/"), *(keys.article_path(F.col("a"), F.col("n"), r) for r in ("", ".", "./")))
    assert rooted == [("/repo/data/phase1-police/keihou/keihou-article-36.md", "/phase1-police/keihou/keihou-article-36.md", *["phase1-police/keihou/keihou-article-36.md"] * 3)]


def test_path_keys_without_phase(spark):
    got = values(spark, [("file:/x/v0.2/phase1-tax/a-hou/a-hou-article-1-2.md",), ("file:/x/pre-v0.2/a-hou/a-hou-article-3.md",)], "p string", keys.path_keys(F.col("p")))
    assert [tuple(r[0]) for r in got] == [("v0.2", "phase1-tax", "a-hou", "1-2"), ("pre-v0.2", None, "a-hou", "3")]


def rule(text):
    """The masking rule said again without patterns, by reading one character after the other."""
    blank = lambda i: i < len(text) and text[i].isspace()
    digit = lambda i: i < len(text) and text[i].isdecimal()

    def skip(i, kind):
        while kind(i):
            i += 1
        return i

    out, i = [], 0
    while i < len(text):
        if text[i : i + 2] in ("令和", "平成", "昭和", "大正", "明治"):
            number = skip(i + 2, blank)
            end = skip(skip(number, digit), blank)
            if digit(number) and text[end : end + 1] == "年":
                out.append("[ERA][N]年")
                i = end + 1
                continue
        if text[i] == "第" and digit(i + 1):
            end = skip(i + 1, digit)
            if text[end : end + 1] in ("条", "項", "号") and end < len(text):
                out.append(text[i : end + 1])
                i = end + 1
                continue
        if digit(i):
            out.append("[N]")
            i = skip(i, digit)
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


ANONYMIZED = [
    ("令和5年第12条第3項の罰金10万円", "[ERA][N]年第12条第3項の罰金[N]万円"), ("昭和６３年 第１０条 ５０人", "[ERA][N]年 第１０条 [N]人"), ("明治四十年法律第四十五号", "明治四十年法律第四十五号"), ("第12条の2", "第12条の[N]"),
    ("第36条と第36", "第36条と第[N]"), ("第1号1号第2a", "第1号[N]号第[N]a"), ("令和5年度", "[ERA][N]年度"), (None, None), ("", ""), ("第36-2条", "第[N]-[N]条"),
]


def test_anonymize(spark):
    got = values(spark, ANONYMIZED, "t string, want string", A.anonymize(F.col("t")), "want")
    assert all(a == b for a, b in got)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=list("令和昭平成 第条項号年の0123９１٣a\u3000\n\x1c\x85"), max_size=14), min_size=200, max_size=200))
def test_anonymize_follows_the_rule(spark, texts):
    got = values(spark, [(t,) for t in texts], "t string", "t", A.anonymize(F.col("t")))
    assert [b for _, b in got] == [rule(a) for a, _ in got]


def test_stored_forms(spark):
    raw, kept = A.stored_forms(F.col("t"))
    _, filled = A.stored_forms(F.col("t"), backfill=True)
    got = values(spark, [("第9条 a@b.co 3件",), ("3件",), (None,)], "t string", raw, kept, filled)
    assert got == [(None, "第9条 a@b.co [N]件", "第9条 a@b.co [N]件"), ("3件", None, "[N]件"), (None, None, None)]


def test_html(spark):
    assert values(spark, [("<a & 'b' \"c\">",)], "t string", A.escape_html(F.col("t"))) == [("&lt;a &amp; &#39;b&#39; &quot;c&quot;&gt;",)]


def test_domains(spark):
    got = values(spark, [("none", "high"), ("x", "low"), (None, None)], "s string, r string", domains.translation_status_ok(F.col("s")), domains.relevance_ok(F.col("r")), domains.relevance_rank(F.col("r")))
    assert got == [(True, True, 1), (False, True, 3), (False, False, None)]


def kanji(n):
    digits, out = "一二三四五六七八九", ""
    for worth, sign in ((1000, "千"), (100, "百"), (10, "十"), (1, "")):
        d = n // worth % 10
        if d:
            out += (digits[d - 1] if d > 1 or not sign else "") + sign
    return out


def test_numerals(spark):
    every = [(kanji(n), n) for n in range(1, 10000)] + [("", None), (None, None), ("三x", None)]
    assert all(a == b for a, b in values(spark, every, "t string, n int", numerals.kanji_to_int(F.col("t")), "n"))
    got = values(spark, [("第四十八条の九の七の二",), ("第一条の三第二項",), ("附則",)], "t string", numerals.heading_number(F.col("t")))
    assert [tuple(r[0]) for r in got] == [("48-9-7-2", None), ("1-3", 2), (None, None)]


def test_natural_order(spark):
    numbers = ["2", "10", "10-2", "10-10", "48-9", "48-9-7-2"]
    frame = spark.createDataFrame([(n,) for n in reversed(numbers)], "n string")
    assert [r[0] for r in frame.orderBy(keys.natural_key(F.col("n"))).collect()] == numbers


def test_sections_with_branches_stand_behind_their_stem(spark):
    frame = spark.createDataFrame([("第七章　x",), ("第六章の二　y",), ("第六章　z",)], "n string")
    assert [r[0][:4] for r in frame.orderBy(numerals.section_key(F.col("n"), "shou")).collect()] == ["第六章　", "第六章の", "第七章　"]


@pytest.mark.parametrize(("text", "want"), [
    ("努めなければならない。", "doryoku_gimu"), ("してはならない。", "gimu_negative"), ("害してはならないものとする。", "gimu"), ("罰する。", "gimu_kei"), ("行ってはならない。", "unspecified"), ("取り消すことができる。", "koka_torikeshi"),
    ("することができる", "kanou_kenri"), ("をいう。", "teigi"), ("この限りでない。", "jogai"), ("無効とする。", "koka_mukou"), ("ことはできない。", "kanou_negative"),
])
def test_modality(spark, text, want):
    assert values(spark, [(text,)], "t string", clauses.modality(F.col("t"))) == [(want,)]


def test_proviso(spark):
    got = values(spark, [("甲である。ただし、乙は、この限りでない。",), ("甲である。但し、乙は別とする。",), ("次に掲げる甲。ただし、乙。",), (None,)], "t string", clauses.split_proviso(F.col("t")))
    assert [r[0] and [tuple(s) for s in r[0]] for r in got] == [
        [("honbun", "甲である。"), ("tadashi", "ただし、乙は、この限りでない。")], [("simple", "甲である。但し、乙は別とする。")], [("hashira", "次に掲げる甲。ただし、乙。")], None,
    ]


def test_provisions_of_a_list_are_the_last_only(spark):
    got = values(spark, [("第二百四十二条、第二百四十四条及び第二百四十五条の規定は、甲について準用する。",), ("第三条の二の規定は、甲について準用する。",)], "t string", clauses.applies_provisions(F.col("t")))
    assert [r[0] for r in got] == [["第二百四十五条"], []]


def test_law_decode(spark):
    got = values(spark, [("140AC0000000045",), ("321CONSTITUTION",), ("x",), (None,)], "t string", keys.law_decode(F.col("t")))
    assert [tuple(r[0]) for r in got] == [("Meiji", 40, "act", 1907), ("Showa", 21, "constitution", 1946), (None, None, None, None), (None, None, None, None)]
