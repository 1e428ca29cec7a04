"""Statute texts that Spark derives from the documents table, as the given tables hold none; the same rows go to Spark and to SQL.

Every document makes one row.  Documents of ids from 16 g on make the g-th copy of a small
collection of laws, each taking the row that stands at its id's rest; what varies is the
collection's number {g} in names and identifiers, and numbers made of the document's own id: {n} from 1 to
97, {k} from 1 to 9998 in kanji, {p} of four digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import numerals

#: Documents that make one collection; rests beyond a sample's rows make none.
COPY = 16
_KINDS = {"string": "VARCHAR", "int": "INTEGER", "long": "BIGINT", "boolean": "BOOLEAN"}


class Sample:
    """Rows for one collection; integers in the columns of unique get 1000 times the collection's number added."""

    def __init__(self, ddl: str, rows: list[tuple], unique: tuple[str, ...] = (), table: str = "documents", key: str = "doc_id"):
        self.fields = [tuple(f.strip().split(" ", 1)) for f in ddl.split(",")]
        self.rows, self.unique, self.table, self.key = rows, unique, table, key
        assert len(rows) <= COPY

    def over(self, table: str, key: str) -> Sample:
        """The same rows derived from another table, by a column of ids."""
        return Sample(", ".join(map(" ".join, self.fields)), self.rows, self.unique, table, key)

    def _holds(self, i: int, sign: str) -> bool:
        return any(isinstance(r[i], str) and sign in r[i] for r in self.rows)

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        ident = F.col(self.key).cast("long")
        return self._of(spark.read.parquet(f"{sf_dir}/{self.table}.parquet").select(ident.alias("id")))

    def one(self, spark: SparkSession) -> DataFrame:
        """The first collection, for tests."""
        return self._of(spark.range(COPY))

    def _of(self, given: DataFrame) -> DataFrame:
        given = given.where(F.col("id") % COPY < len(self.rows))
        rows = F.array(*(F.struct(*(F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(r, self.fields, strict=True))) for r in self.rows))
        one = given.select(F.col("id").alias("_id"), F.element_at(rows, (F.col("id") % COPY + 1).cast("int")).alias("_row"))
        copy, n, k = F.floor(F.col("_id") / COPY), F.col("_id") % 97 + 1, F.col("_id") % 9998 + 1
        signs = {"{g}": copy.cast("string"), "{n}": n.cast("string"), "{k}": numerals.int_to_kanji(k), "{p}": F.lpad((F.col("_id") % 10000).cast("string"), 4, "0")}

        def column(i: int, name: str, kind: str) -> Column:
            out = F.col(f"_row.{name}")
            for sign, value in signs.items():
                if self._holds(i, sign):
                    out = F.replace(out, F.lit(sign), value)
            return ((out + copy * 1000).cast(kind) if name in self.unique else out).alias(name)

        return one.select(*(column(i, name, kind) for i, (name, kind) in enumerate(self.fields)))

    def sql(self) -> str:
        """The rows as a SQL table expression."""
        def lit(x) -> str:
            return "NULL" if x is None else "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x).lower() if isinstance(x, bool) else str(x)

        signs = {"{g}": f"CAST(id // {COPY} AS VARCHAR)", "{n}": "CAST(id % 97 + 1 AS VARCHAR)", "{k}": _kanji_sql("(id % 9998 + 1)"), "{p}": "lpad(CAST(id % 10000 AS VARCHAR), 4, '0')"}

        def column(i: int, name: str, kind: str) -> str:
            out = f"CAST(v{i} AS {_KINDS[kind]})"
            for sign, value in signs.items():
                if self._holds(i, sign):
                    out = f"replace({out}, '{sign}', {value})"
            return f"CAST({out} + id // {COPY} * 1000 AS {_KINDS[kind]}) AS {name}" if name in self.unique else f"{out} AS {name}"

        values = ", ".join(f"({i}, " + ", ".join(map(lit, r)) + ")" for i, r in enumerate(self.rows))
        names = ", ".join(f"v{i}" for i in range(len(self.fields)))
        columns = ", ".join(column(i, *f) for i, f in enumerate(self.fields))
        return f"(SELECT {columns} FROM (SELECT CAST({self.key} AS BIGINT) AS id FROM {self.table}) JOIN (VALUES {values}) AS raw(place, {names}) ON place = id % {COPY})"


def _kanji_sql(x: str) -> str:
    digit = lambda unit: f"(({x} // {unit}) % 10)"
    sign = lambda unit: f"substr('{numerals.DIGITS}', CAST({digit(unit)} AS INTEGER), 1)"
    units = "".join(f"CASE {digit(u)} WHEN 0 THEN '' WHEN 1 THEN '{s}' ELSE {sign(u)} || '{s}' END || " for u, s in ((1000, "千"), (100, "百"), (10, "十")))
    return f"({units}CASE {digit(1)} WHEN 0 THEN '' ELSE {sign(1)} END)"


QUESTIONS = Sample("id long, question string", [
    (1, "令和{n}年第{n}条第3項の罰金{n}万円"), (2, "昭和６３年 第１０条 ５０人"), (3, "明治{k}年法律第四十五号"), (4, "第{n}条の2"), (5, "第36条と第36"),
    (6, "第1号1号第2a"), (7, "令和{n}年度"), (8, "平成 30 年 12 月の契約"), (9, ""), (10, None), (11, "電話は03-1234-{p}です"), (12, "連絡先 taro{n}@example.co.jp 第9条"),
    (13, "<b>第1条</b> & \"注\" '記'"), (14, "塡補—賠償"), (15, "大正　15　年"),
], unique=("id",))

PARAGRAPHS = Sample("article_id string, number int, text string", [
    ("mihon-hou-{g}-art-1", 1, "この法律は、見本の取扱いに関し必要な事項を定めることを目的とする。"),
    ("mihon-hou-{g}-art-2", 1, "この法律において「見本」とは、次に掲げる物をいう。"),
    ("mihon-hou-{g}-art-3", 1, "第{k}条第二項の規定にかかわらず、総会は、見本の規格を変更することができる。"),
    ("mihon-hou-{g}-art-4", 1, "第{k}条から第九千九百九十九条までの規定は、見本の保管について準用する。"),
    ("mihon-hou-{g}-art-4", 2, "前二条の規定は、写しの保管について準用する。"),
    ("mihon-hou-{g}-art-5", 1, "見本を所持する者は、届け出なければならない。ただし、次条に定める場合は、この限りでない。"),
    ("mihon-hou-{g}-art-6", 1, "何人も、見本を破壊してはならない。"),
    ("mihon-hou-{g}-art-7", 1, "前条の規定に違反した者は、{k}円以下の罰金に処する。"),
    ("mihon-hou-{g}-art-8", 1, "所持者は、見本の保全に努めなければならない。"),
    ("mihon-hou-{g}-art-9", 1, "本条の届出は、取り消すことができる。"),
    ("mihon-hou-{g}-art-10", 1, "同項の契約に反する定めは、無効とする。"),
    ("mihon-hou-{g}-art-11", 1, "前項の期間は、延長することができない。"),
    ("mihon-hou-{g}-art-12", 1, "削除"),
    ("mihon-hou-{g}-art-13", 1, "次項及び前三条の適用は、他の法律による処分を妨げない。"),
    ("mihon-hou-{g}-art-14", 1, "未遂は、罰しない。"),
    ("mihon-hou-{g}-art-15", 1, None),
])

NUMERALS = Sample("numeral string, heading string", [
    ("{k}", "第{k}条"), ("{k}", "第{k}条第三項"), ("千二百三十四", "第千二百三十四条"), ("{k}", "第{k}条の二"), ("一", "第一条の三第二項"), ("{k}", "第四十八条の{k}の七の二"),
    ("九百九十九", "第九百九十九条"), ("{k}", "第二千条の{k}"), ("百十三", "第百十三条"), ("二十", "附則"), ("", ""), (None, None), ("12", "第12条"),
])

NUMBERS = Sample("law_abbrev string, article_number string, complete boolean", [
    ("mihon-hou-{g}", "1", True), ("mihon-hou-{g}", "2", True), ("mihon-hou-{g}", "10", True), ("mihon-hou-{g}", "10-2", True), ("mihon-hou-{g}", "10-10", True), ("mihon-hou-{g}", "48-9", True),
    ("mihon-hou-{g}", "48-9-7-2", True), ("mihon-hou-{g}", "9", True), ("mihon-hou-{g}", "100-{n}", True), ("betsu-hou-{g}", "1", False), ("betsu-hou-{g}", "3", False), ("betsu-hou-{g}", "2", False),
])

PHRASES = Sample("row long, law_abbrev string, article_number string, target string", [
    (1, "mihon-hou-{g}", "10", "前条"), (2, "mihon-hou-{g}", "10-2", "前二条"), (3, "mihon-hou-{g}", "2", "前三条"), (4, "mihon-hou-{g}", "48-9", "次条"), (5, "mihon-hou-{g}", "48-9-7-2", "次条"),
    (6, "betsu-hou-{g}", "3", "前条"), (7, "mihon-hou-{g}", "9", "本条"), (8, "mihon-hou-{g}", "9", "同項"),
], unique=("row",))

LAWS = Sample("law_abbrev string, law_id string, phase string", [
    ("keihou-{g}", "140AC000000{p}", "phase1-police"), ("kenpou-{g}", "321CONSTITUTION", "phase1-foundational"), ("kaisha-hou-{g}", "417AC000000{p}", "phase2-commercial"),
    ("kinsho-hou-shikkourei-{g}", "340CO0000000321", "phase2-commercial"), ("yakkihou-shikoukisoku-{g}", "336M5000010{p}", "phase3-pharma"),
    ("digital-shakai-keisei-kihon-hou-{g}", "503AC0000000035", "phase1-administrative"), ("taishou-hou-{g}", "210AC0000000001", "phase1-police"), ("nazo-{g}", "X", "phase1-police"), ("kara-{g}", None, "phase1-tax"),
])

WANTED = Sample("law_abbrev string, article_number string", [("keihou-{g}", "{n}"), ("keihou-{g}", "{n}-2"), ("kenpou-{g}", "9"), ("shiranai-{g}", "1"), ("kaisha-hou-{g}", None), (None, "1")])

OLD = Sample("article_id string, law_name string, body string, tag string", [
    ("a-{g}-art-1", "甲法", "本文{g}", "phase1"), ("a-{g}-art-2", "甲法", "本文{k}", None), ("a-{g}-art-3", "甲法", "本文三", "phase1"), ("b-{g}-art-1", "乙法", "本文", "phase1"), ("b-{g}-art-2", "乙法", None, "phase1"),
])
NEW = Sample("article_id string, law_name string, body string, tag string", [
    ("a-{g}-art-1", "甲法", "本文{g}", "phase1"), ("a-{g}-art-2", "甲法", "本文{k}", "phase2"), ("a-{g}-art-4", "甲法", "本文四", "phase2"), ("b-{g}-art-1", "乙法改", "本文改", "phase1"), ("b-{g}-art-2", "乙法", None, "phase1"),
])

DETAILS = Sample("article_id string, kind string, title string", [
    ("a-{g}-art-1", "case", "判決{k}"), ("a-{g}-art-1", "amendment", "改正一"), ("a-{g}-art-2", "case", "判決二"), ("z-{g}-art-9", "case", "孤立"), (None, "case", "無番"),
])

BODIES = Sample("id long, body string, article_number string, last_verified string", [
    (1, "\n# 見本法 第{n}条(（区域{k}）)\n\n### 第一条\n\nあ\n", "{n}", "2026-05-20"), (2, "\n# 見本法 第2-3条\n\n### 第二条の三\n\n削除\n", "2-3", "2026-05-20"),
    (3, "# 見本法 第4条(（<!-- segment: simple id: x -->\n題）)\n", "4-5", "2026-06-01"), (4, "", "6-7-8", "2026-06-01"),
], unique=("id",))

TABLES = Sample("id long, text string", [
    (1, "前\n| 甲 | 乙 |\n|:--|--:|\n| {k} | 二 |\n| 三 |\n後"), (2, "表なし"), (3, "| x || y |\n"), (4, None), (5, "|a{n}|"),
], unique=("id",))

SECTIONS = Sample("article_id string, hen int, shou int, setsu int, shou_name string", [
    ("s-{g}-1", 1, 1, 1, "第{k}章　総則"), ("s-{g}-2", 1, 1, 2, "第一章　総則"), ("s-{g}-3", 1, 6, None, "第六章　雑則"), ("s-{g}-4", 1, 62, None, "第六章の二　特例"), ("s-{g}-5", 2, 7, None, "第七章　罰則"), ("s-{g}-6", None, None, None, None),
])

MEMBERS = Sample("law_abbrev string, law_id string, phase string, version_date string, last_verified string, path string", [
    ("alpha-{g}", "A{g}", "phase1-x", "1990-01-01", "2026-05-19", "p1-{g}"), ("alpha-{g}", "A{g}", "phase1-x", "1990-01-01", "2026-06-01", "p2-{g}"), ("beta-{g}", "B1", "phase2-y", "2001-02-03", "2026-05-20", "p3-{g}"),
    ("dup-{g}", "D1", "phase1-x", "2002-02-02", "2026-05-20", "p4-{g}"), ("dup-{g}", "D2", "phase2-y", "2002-02-02", "2026-05-20", "p5-{g}"), ("noid-{g}", None, "phase1-z", "2003-03-03", "2026-05-20", "p6-{g}"),
])


def _document(number: str, article_id: str, law_id: str, segments: str, body: str, extra: str = "", tag: str = "phase9-mihon") -> str:
    return (
        f"---\nlaw_id: {law_id}\nlaw_name_ja: 見本法\nlaw_name_en: (English name pending)\narticle_number: {number}\narticle_id: {article_id}\nversion_date: '1990-01-02'\n"
        f"source_url: https://laws.e-gov.go.jp/law/{law_id}\nsource_format: e-gov-xml\nlast_verified: '2026-05-20'\nlicense: MIT\ntranslation_status: none\nmachine_translated: false\n"
        f"paragraphs:\n- number: 1\n  has_proviso: false\n  has_items: false\n  is_added_by_amendment: false\n{segments}cases: []\namendments: []\ntags:\n- {tag}\n- auto-generated\n{extra}---\n\n{body}"
    )


_SIMPLE = "  segments:\n  - id: mihon-hou-{g}-art-1-p1\n    type: simple\n    text: 見本の区域は、従来の区域による。\n    modality: unspecified\n"
DOCUMENTS = Sample("path string, value string", [
    ("file:/x/t1/phase9-mihon/mihon-hou-{g}/mihon-hou-{g}-article-1.md", _document("'1'", "mihon-hou-{g}-art-1", "402AC000000{p}", _SIMPLE, "# 見本法 第1条(（区域{k}）)\n\n### 第一条\n\n見本の区域は、従来の区域による。\n")),
    ("file:/x/t1/phase9-mihon/mihon-hou-{g}/mihon-hou-{g}-article-2-3.md", _document("2-3", "mihon-hou-{g}-art-2-3", "402AC000000{p}", "  segments: []\n", "# 見本法 第2-3条\n\n### 第二条の三\n\n削除\n", "parent_section:\n  shou: 1\n  shou_name_ja: 第一章　総則\n")),
    ("file:/x/t1/phase9-mihon/mihon-hou-{g}/mihon-hou-{g}-article-4.md", _document("'4'", "mihon-hou-{g}-art-5", "BAD", "", "### 第四条\n\n### 余分\n", tag="phase8-betsu")),
    ("file:/x/t1/phase9-mihon/mihon-hou-{g}/mihon-hou-{g}-article-6.md", "本文だけ"),
    ("file:/x/t1/phase9-mihon/mihon-hou-{g}/mihon-hou-{g}-article-7.md", _document("'7'", "mihon-hou-{g}-art-7", "402AC000000{p}", "  segments:\n  - id: x\n    type: nazo\n    text: あ\n    modality: gimu\n", "### 第七条\n\nあ\n")),
    ("file:/x/t1/phase9-mihon/mihon-hou-{g}/mihon-hou-{g}-article-8.md", _document("'8'", "mihon-hou-{g}-art-8", "402AC000000{p}", "", "### 第八条\n\nい\n").replace("license: MIT\n", "").replace("/law/402AC", "/law/403AC")),
    ("file:/x/t1/phase9-mihon/mihon-hou-{g}/mihon-hou-{g}-article-9.md", _document("'9'", "mihon-hou-{g}-art-9", "402AC000000{p}", "", "### 第九条\n\nう\n").replace("1990-01-02", "1990-13-45").replace("status: none", "status: maybe")),
    ("file:/x/t1/phase9-mihon/mihon-hou-{g}/mihon-hou-{g}-article-10.md", _document("'11'", "mihon-hou-{g}-art-11", "402AC000000{p}", "", "### 第十一条\n\nえ\n").replace("number: 1\n", "number: 2\n")),
    ("file:/x/t1/phase9-mihon/mihon-hou-{g}/mihon-hou-{g}-article-12.md", _document("'12'", "mihon-hou-{g}-art-12", "402AC000000{p}", _SIMPLE.replace("simple", "tadashi"), "### 第十二条\n\nお\n")),
    ("file:/x/t1/futa-hou-{g}/futa-hou-{g}-article-3.md", _document("'3'", "futa-hou-{g}-art-3", "402AC0000000002", _SIMPLE, "### 第三条\n\nか\n")),
    ("file:/x/t1/phase9-mihon/mihon-hou-{g}/mihon-hou-{g}-article-13.md", "---\nlaw_id: 402AC000000{p}\n"),
])
