import pytest
from pyspark.sql import functions as F

from statuta import samples as S
from statuta import schema
from statuta.functions import clauses
from statuta.operators import citations, integrity, safety, structure, versions
from statuta.plans import reports
from statuta.sources import articles, frontmatter, questions


@pytest.fixture(scope="module")
def parsed(spark):
    return articles.parse(S.DOCUMENTS.one(spark))


def test_parse_keeps_every_row(parsed):
    rows = {r["path"].rsplit("-article-")[1]: r for r in parsed.collect()}
    assert set(rows) == {f"{n}.md" for n in ("1", "2-3", "3", "4", "6", "7", "8", "9", "10", "12", "13")}
    assert rows["6.md"]["corrupt"] == "no front matter" and rows["6.md"]["law_abbrev"] == "mihon-hou-0"
    one = rows["1.md"]
    assert one["article_number"] == "1" and one["machine_translated"] is False and one["cases"] == [] and one["tags"] == ["phase9-mihon", "auto-generated"]
    assert one["paragraphs"][0]["segments"][0]["text"] == "見本の区域は、従来の区域による。" and one["parent_section"] is None
    assert rows["2-3.md"]["parent_section"]["shou"] == 1 and rows["2-3.md"]["paragraphs"][0]["segments"] == [] and rows["4.md"]["paragraphs"][0]["segments"] is None


def test_render_and_read_again(spark, parsed, tmp_path):
    good = parsed.where("corrupt IS NULL")
    articles.write_articles(good.withColumn("tier", F.lit("t1")), str(tmp_path))
    again = articles.read_articles(spark, str(tmp_path))
    columns = ["article_id", "law_name_ja", "version_date", "paragraphs", "tags", "parent_section", "body"]
    left, right = ({r["article_id"]: r for r in d.select(columns).collect()} for d in (good, again))
    assert left == right
    assert articles.read_articles(spark, str(tmp_path), law_abbrev="nichts").count() == 0


@pytest.mark.parametrize("text", ["a: [x\n  b", "a", "a: 'x\n", "a: 1\na: 2\n"])
def test_malformed(text):
    with pytest.raises(frontmatter.Malformed):
        frontmatter.parse(text) if text != "a: [x\n  b" else frontmatter.parse("a:\n- b\n  c\n d: e\n")


def test_dump_is_read_back():
    fields = {"a": "x: y", "b": ["'q'", "12", ""], "c": [{"d": 1, "e": [{"f": True}]}], "g": {"h": "第一編　総則"}, "i": []}
    read = frontmatter.parse(frontmatter.dump(fields))
    assert read == {"a": "x: y", "b": ["'q'", "12", ""], "c": [{"d": "1", "e": [{"f": "true"}]}], "g": {"h": "第一編　総則"}, "i": []}


def test_violations(parsed):
    got = {r["path"].rsplit("-article-")[1]: r["violations"] for r in integrity.validate(parsed).collect()}
    assert got == {"1.md": [], "2-3.md": [], "4.md": ["V2", "V5", "V8", "V11"], "6.md": ["V0"], "7.md": ["V10"], "3.md": [], "8.md": ["V1", "V4"], "9.md": ["V6", "V9"], "10.md": ["V3", "V7"], "12.md": ["V12"], "13.md": ["V0"]}
    assert integrity.exit_code(integrity.validate(parsed)) == 1
    assert integrity.exit_code(integrity.validate(parsed.where("article_number = '1'"))) == 0
    assert integrity.exit_code(integrity.validate(parsed.where("false"))) == 2
    assert {r["rule"]: r["n"] for r in reports.quality(parsed).collect()}["OK"] == 3


def test_guards_fail_loudly(spark):
    members = S.MEMBERS.one(spark)
    good = members.where(F.col("law_abbrev").isin("alpha-0", "beta-0"))
    assert sum(r["n_articles"] for r in integrity.guarded_manifest(good).collect()) == 3
    for bad in ("dup-0", "noid-0"):
        with pytest.raises(integrity.IntegrityError):
            integrity.guarded_manifest(good.unionByName(members.where(F.col("law_abbrev") == bad)))


def _tree(root, *files):
    for phase, law, number, law_id in files:
        at = root / "t9" / phase / law / f"{law}-article-{number}.md"
        at.parent.mkdir(parents=True, exist_ok=True)
        ident = f"law_id: {law_id}\n" if law_id else ""
        at.write_text(f"---\n{ident}law_name_ja: 法\narticle_number: \"{number}\"\narticle_id: {law}-art-{number}\nversion_date: '2001-02-03'\nlast_verified: '2026-05-20'\nparagraphs: []\ntags: []\n---\n\n# 法\n", encoding="utf-8")
    return str(root)


def test_trees_of_files_reach_the_guards(spark, tmp_path):
    valid = _tree(tmp_path / "valid", ("phase1-a", "ichi-hou", "1", "L1"), ("phase1-a", "ichi-hou", "2", "L1"), ("phase2-b", "ni-hou", "1", "L2"))
    twice = _tree(tmp_path / "twice", ("phase1-a", "ichi-hou", "1", "L1"), ("phase2-b", "ichi-hou", "1", "L1"))
    without = _tree(tmp_path / "without", ("phase1-a", "ichi-hou", "1", None), ("phase1-a", "ni-hou", "1", "L2"))
    read = lambda root: articles.read_articles(spark, root)
    assert {(r.law_abbrev, r.law_id, r.phase, r.n_articles) for r in integrity.guarded_manifest(read(valid)).collect()} == {("ichi-hou", "L1", "phase1-a", 2), ("ni-hou", "L2", "phase2-b", 1)}
    with pytest.raises(integrity.IntegrityError, match="ichi-hou.*phase1-a.*phase2-b"):
        integrity.guarded_manifest(read(twice))
    with pytest.raises(integrity.IntegrityError, match="without law_id"):
        integrity.guarded_manifest(read(without))
    assert read(without).count() == 2 and [r.law_abbrev for r in integrity.missing_keys(read(without)).collect()] == ["ichi-hou"]


def test_guards_read_every_file_once(spark, tmp_path):
    from statuta.sources import articles as source

    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    rows = source.parse(S.DOCUMENTS.one(spark)).where("corrupt IS NULL")
    rows = rows.mapInPandas(count, rows.schema)
    assert integrity.guarded_manifest(rows).count() == 2 and seen.value == rows.count() == 9 or seen.value == 9


def test_flat_field(spark):
    frame = spark.createDataFrame([('---\nlaw_id: A\narticle_number: "1"\nversion_date: \'2001-01-01\'\n---\nlaw_id: B\n',)], "v string")
    assert tuple(frame.select(*(articles.flat_field(F.col("v"), k) for k in ("law_id", "article_number", "version_date", "nichts"))).first()) == ("A", "1", "2001-01-01", None)


def test_structure(spark, parsed):
    rows = {r["article_id"]: r for r in structure.paragraphs(parsed.where("corrupt IS NULL")).collect()}
    assert rows["mihon-hou-0-art-1"]["text"] == "見本の区域は、従来の区域による。" and rows["mihon-hou-0-art-2-3"]["named"]["article_number"] == "2-3"
    frame = spark.createDataFrame([("# 甲 第1条(（見出し）)\n\n### 第一条\n\n<!-- segment: simple id: x -->\n| a | b |\n|---|---|\n| c | d |",)], "body string")
    assert frame.select(structure.caption(F.col("body"))).first()[0] == "見出し"
    cells = structure.table_cells(frame, "body").orderBy("line", "column").collect()
    assert [r["cell"] for r in cells] == ["a", "b", "c", "d"]
    flags = spark.createDataFrame([([("tadashi",)],), ([],)], "s array<struct<type:string>>").select(structure.flags(F.col("s")).alias("f")).select("f.*").collect()
    assert [tuple(r) for r in flags] == [(False, True), (False, False)]


def test_segment_ids(spark):
    rows = structure.segments(S.PARAGRAPHS.one(spark)).collect()
    assert {"mihon-hou-0-art-5-p1-honbun", "mihon-hou-0-art-5-p1-tadashi", "mihon-hou-0-art-2-p1-hashira", "mihon-hou-0-art-4-p2"} <= {r["id"] for r in rows}
    assert all(r["type"] in schema.SEGMENT_TYPES and r["modality"] in schema.MODALITIES for r in rows)
    assert [r["override_target"] for r in rows if r["override_flag"]] == [["第三条"]]
    assert spark.createDataFrame([("削除 ",)], "t string").select(clauses.is_repealed(F.col("t"))).first()[0]


def test_resolution(spark):
    found = {(r["article_number"], r["target"]): r["targets"] for r in citations.resolve(S.PHRASES.one(spark), S.NUMBERS.one(spark)).collect()}
    assert found["10", "前条"] == ["9"] and found["10-2", "前二条"] == ["9", "10"] and found["48-9", "次条"] == ["48-9-7-2"]
    assert found["2", "前三条"] is None and found["3", "前条"] is None and found["9", "本条"] == ["9"] and found["9", "同項"] is None


def test_encoding(spark):
    checked = safety.check_encoding(spark.createDataFrame([("abc",), (None,), ("日本",)], "t string"), "t")
    assert safety.verdict(checked) == (0, "cp932-safe")
    assert safety.verdict(safety.check_encoding(spark.createDataFrame([("a—b",)], "t string"), "t"))[0] == 1


def test_diff_ignores_nothing(spark):
    got = {r["article_id"]: (r["status"], r["changed"]) for r in versions.diff(S.OLD.one(spark), S.NEW.one(spark)).collect()}
    assert got == {"a-0-art-1": ("same", []), "a-0-art-2": ("changed", ["tag"]), "a-0-art-3": ("removed", []), "a-0-art-4": ("added", []), "b-0-art-1": ("changed", ["law_name", "body"]), "b-0-art-2": ("same", [])}


def test_question_log(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a@b.co 3", 1, True, 2.5), (2, "第3条", None, False, None)], "question_id int, question string, feedback int, clicked boolean, dwell_seconds double")
    for _ in range(2):
        questions.append(rows, str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 4 and log.where("question_id = 1 AND raw IS NULL AND anonymized = 'a@b.co [N]'").count() == 2


def test_xml(spark, tmp_path):
    from statuta.sources.law_xml import read_laws

    (tmp_path / "law.xml").write_text("<Law><Article Num='1'><T>甲</T></Article><Article Num='2'><T>乙</T></Article></Law>", encoding="utf-8")
    assert [r["T"] for r in read_laws(spark, str(tmp_path / "law.xml"), schema="_Num string, T string").orderBy("_Num").collect()] == ["甲", "乙"]


def test_command_line(spark, parsed, tmp_path, capsys):
    from statuta import cli

    articles.write_articles(parsed.where("corrupt IS NULL").withColumn("tier", F.lit("t1")), str(tmp_path))
    at = f"{tmp_path}/t1/phase9-mihon/mihon-hou-0/mihon-hou-0-article"
    assert cli.main(["validate"]) == 2 and cli.main(["validate", f"{at}-1.md"]) == 0 and cli.main(["validate", f"{at}-1.md", f"{at}-4.md"]) == 1
    said = capsys.readouterr()
    assert "PASS" in said.out and "V2, V5, V8" in said.out and "violations in 1 of 2 files" in said.err
    assert cli.main(["check-encoding", "--path", str(tmp_path)]) == 0 and "cp932-safe" in capsys.readouterr().out
    (tmp_path / "x.md").write_text("a\u2014b", encoding="utf-8")
    assert cli.main(["check-encoding", "--path", str(tmp_path)]) == 1 and "FAIL" in capsys.readouterr().err
    assert cli.main(["get-article", str(tmp_path), "mihon-hou-0", "1"]) == 0 and cli.main(["get-article", str(tmp_path), "mihon-hou-0", "99"]) == 1 and cli.main(["get-law", str(tmp_path), "mihon-hou-0"]) == 0
