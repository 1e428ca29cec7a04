import pytest
from pyspark.sql import functions as F

from statuta import cli
from statuta.functions import anonymize, domains, numerals
from statuta.sources import questions


@pytest.fixture
def files(tmp_path):
    folder = tmp_path / "t1" / "phase1-x" / "ichi-hou"
    folder.mkdir(parents=True)
    (folder / "ichi-hou-article-1.md").write_text("---\nlaw_id: L\narticle_number: '1'\narticle_id: ichi-hou-art-1\nparagraphs: []\ntags: []\n---\n\nbody\n", encoding="utf-8")
    (folder / "ichi-hou-article-2.md").write_text("no front matter", encoding="utf-8")
    return tmp_path


def test_results_have_paths_relative_to_the_root(files, spark, monkeypatch, capsys):
    monkeypatch.setattr(cli, "_session", lambda: spark)
    one, two = (str(files / f"t1/phase1-x/ichi-hou/ichi-hou-article-{i}.md") for i in (1, 2))
    assert cli.validate([two, one], str(files)) == 1
    out = capsys.readouterr()
    assert out.out.splitlines()[1] == "FAIL t1/phase1-x/ichi-hou/ichi-hou-article-2.md: V0" and out.out.startswith("FAIL t1/phase1-x/ichi-hou/ichi-hou-article-1.md: V1")
    assert out.err.strip() == "violations in 2 of 2 files"
    assert cli.validate([]) == 2 and cli.format_result("/elsewhere/a.md", [], "/root") == "PASS /elsewhere/a.md"


def test_laws_and_articles_are_found(files, spark, monkeypatch, capsys):
    monkeypatch.setattr(cli, "_session", lambda: spark)
    assert cli.show(str(files), "ichi-hou") == 0 and "ichi-hou-art-1 L" in capsys.readouterr().out
    assert cli.show(str(files), "ichi-hou", "1") == 0 and "body" in capsys.readouterr().out
    assert cli.show(str(files), "ichi-hou", "9") == 1


def test_the_known_names(spark):
    frame = spark.createDataFrame([("a@b.co 第3条 12",)], "t string")
    assert frame.select(anonymize.detect_pii(F.col("t")), anonymize.anonymize_text(F.col("t"))).first()[:] == (True, "a@b.co 第3条 [N]") and anonymize.PATTERNS


def test_numerals_both_ways(spark):
    frame = spark.range(0, 10_001).select("id", numerals.int_to_kanji(F.col("id")).alias("k"))
    back = frame.select("id", "k", numerals.kanji_to_int(F.col("k")).alias("n"))
    assert back.where("n = id").count() == 9999 and {r.id for r in back.where("k IS NULL").collect()} == {0, 10_000}
    assert [r.k for r in frame.where("id IN (36, 105, 1234)").orderBy("id").collect()] == ["三十六", "百五", "千二百三十四"]


def test_pending_names_are_null(spark):
    frame = spark.createDataFrame([("(English name pending)",), ("Civil Code",), (None,)], "t string")
    assert [r[0] for r in frame.select(domains.english_name(F.col("t"))).collect()] == [None, "Civil Code", None]
    assert callable(questions.append_jdbc)
