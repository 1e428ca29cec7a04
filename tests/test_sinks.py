"""The ledger of files and the partitioned table that takes rows by key."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from statuta.sources import articles, ledger, upsert

ROWS = "k long, part string, sub int, at int, x string"


def _files(at):
    return {str(p.relative_to(at)): p.stat().st_mtime_ns for p in Path(at).rglob("*.parquet")}


def test_only_touched_partitions_are_written(spark, tmp_path):
    at = str(tmp_path / "table")
    put = lambda rows: upsert.upsert(spark.createDataFrame(rows, ROWS), at, ("k",), ("part", "sub"), ("at",))
    read = lambda: sorted((tuple(r) for r in upsert.table(spark, at, spark.createDataFrame([], ROWS).schema).select("k", "part", "sub", "at", "x").collect()), key=repr)
    assert put([(1, "01", 1, 1, "a"), (2, "01", 2, 1, "b"), (3, "b", 1, 1, "c"), (None, "b", 1, 1, "n")]) == 3
    before = _files(at)
    # A newer and an older row for a known key, a new key, a repeated key, and a key that is null.
    assert put([(1, "01", 1, 2, "A"), (1, "01", 1, 0, "old"), (9, "01", 1, 5, "y"), (9, "01", 1, 6, "z"), (9, "01", 1, 6, "z")]) == 1
    after = _files(at)
    kept = {f for f in before if "sub=2" in f or "part=b" in f}
    assert kept and all(after[f] == before[f] for f in kept) and not {f for f in before if "sub=1" in f and "part=01" in f} & set(after)
    want = [(1, "01", 1, 2, "A"), (2, "01", 2, 1, "b"), (3, "b", 1, 1, "c"), (9, "01", 1, 6, "z"), (None, "b", 1, 1, "n")]
    assert read() == want
    # A merge that is run again changes nothing.
    put([(1, "01", 1, 2, "A"), (None, "b", 1, 0, "older")])
    assert read() == want
    assert put([]) == 0


def test_merges_in_turns_and_reads_pruned(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "TURN", 2)
    at = str(tmp_path / "table")
    rows = spark.range(50).selectExpr("id AS k", "string(id % 5) AS part", "1 AS sub", "0 AS at", "'x' AS x")
    assert upsert.upsert(rows, at, ("k",), ("part", "sub"), ("at",)) == 5
    table = upsert.table(spark, at, rows.schema)
    assert table.count() == 50
    inside = table.where(upsert._among(rows.schema, ["part", "sub"], [("3", 1)]))
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part" in plan.split("PartitionFilters: [")[1].split("]")[0] and inside.count() == 10
    assert len(inside.inputFiles()) < len(table.inputFiles()) or inside.where("part = '3'").count() == 10


@pytest.fixture
def tree(tmp_path):
    def write(name, text):
        at = tmp_path / "tree" / "t1" / "phase1-x" / "ichi-hou" / f"ichi-hou-article-{name}.md"
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text(text, encoding="utf-8")
        return at

    for i in range(5):
        write(i, f"---\nlaw_id: L{i}\narticle_number: '{i}'\n---\nbody {i}")
    return write


@pytest.mark.parametrize("most", [1, 10_000])
def test_files_are_parsed_once(spark, tmp_path, tree, monkeypatch, most):
    monkeypatch.setattr(ledger, "MOST", most)  # with 1, changed files are found by a join
    book, seen = ledger.Ledger(spark, str(tmp_path / "ledger")), []
    take = lambda files: seen.append(sorted(r.law_id for r in articles.parse(files).collect()))
    run = lambda: book.update(str(tmp_path / "tree"), take)
    assert run() == {"files": 5, "opened": 5, "taken": 5, "gone": 0} and seen.pop() == [f"L{i}" for i in range(5)]
    assert run() == {"files": 5, "opened": 0, "taken": 0, "gone": 0} and not seen and book.versions() == [1]
    tree(3, "---\nlaw_id: NEW\narticle_number: '3'\n---\nbody three")
    os.utime(tree(4, "---\nlaw_id: L4\narticle_number: '4'\n---\nbody 4"), (10**9, 10**9))  # touched, not changed
    assert run() == {"files": 5, "opened": 2, "taken": 1, "gone": 0} and seen.pop() == ["NEW"]
    assert run()["opened"] == 0
    (tmp_path / "tree/t1/phase1-x/ichi-hou/ichi-hou-article-0.md").unlink()
    tree("5", "---\nlaw_id: L5\narticle_number: '5'\n---\n")
    assert run() == {"files": 5, "opened": 1, "taken": 1, "gone": 1} and seen.pop() == ["L5"]
    assert book.known().count() == 5 and len(book.versions()) == 2


def test_a_run_that_fails_leaves_the_ledger_as_it_was(spark, tmp_path, tree):
    book = ledger.Ledger(spark, str(tmp_path / "ledger"))

    def fail(files):
        raise RuntimeError("no room")

    with pytest.raises(RuntimeError, match="no room"):
        book.update(str(tmp_path / "tree"), fail)
    assert book.versions() == [] and book.update(str(tmp_path / "tree"), lambda files: files.count())["taken"] == 5
    assert book.known().select(F.count_distinct("path")).first()[0] == 5
