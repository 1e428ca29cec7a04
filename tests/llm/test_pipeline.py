"""The pipeline's stages, each against a plainer way, on its own input."""

import collections

import corpus_pipeline
from conftest import SF
from test_operators import AWKWARD, DDL, classes_by_brute_force

from statuta.llm import bpe, pii


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "minhash", "pii", "mixing", "bpe"]
    seen = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != names[-1]:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
    kept = {r["doc_id"] for r in seen["minhash"]}
    assert kept == {d for d, _, c in classes_by_brute_force([(r["doc_id"], r["text"]) for r in seen["language_id"]], 5) if d == c} and len(seen["minhash"]) == len(kept)
    gone = {r["doc_id"]: r["text"] for r in seen["documents"]}
    for r in seen["language_id"]:
        gone.pop(r["doc_id"])
    # What goes has no letter, or is a few words again and again.
    assert all(not any(map(str.isalpha, t or "")) or len(set(t.split())) < len(t.split()) / 4 for t in gone.values()) and len(gone) < len(seen["documents"]) / 20
    assert not any(pii.spans(r["text"]) for r in seen["pii"]) and {r["doc_id"] for r in seen["pii"]} == kept
    assert {r["doc_id"] for r in seen["mixing"]} <= kept and max(collections.Counter(r["doc_id"] for r in seen["mixing"]).values()) <= 2
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, seen["bpe"])) == sorted(map(tuple, bpe.report(spark.read.parquet(str(tmp_path / "mixing"))).collect()))


def test_awkward_rows(spark):
    for rows in (AWKWARD, []):
        docs = spark.createDataFrame(rows, DDL)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()
