"""Ranked search against scoring every text."""

import math
import random
import re
from collections import Counter

import pytest

from statuta.operators import search


def _plain(docs, queries, k):
    found = {i: Counter(re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) for i, t in docs if t is not None and i is not None}
    n, df = len(found), Counter(w for c in found.values() for w in c)
    mean = max(1, sum(sum(c.values()) for c in found.values()) // max(1, n))
    out = []
    for q, text in queries:
        asked = {w for w in re.findall("[a-z0-9]+", (text or "").lower()) if w in df}
        scores = {}
        for i, c in found.items():
            length = sum(c.values())
            parts = [round(math.log(1 + n / df[w]) * 1000) * (c[w] * 2_200_000 // (c[w] * 1000 + 300 + length * 900 // mean)) for w in asked if w in c]
            if parts:
                scores[i] = sum(parts)
        out += [(q, r, i, s) for r, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize(("span", "first"), [(1024, 4), (8, 2), (1, 1)])
def test_the_best_are_those_of_scoring_all(spark, span, first, monkeypatch):
    monkeypatch.setattr(search, "SPAN", span)
    monkeypatch.setattr(search, "FIRST", first)
    rng = random.Random(span)
    words = [f"w{i}" for i in range(40)] + ["Common", "é", "X-1"]
    docs = [(i - 20, " ".join(rng.choices(words, k=rng.randrange(1, 30)) + ["common"] * (i % 3))) for i in range(150)]
    docs += [(500, docs[3][1]), (501, docs[3][1]), (502, None), (503, ""), (504, "long " * 20_000 + "w3")]
    queries = [(1, "w1 w2 COMMON"), (2, "w3"), (3, "nothing known"), (4, None), (5, "common common"), (6, " ".join(words)), (7, docs[3][1])]
    index = search.build(spark.createDataFrame(docs, "id long, text string"), "id", "text")
    assert index.blocks.selectExpr("max(size(ids))").first()[0] <= span
    got = search.search(index, spark.createDataFrame(queries, "q int, text string"), "q", "text", 5)
    assert sorted(map(tuple, got.collect())) == _plain(docs, queries, 5)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "id long, text string")
    some = spark.createDataFrame([(1, "a b")], "id long, text string")
    assert search.search(search.build(none, "id", "text"), some, "id", "text").collect() == []
    assert search.search(search.build(some, "id", "text"), none, "id", "text").collect() == []


def test_no_pair_of_a_query_and_a_text_is_shuffled(spark):
    store = spark.sparkContext._jsc.sc().statusStore()
    written = lambda: sum(store.executorList(True).apply(i).totalShuffleWrite() for i in range(store.executorList(True).size()))
    rng = random.Random(5)
    words = [f"w{i}" for i in range(150)]
    docs = [(i, " ".join(rng.choices(words, k=60))) for i in range(4000)]
    queries = [(i, " ".join(words)) for i in range(100)]
    before = written()
    got = search.search(search.build(spark.createDataFrame(docs, "id long, text string"), "id", "text"), spark.createDataFrame(queries, "q int, text string"), "q", "text")
    assert got.count() == 1000
    # The texts are moved once and their postings once more, whatever is asked.
    assert written() - before < 4 * sum(len(t) for _, t in docs)


def test_several_turns_small_blocks_and_ids_of_several_texts(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERIES", 2)
    monkeypatch.setattr(search, "HELD", 50)
    monkeypatch.setattr(search, "SPAN", 64)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(25)]
    big = (1 << 53) + 7  # ids that a float does not hold
    docs = [(big + i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(200)]
    queries = [(f"q{i}", " ".join(rng.choices(words, k=5))) for i in range(9)]
    make = lambda rows: search.build(spark.createDataFrame(rows, "id long, text string"), "id", "text")
    got = search.search(make(docs), spark.createDataFrame(queries, "q string, text string"), "q", "text", 7)
    assert sorted(map(tuple, got.collect())) == _plain(docs, queries, 7)
    # Two texts of one length count as one that has the terms of both, a third of another length by itself.
    index = make([(1, "a b"), (1, "a c"), (1, "a"), (2, "d")])
    weight = lambda tf, length: tf * 2_200_000 // (tf * 1000 + 300 + length * 900)
    idf = round(math.log(1 + 4 / 2) * 1000)
    assert [tuple(r) for r in search.search(index, spark.createDataFrame([(1, "a")], "q int, text string"), "q", "text").collect()] == [(1, 1, 1, idf * (weight(2, 2) + weight(1, 1)))]
