"""Line differences: hunks give the other text back, and no script is shorter."""

import random
import time

import pytest

from statuta.operators import textdiff


def _least(a, b):
    """Edits of a shortest script, by the table of all prefixes."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], above if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


def test_scripts_are_shortest_and_give_the_text_back():
    rng = random.Random(2)
    for i in range(1500):
        a, b = ([rng.choice("abcdefgh"[: 1 + i % 8]) for _ in range(rng.randrange(12))] for _ in range(2))
        if i % 3 == 0:
            b = [x for x in a if rng.random() < 0.8] + ["z"] * (i % 2)
        old, new = "\n".join(a), "\n".join(b)
        edits = textdiff.hunks(old, new)
        assert textdiff.patched(old, edits) == new
        assert sum(r + len(x) for _, r, _, x in edits) == _least(old.split("\n"), new.split("\n"))
        assert all(new.split("\n")[j : j + len(x)] == x for _, _, j, x in edits)
        assert all(p[0] + p[1] < q[0] or p[2] + len(p[3]) < q[2] for p, q in zip(edits, edits[1:], strict=False))


@pytest.mark.parametrize("pair", [(None, None), ("", ""), (None, "a"), ("a\n", "a"), ("\n\n", "\n"), ("a\r\nb", "a\nb")])
def test_nulls_empty_texts_and_line_ends(pair):
    old, new = pair
    edits = textdiff.hunks(old, new)
    assert textdiff.patched(old, edits) == (new or "") and (edits == []) == ((old or "") == (new or ""))


def test_long_texts(monkeypatch):
    lines = [f"line {i % 700}" for i in range(60_000)]
    other = [x for i, x in enumerate(lines) if i % 997] + ["end"]
    began = time.process_time()
    edits = textdiff.hunks("\n".join(lines), "\n".join(other))
    assert textdiff.patched("\n".join(lines), edits) == "\n".join(other)
    assert sum(r + len(x) for _, r, _, x in edits) == 62
    # Beyond EDITS the script is put together from parts, and still gives the text back.
    monkeypatch.setattr(textdiff, "EDITS", 50)
    rng = random.Random(1)
    shuffled = rng.sample(lines[:3000], 3000)
    edits = textdiff.hunks("\n".join(lines[:3000]), "\n".join(shuffled))
    assert textdiff.patched("\n".join(lines[:3000]), edits) == "\n".join(shuffled)
    assert time.process_time() - began < 60


def test_articles_of_two_tiers(spark):
    old = spark.createDataFrame([("a", "1\n2\n3"), ("b", "x"), ("c", None), ("gone", "q")], "article_id string, body string")
    new = spark.createDataFrame([("a", "1\n3\n4"), ("b", "x"), ("c", "y"), ("new", "q")], "article_id string, body string")
    got = textdiff.between_tiers(old, new).orderBy("article_id").collect()
    assert [(r.article_id, [tuple(h) for h in r.hunks]) for r in got] == [("a", [(1, 1, 1, []), (3, 0, 2, ["4"])]), ("c", [(0, 1, 0, ["y"])])]
    back = textdiff.applied(old.join(textdiff.between_tiers(old, new), "article_id"), "body", "hunks", "article_id").orderBy("article_id").collect()
    assert [tuple(r) for r in back] == [("a", "1\n3\n4"), ("c", "y")]
    assert textdiff.between_tiers(old.limit(0), new).collect() == []
