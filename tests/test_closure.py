import random

import pytest

from statuta.functions import user
from statuta.operators import closure


def _plain(edges):
    steps, out = {}, {}
    for a, b in edges:
        if a is not None and b is not None:
            steps.setdefault(a, set()).add(b)
    for start in steps:
        depth, front = 0, {start}
        while front:
            depth, front = depth + 1, {y for x in front for y in steps.get(x, ()) if (start, y) not in out}
            out |= {(start, y): depth for y in front}
    return sorted((a, b, d, (b, a) in out) for (a, b), d in out.items())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_closure_equals_following_every_link(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(18 * seed)] + [(None, 1), (2, None), (7, 7)] * 2
    found, rounds = closure.closure(spark.createDataFrame(edges, "source long, target long"))
    want = _plain(edges)
    assert sorted(map(tuple, found.collect())) == want and rounds == max(d for _, _, d, _ in want)


def test_closure_of_a_chain_of_nothing_and_with_a_bound(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(6)], "source long, target long")
    assert closure.closure(chain)[1] == 6 and closure.closure(chain)[0].count() == 21
    bounded, rounds = closure.closure(chain, most=2)
    assert rounds == 2 and bounded.count() == 11
    nothing, rounds = closure.closure(chain.limit(0))
    assert rounds == 0 and nothing.collect() == [] and nothing.columns == ["source", "target", "depth", "cyclic"]


def test_user_functions_from_sql(spark):
    user.register(spark)
    rows = [(1, 0, "a", 2.0), (1, 1, "a", 2.0), (1, 2, None, 0.0), (1, 3, None, -1.0), (1, 4, "a", 4.0), (2, 0, "b", 0.0)]
    frame = spark.createDataFrame(rows, "k long, s int, kind string, x double").selectExpr("k", "timestamp_seconds(s) AS t", "kind", "x")
    found = spark.sql("SELECT * FROM runs(TABLE({f}) PARTITION BY k ORDER BY t)", f=frame).collect()
    assert sorted((r.k, r.kind or "-", r.n) for r in found) == [(1, "-", 2), (1, "a", 1), (1, "a", 2), (2, "b", 1)]
    means = spark.sql("SELECT k, harmonic(s) AS m FROM (SELECT k, harmonic_part(x) AS s FROM {f} GROUP BY k, pmod(hash(t), 3)) GROUP BY k", f=frame).collect()
    assert {r.k: r.m for r in means} == {1: 2.4, 2: None}
    assert spark.sql("SELECT * FROM runs(TABLE({f}) PARTITION BY k ORDER BY t)", f=frame.limit(0)).collect() == []
