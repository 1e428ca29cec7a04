"""The as-of join, the divergence audit and line dedup against plain Python, and on tables with every odd row."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest

from statuta.llm import asof, divergence, linededup

H = 3_600_000_000
EPOCH = datetime(1970, 1, 1)


def _us(t):
    return None if t is None else (t - EPOCH) // timedelta(microseconds=1)


def _time(ident, t):
    us = _us(t)
    return us - us % (6 * H) if us is not None and ident is not None and zlib.crc32(str(ident).encode()) % 2 else us


def _matched(clicks, sales):
    orders = defaultdict(list)
    for sale, client, total, sold in sales:
        at = _time(sale, sold)
        cents = None if total is None else int((100 * total + 0.5) // 1)
        for ident in [sale, -1 - sale] if sale is not None and zlib.crc32(str(sale).encode()) % 3 else [sale]:
            if client is not None and at is not None:
                orders[client].append((at, cents, ident))
    low = lambda x: (x is not None, x or 0)
    out = []
    for click, client, ts in set(clicks):
        ts = _time(click, ts)
        near = [o for o in orders[client] if ts is not None and client is not None and ts - 720 * H <= o[0] <= ts]
        if near:
            at = max(o[0] for o in near)
            tied = [o for o in near if o[0] == at]
            best = max(tied, key=lambda o: (low(o[1]), low(o[2])))
            out.append((click, client, ts, best[2], ts - at, best[1], len(tied)))
        else:
            out.append((click, client, ts, None, None, None, 0))
    return sorted(out, key=repr)


CLICKS = "click_id long, ts timestamp_ntz, client_id long, at string, best string, bits int"
SALES = "sale_id long, client_id long, total double, sold_at timestamp_ntz, key string, n long"


def _joined(spark, clicks, sales):
    left = spark.createDataFrame([(c, t, k, "x", None, 3) for c, k, t in clicks], CLICKS)
    right = spark.createDataFrame([(s, k, x, t, "k", None) for s, k, x, t in sales], SALES)
    frame = asof.clicks_to_orders(left, right)
    assert [t for _, t in frame.dtypes] == ["bigint"] * 7
    return sorted(map(tuple, frame.collect()), key=repr)


def test_asof_equals_comparing_all(spark):
    rng = random.Random(5)
    base = datetime(2024, 2, 1)
    # One client dense and bursty, one sparse, one with gaps beyond the tolerance, times on the borders.
    when = lambda k: base + (timedelta(microseconds=rng.choice([0, 1, 2, 31, 32, 33, 5000, 10**9, 12 * H, 6 * H, 720 * H, 720 * H + 1, rng.randrange(4000 * H)])) if k else timedelta(microseconds=rng.randrange(3 * 10**6)))
    clients = [0] * 5 + [1, 2, 3, None]
    sales = [(i if i % 50 else None, k, rng.choice([None, 1.0, 1.005, 2.5, float(rng.randrange(99))]), when(k) if i % 31 else None) for i in range(700) for k in [rng.choice(clients)]]
    sales += sales[:40]
    clicks = [(i, k, when(k) if i % 29 else None) for i in range(900) for k in [rng.choice(clients)]]
    assert _joined(spark, clicks + clicks[:80], sales) == _matched(clicks, sales)


def test_asof_before_1970_and_at_the_edge_of_the_tolerance(spark):
    t = datetime(1969, 12, 20, 3, 4, 5, 6)
    ids = [i for i in range(40) if not zlib.crc32(str(i).encode()) % 2][:4]
    sales = [(ids[0], 7, 1.0, t), (ids[1], 7, None, t), (ids[2], 8, 5.0, t)]
    clicks = [(ids[0], 7, t), (ids[1], 7, t + timedelta(hours=720)), (ids[2], 7, t + timedelta(hours=720, microseconds=1)), (ids[3], 8, t - timedelta(microseconds=1))]
    assert _joined(spark, clicks, sales) == _matched(clicks, sales)


def test_asof_of_empty_tables(spark):
    assert _joined(spark, [], []) == [] == _joined(spark, [], [(1, 1, 1.0, EPOCH)])
    assert _joined(spark, [(1, 1, EPOCH), (2, None, None)], []) == _matched([(1, 1, EPOCH), (2, None, None)], [])


def test_asof_pieces_are_few_per_bucket(spark):
    rows = [(1, at, 1) for at in [*range(3000), *range(10**7, 10**12, 10**9)]]
    spans = asof.intervals(spark.createDataFrame(rows, "key long, at long, n long").selectExpr("key", "at", "struct(n) AS best", "n"), asof.TOLERANCE)
    pieces = asof._pieces(spans, asof._widths(asof.TOLERANCE))
    assert pieces.count() <= 2 * len(rows)
    assert pieces.groupBy("key", "bits", "bucket").count().agg({"count": "max"}).first()[0] <= 2**asof.STEP + 2
    assert sorted((r.at, r.until) for r in spans.collect())[:2] == [(0, 1), (1, 2)]


def _audited(docs):
    docs = [[x or "" for x in d] for d in docs]
    word = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, df, everywhere = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        found = word.findall(text.translate(lower))
        n[lang, source].update(found)
        everywhere[lang].update(found)
        df[lang].update(set(found))
    out = []
    for lang, source in n:
        kept = [t for t in df[lang] if df[lang][t] >= 3]
        size = len(kept)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + size) for t in kept}

        p, q = shares(n[lang, source]), shares(everywhere[lang])
        f = lambda a, b: (a - b) ** 2 // b
        pair = [(sum(f(p[t], r[t]) for t in kept), other) for a, other in n if a == lang and other != source for r in [shares(n[lang, other])]]
        term = [(f(p[t], q[t]), t) for t in kept if n[lang, source][t] and p[t] > q[t]]
        for part, rows, most in (("pair", pair, None), ("term", term, 200)):
            for rank, (value, item) in enumerate(sorted(rows, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                out.append((lang, source, part, item, value, rank))
    return sorted(out)


DOCS = "text string, lang string, source string, term string, n int"


@pytest.mark.parametrize("error", [divergence.ERROR, 1.0])  # the second sketch has two counters a row, and lets everything pass
def test_divergence_equals_counting_all(spark, error, monkeypatch):
    monkeypatch.setattr(divergence.likely, "__defaults__", (3, error, divergence.CONFIDENCE))
    rng = random.Random(3)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}é" for i in range(60)] + ["Zoë", "ß", "x", "日本"]
    docs = [(" ".join(rng.choices(words, k=rng.randrange(40))).upper() if i % 7 else "A-b_c" * (i % 3), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "é", "", None])) for i in range(150)]
    docs += docs[:20] + [(None, "xx", "s1"), ("", "xx", "s2"), ("rare words only", "yy", None), ("rare words only", "yy", "z")]
    docs += [(f"q{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{'abcdefghijklmnopqrstuvwxyz'[i // 26]} common", "big", "all") for i in range(300) for _ in range(3)] + [("common", "big", "other")] * 3
    frame = divergence.audit(spark.createDataFrame([(*d, "t", 1) for d in docs], DOCS))
    assert frame.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    got = sorted(map(tuple, frame.collect()))
    assert got == _audited(docs)
    assert max(r[5] for r in got if r[2] == "term") == 200


def test_divergence_of_an_empty_table_and_of_texts_without_terms(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []
    docs = [("12 _", "a", "s"), (None, "a", "t"), ("", None, None)]
    assert sorted(map(tuple, divergence.audit(spark.createDataFrame([(*d, "t", 1) for d in docs], DOCS)).collect())) == _audited(docs)


def test_divergence_shares_are_exact_for_large_counts(spark):
    rows = [(c, t, v) for c, t, v in [(10**15 - 1, 3 * 10**15, 7), (0, 9 * 10**15, 1), (9 * 10**15, 9 * 10**15, 1), (0, 0, 0)]]
    frame = spark.createDataFrame(rows, "c long, t long, v long")
    got = [r[0] for r in frame.select(divergence.share(frame.c, frame.t, frame.v)).collect()]
    assert got == [1 + 10**9 * (c + 1) // max(1, t + v) for c, t, v in rows]


def _line_dedup(docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    keys = lambda text: [x.strip(" \t\n\x0b\x0c\r").translate(lower) for x in (text or "").split("\n")]
    held = defaultdict(set)
    low = lambda x: (x is not None, x or 0)
    for ident, text in docs:
        for k in keys(text):
            if len(k) >= 20:
                held[k].add(ident)
    out = []
    for ident, text in docs:
        every = (text or "").split("\n")
        stay = [x for x, k in zip(every, keys(text), strict=True) if len(held[k]) < 3 or low(ident) == max(map(low, held[k]))]
        out.append((ident, len(every), len(every) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=repr)


def _deduped(spark, docs, parts=None):
    frame = spark.createDataFrame([(i, t, b"b", 1, [2]) for i, t in docs], "doc_id long, text string, bitmap binary, mark int, places array<int>")
    if parts:
        frame = frame.repartition(parts)
    return sorted(map(tuple, linededup.report(frame).collect()), key=repr)


def test_line_dedup_equals_comparing_all(spark):
    rng = random.Random(1)
    lines = [f"this is line number {i:03d}" for i in range(40)] + ["short", "", "   ", "é" * 19, "é" * 20, "ÀÉ" * 10, "\x1cno blank of this rule"]
    shaped = lambda x: rng.choice([x, x.upper(), f" \t{x}\r", f"\x0b{x}\x0c "])
    docs = [(rng.choice([i, 3, None]), "\n".join(shaped(rng.choice(lines[: 10 + i % 37])) for _ in range(rng.randrange(12)))) for i in range(120)]
    docs += docs[:9] + [(500, None), (501, ""), (502, "\n"), (None, None)]
    assert _deduped(spark, docs) == _line_dedup(docs)


def test_a_line_of_a_third_of_all_rows_fills_partitions(spark):
    # The line is in most documents, so it crosses the borders of all partitions; a text is very long as well.
    docs = [(i, "a line that nearly every document has\n" * (1 + i % 3) + f"a line of document {i // 2:06d} alone") for i in range(2000)] + [(5000, "x\n" * 60_000 + "y" * 60_000)]
    assert _deduped(spark, docs, 5) == _line_dedup(docs)


def test_line_dedup_of_an_empty_table(spark):
    assert _deduped(spark, []) == []


def test_bitmaps_are_small_and_say_what_stays(spark):
    docs = [(i, "\n".join(["the same line in all documents"] * 5000 + ["own"])) for i in range(4)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    maps = {r.doc_id: r.bitmap for r in linededup.keep_bitmaps(frame).collect()}
    assert sorted(maps) == [0, 1, 2] and max(map(len, maps.values())) < 50
    assert linededup.kept_lines(docs[0][1].encode(), maps[0]) == (b"own", 5001, 5000)
    assert {r.doc_id: r.text for r in linededup.applied(frame, linededup.keep_bitmaps(frame)).collect()} == {**{i: "own" for i in range(3)}, 3: docs[3][1]}
