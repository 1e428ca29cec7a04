"""Every operator against a plainer way to get the same, on small tables with awkward rows."""

import collections
import math
import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pytest
from conftest import SF, rows_of
from pyspark.sql import functions as F

from statuta.llm import bpe, components, fingerprints, langid, mixing, neardup, pii, queries, tokencount, toolcalls, toxicity, vectors

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def lorem(k, n=60):
    rng = np.random.default_rng(k)
    return " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(n))


AWKWARD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "x", "en", "a", 1), (4, "Straße ÉTÉ ΑΣ İ <|endoftext|> it's 12²½　\u0085", "de", "b", 9), (5, lorem(1), "en", "a", 5),
    (6, lorem(1), "en", "a", 5), (6, lorem(1), "en", "a", 5), (7, lorem(1, 59) + " zz", "en", None, 5), (8, lorem(2), "fr", "b", 5), (9, "mail a.b+c@d-e.fr or +33 (0)1 23-45 67, 192.168.1.300, 4111 1111 1111 1111", "fr", "b", 5),
    (10, "w" * 5000 + " " + lorem(3, 3000), "es", "c", 5), (11, " \t\n\x0b ", "es", "c", 5), (None, lorem(4), "es", "c", 5), (12, "😀 a\nb\n\n", "en", "c", 5), (13, lorem(2), None, "", 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + ("extra",) for r in AWKWARD], DDL + ", `key` string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", [n for n in queries.queries() if n in queries.oracle_sql()])
def test_query_says_what_sql_says(spark, duck, name):
    got, want = queries.queries()[name](spark, SF).toPandas(), duck.execute(queries.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


# 1 -------------------------------------------------------------------------------------------


def plain_spans(text):
    text = text or ""
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_pii_base_spans(docs, real):
    rng = np.random.default_rng(0)
    noise = ["".join(rng.choice(list("ab1234567890.@-+ ()"), 60)) for _ in range(3000)] + ["@".join("ab.c" for _ in range(50)), "1" * 20000, "1." * 9000, "a" * 20000 + "@", "4111-1111 1111-1111", "1.2.3.4.5.6.7.8", "001.02.3.255"]
    for text in [r[0] for r in real.select("text").collect()] + [r[1] for r in AWKWARD if not r[1] or len(r[1]) < 3000] + noise:
        if len(set(text or "")) > 1 or len(text or "") < 100:
            assert pii.base_spans(text or "") == plain_spans(text), text
    rows = {r["doc_id"]: r for r in pii.report(docs).collect()}
    assert rows[9]["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(AWKWARD[9][1])) and (rows[9]["n_email"], rows[9]["n_ip"], rows[9]["n_card"], rows[9]["n_phone"]) == (1, 0, 1, 1)
    assert rows[9]["base_sha256"] == sha256(rows[9]["spans"].encode()).hexdigest() and rows[1]["spans"] == "" and len(rows) == len({r[0] for r in AWKWARD})


def test_pii_checks_and_context():
    assert [s.kind for s in pii.spans("my iban DE89 3704 0044 0532 0130 00 today")] == ["iban"] and not pii.spans("my iban DE88 3704 0044 0532 0130 00 today")
    assert [s.kind for s in pii.spans("ssn 123-45-6789")] == ["ssn"] and not pii.spans("part 123-45-6789") and not pii.spans("ssn 000-45-6789")
    a, b = (pii.spans(f"{w} 10.0.0.1")[0].score for w in ("server", "version"))
    assert a > b and pii.redact("x a@b.co y 10.0.0.1") == "x [EMAIL] y [IP]" and pii.redact(None) is None


def test_pii_adds_what_ran_together():
    said = lambda t: [t[s.start : s.end] for s in pii.spans(t)]
    assert said("tel +1 (269) 555-3296 4524132264652876 x") == ["4524132264652876", "+1 (269) 555-3296"] or not pii.luhn("4524132264652876")
    assert said("+1 (269) 555-3296 192.168.0.1") == ["192.168.0.1", "+1 (269) 555-3296"]
    assert said("10.0.0.1 4111 1111 1111 1111") == ["10.0.0.1", "4111 1111 1111 1111"] and not said("1 2222 3333 4444 5555 66")


def test_pii_clean_keeps_columns(docs, empty):
    out = pii.clean(docs)
    assert out.columns == docs.columns and out.count() == docs.count() and not [r for r in out.collect() if pii.spans(r["text"])] and pii.clean(empty).count() == 0


# 2 -------------------------------------------------------------------------------------------


def test_language(spark, docs, empty, real):
    got = langid.report(real).toPandas().merge(real.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() >= 0.95 and got.score.between(0, 1).all()
    rows = collections.defaultdict(list)
    for r in langid.report(docs).collect():
        rows[r["doc_id"]].append(r)
    assert rows[1][0]["lang_pred"] == rows[2][0]["lang_pred"] == rows[11][0]["lang_pred"] == "und" and rows[5][0]["lang_pred"] != "und" and sum(map(len, rows.values())) == len(AWKWARD)
    assert langid.report(empty).count() == 0 and {r["lang_pred"] for r in langid.report(docs.where("lang IS NULL")).collect()} == {"und"}
    assert langid.accepted(docs).count() == sum(langid.has_letter(r[1]) for r in AWKWARD) and langid.accepted(docs).columns == docs.columns


def _plain_predictions(docs, usable):
    """Prototypes and cosines by the definition, one text and one n-gram at a time."""
    def vector(text):
        words = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        out = np.zeros(langid.DIM)
        for k in range(len(words) - 2):
            a, b, c = (langid._signs(0 if x == " " else ord(x)).astype(float) for x in words[k : k + 3])
            out += np.roll(a, 2) * np.roll(b, 1) * c
        return out / max(1, len(words) - 2) if words.strip() else out

    taught = collections.defaultdict(list)
    for ident, text, lang in docs:
        if usable(ident) and text is not None and lang is not None:
            taught[lang].append(vector(text))
    unit = lambda v: v / max(1e-9, np.linalg.norm(v))
    directions = {x: unit(np.mean(v, axis=0)) for x, v in sorted(taught.items())}
    mean = np.mean(list(directions.values()), axis=0)
    out = {}
    for ident, text, _ in docs:
        if not text or not any(map(str.isalpha, text)):
            out[ident] = ("und", 0.0)
            continue
        v = unit(vector(text))
        v = unit(v - (v @ mean) / (mean @ mean) * mean)
        out[ident] = max(((x, float(v @ unit(d - mean))) for x, d in directions.items()), key=lambda x: x[1])
    return out


@pytest.mark.parametrize("most", [2, 1000])
def test_language_equals_the_definition_for_any_number_of_languages(spark, most, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", most)  # with 2, the seven languages are learned and met in blocks
    rng = random.Random(8)
    letters = {f"l{k}": "".join(rng.sample("abcdefghijklmnopqrstuvwxyzéß", 9)) for k in range(7)}
    docs = [(i, " ".join("".join(rng.choices(letters[x], k=rng.randrange(1, 8))) for _ in range(rng.randrange(1, 12))), x if i % 9 else None) for i in range(150) for x in [rng.choice(list(letters))]]
    docs += [(200, None, "l1"), (201, "", "l2"), (202, "12 .", "l3"), (203, "äöü " * 6000, None)]
    usable = lambda i: zlib.crc32(str(i).encode()) % 4 != 2
    want = _plain_predictions(docs, usable)
    frame = spark.createDataFrame([(*d, 1, 2.0) for d in docs], "doc_id long, text string, lang string, judged int, found double")
    got = {r.doc_id: r for r in langid.report(frame).collect()}
    assert len(got) == len(docs)
    for i, (lang, score) in want.items():
        assert got[i].lang_pred == lang and abs(got[i].score - min(1, max(0, score))) < 1e-4
    kept = langid.accepted(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} >= {d[0] for d in docs[:150]} - {i for i in range(150) if want[i][1] < 0.5}


def test_bundles_are_sums_of_bound_vectors():
    text = "Ab, a!"
    want = np.zeros(langid.DIM)
    padded = " ab a "
    for k in range(len(padded) - 2):
        a, b, c = (langid._signs(0 if x == " " else ord(x)) for x in padded[k : k + 3])
        want += np.roll(a, 2) * np.roll(b, 1) * c
    assert (langid.bundles([text, ""])[0][0] == want).all() and langid.bundles(["x", text])[1].tolist() == [1, 4]


# 3 -------------------------------------------------------------------------------------------


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free = {}, set(order)
    while True:
        left = 1.5 * sum(sizes.values()) - sum(target.values())
        level = left / max(1, sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over


@pytest.mark.parametrize("which", ["docs", "real"])
def test_mixing(request, which):
    frame = request.getfixturevalue(which)
    source = {r["doc_id"]: r["source"] for r in frame.collect()}
    rows = mixing.plan(frame).collect()
    assert len(rows) == frame.count() and sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.plan(frame.repartition(5)).collect()), key=str)
    sizes, taken, most, target = collections.Counter(), collections.Counter(), collections.Counter(), {}
    for r in rows:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        most[s] = max(most[s], r["size"])
        target[s] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert target == pytest.approx(plain_targets(sizes))
    assert all(abs(taken[s] - target[s]) <= 2 * most[s] for s in sizes)
    out = mixing.sample(frame)
    assert out.columns == frame.columns and out.count() == sum(r["copies"] for r in rows)


def test_mixing_empty(empty):
    assert mixing.plan(empty).count() == 0 and mixing.sample(empty).count() == 0


# 4 -------------------------------------------------------------------------------------------


def test_prefix_hash_and_common_extension():
    rng = np.random.default_rng(1)
    a, b = ("".join(rng.choice(list("ab"), 300)) for _ in range(2))
    x, y = fingerprints.PrefixHash(a), fingerprints.PrefixHash(b)
    for i, j in rng.integers(0, 300, (200, 2)).tolist():
        n = 0
        while i + n < 300 and j + n < 300 and a[i + n] == b[j + n]:
            n += 1
        assert x.common(i, y, j) == n
        assert (x.span(i, min(300, i + 5)) == y.span(j, min(300, j + 5))) == (a[i : i + 5] == b[j : j + 5])


@pytest.mark.parametrize("which", ["docs", "real"])
def test_fingerprints(request, which):
    frame = request.getfixturevalue(which)
    rows = sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    want = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, u = t or "", u or ""
        k = len(t) // 4
        e = t[: len(t) - k] + u[:k]
        f, g, h = (fingerprints.fingerprint(fingerprints.PrefixHash(x)) for x in (t, e, u))
        want.append((i, len(t), sha256(e.encode()).hexdigest(), f, g, fingerprints.likeness(f, g), fingerprints.likeness(f, h)))
    got = [tuple(r)[:7] for r in fingerprints.report(frame.repartition(4)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r["common_prefix"] >= r["n_chars"] - r["n_chars"] // 4 for r in fingerprints.report(frame).collect())


def test_likeness_estimates_the_share_of_common_spans():
    for k in range(20):
        text, other = lorem(k, 500), lorem(k + 50, 500)
        cut = len(text) * k // 20
        both = text[:cut] + other[cut:]
        spans = [{t[i : i + fingerprints.SPAN] for i in range(len(t) - fingerprints.SPAN + 1)} for t in (text, both)]
        got = fingerprints.likeness(*(fingerprints.fingerprint(fingerprints.PrefixHash(t)) for t in (text, both)))
        assert abs(got - len(spans[0] & spans[1]) / len(spans[0] | spans[1])) < 0.25


def test_fingerprints_of_none_and_one(spark, empty):
    assert fingerprints.report(empty).count() == 0
    one = fingerprints.report(spark.createDataFrame([(5, "abcdefgh", None, None, None)], DDL)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["edited_sha256"] == sha256(b"abcdefab").hexdigest()


# 5 -------------------------------------------------------------------------------------------


def test_attribution():
    ends = np.array([3, 6, 10])
    assert tokencount.attribute(np.array([(0, 2), (2, 5), (5, 7), (4, 10)]), ends)[0].tolist() == [1, 2, 1]
    assert tokencount.lines("a\nb\n\n").tolist() == [2, 4, 5] and tokencount.lines("").tolist() == []


def test_token_counts(docs, real, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokencount.default_path().replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    for frame in (docs, real):
        text = collections.defaultdict(list)
        for r in frame.collect():
            text[r["doc_id"]].append(r["text"] or "")
        for r in tokencount.report(frame).collect():
            whole = text[r["doc_id"]][0]
            counts = [int(x) for x in r["section_tokens"].split(",") if x]
            assert sum(counts) == r["n_tokens"] == len(t.encode(whole, add_special_tokens=False).ids) and len(counts) == len(whole.splitlines(keepends=True) if "\x0b" not in whole and "\u0085" not in whole else tokencount.lines(whole))
    assert tokencount.report(empty).count() == 0


# 6 -------------------------------------------------------------------------------------------


def test_tool_calls(spark):
    ddl = "conv_id long, turn long, kind string, id string, after string, name string, body string"
    schema = {"f": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "maximum": 9}, "y": {"type": "array", "items": {"enum": ["a", "b"]}}}, "additionalProperties": False}}
    rows = [
        (1, 0, "call", "a", None, "f", '{"y":["a"],"x":1}'), (1, 1, "result", "a", None, None, "ok"), (1, 2, "call", "b", "a", "f", '{"x":10}'), (1, 3, "call", "c", "b", "f", '{"x":2,"z":1}'), (1, 4, "result", "q", None, None, "?"),
        (1, 5, "call", "d", None, "f", '{"x":1}'), (1, 6, "call", "d", None, "f", '{"x":true}'), (1, 7, "call", "e", "g", "g", "{}"), (1, 8, "call", "g", "e", "f", "no json"), (1, 9, "other", None, None, "user", None), (2, 0, "call", "a", "nowhere", "f", '{"x":1,"y":["c"]}'),
        (None, None, "call", None, None, "f", None),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in toolcalls.link(spark.createDataFrame(rows, ddl), schema).collect()}
    assert len(got) == len(rows)
    assert [(got[1, t]["status"], got[1, t]["position"]) for t in range(10)] == [("linked", 1), ("linked", 2), ("pending", 3), ("pending", 5), ("orphan", 0), ("ambiguous", 0), ("ambiguous", 0), ("pending", 0), ("pending", 0), ("message", 0)]
    assert [got[1, t]["valid"] for t in (0, 2, 3, 6, 7, 8)] == [True, False, False, False, False, False] and not got[2, 0]["valid"] and got[2, 0]["position"] == 1
    assert got[1, 0]["json"] == '{"arguments":{"x":1,"y":["a"]},"id":"a","name":"f","type":"call"}' and got[None, None]["status"] == "unidentified"
    assert toolcalls.report(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_long_chains_take_few_rounds(spark):
    rows = [(1, str(k), str(k - 1)) for k in range(200)]
    assert {r["id"]: r["depth"] for r in toolcalls.depths(spark.createDataFrame(rows, "conv_id long, id string, after string")).collect()} == {str(k): k + 1 for k in range(200)}


# 7 -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("which", ["docs", "real"])
def test_bpe(request, which):
    from tokenizers import Tokenizer

    frame = request.getfixturevalue(which)
    t = Tokenizer.from_file(bpe.default_path())
    want = []
    for r in frame.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.report(frame).collect()), key=str) == sorted(want, key=str)


def test_automaton_spells_exactly_the_tokenisations():
    """All words over two letters against merging by rank, one pair after the other."""
    import itertools

    merges = [("a", "a"), ("a", "b"), ("aa", "ab"), ("b", "a</w>"), ("aa", "aa"), ("b", "ba</w>"), ("ab", "b"), ("b", "b")]
    alphabet = bpe.byte_alphabet()
    vocab = {t: k for k, t in enumerate([*alphabet, *(c + "</w>" for c in alphabet), *(u + v for u, v in merges)])}
    machine = bpe.Automaton(vocab, merges)
    rank = {m: k for k, m in enumerate(merges)}
    for n in range(1, 11):
        for word in itertools.product("ab", repeat=n):
            parts = [*word[:-1], word[-1] + "</w>"]
            while (best := min((rank.get(p, math.inf) for p in itertools.pairwise(parts)), default=math.inf)) < math.inf:
                k = next(k for k, p in enumerate(itertools.pairwise(parts)) if rank.get(p) == best)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            assert machine.word("".join(word)) == [vocab[p] for p in parts]


# 8 -------------------------------------------------------------------------------------------


def classes_by_brute_force(rows, words, at_least=0.8):
    sets = [set(neardup.shingles(t, words).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 100 * at_least * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 60), 1 << 60 if d is None else d)
    return [(d, len(s), least[find(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def test_shingles():
    assert len(neardup.shingles("A b  a\tB c")) == 3 and len(neardup.shingles("x")) == 1 and not len(neardup.shingles(" \n")) and not len(neardup.shingles(None))
    assert (neardup.shingles("Ab C") == neardup.shingles("aB\x0bc")).all() and len(neardup.shingles("É a")) == 1 and (neardup.shingles("É a") != neardup.shingles("é a")).all()


@pytest.mark.parametrize("which", ["docs", "real", "chains"])
def test_near_duplicates(request, spark, which):
    if which == "chains":
        rng, rows = np.random.default_rng(3), []
        base = lorem(7, 120).split()
        for k in range(150):  # copies of copies: similar to their neighbours only
            base[rng.integers(len(base))] = f"w{k}"
            rows.append((k, " ".join(base)))
        frame = spark.createDataFrame(rows, "doc_id long, text string")
    else:
        frame = request.getfixturevalue(which)
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    got = neardup.near_duplicates(frame).collect()
    assert sorted((tuple(r)[:3] for r in got if r["doc_id"] is not None)) == sorted(x for x in classes_by_brute_force(rows, 2) if x[0] is not None)
    assert len(got) == len(rows) and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)


def test_large_nodes_branch_and_large_groups_are_cut(spark, monkeypatch):
    rows = []
    for k in range(120):
        words = lorem(9, 100).split()
        rng = np.random.default_rng(k)
        for _ in range(int(rng.integers(0, 9))):
            words[rng.integers(100)] = f"v{rng.integers(10**6)}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, lorem(9, 20) + " " + lorem(100 + k, 60)) for k in range(120)]
    monkeypatch.setattr(neardup, "SMALL", 20)
    monkeypatch.setattr(neardup, "PIECE", 20_000)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r)[:3] for r in neardup.near_duplicates(frame).collect()) == sorted(classes_by_brute_force(rows, 2))


def test_deduplicated(docs, empty):
    got = neardup.deduplicated(docs)
    assert got.columns == docs.columns and sorted(r["doc_id"] or 0 for r in got.collect()) == [0, 1, 2, 3, 4, 5, 8, 9, 10, 11, 12]
    assert neardup.deduplicated(empty).count() == 0 and neardup.near_duplicates(empty).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (103, 101), (103, 103), (None, 1)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == dict.fromkeys(range(41), 0) | {100: 100, 101: 100, 103: 100}


# 9 -------------------------------------------------------------------------------------------


def test_vectors(spark, monkeypatch):
    rng, rows = np.random.default_rng(5), []
    for g in range(12):
        centre = rng.normal(size=24)
        for _ in range(25):
            rows.append((len(rows), (centre + rng.normal(size=24) * rng.choice([0.02, 0.1, 0.2, 1.0])).tolist(), int(g % 3)))
    rows += [(1000 + k, rows[7][1], rows[7][2]) for k in range(30)] + [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 24, 1), (2003, [float("nan")] + [1.0] * 23, 1), (2004, [None] + [1.0] * 23, 1), (2005, rows[7][1], None), (2006, rows[7][1][:5], 1), (2007, [2 * x for x in rows[7][1]], rows[7][2])]
    good = [r for r in rows if r[0] < 2000 or r[0] in (2006, 2007)]
    unit = [np.array(r[1]) / np.linalg.norm(r[1]) for r in good]
    links = {r[0]: [s[0] for s, v in zip(good, unit, strict=True) if s[0] != r[0] and s[2] == r[2] and len(v) == len(u) and u @ v >= 0.98] for r, u in zip(good, unit, strict=True)}
    want = []
    for r in rows:
        seen, todo = {r[0]}, [r[0]]
        while todo:
            new = set(links.get(todo.pop(), ())) - seen
            seen |= new
            todo += new
        want.append((r[0], len(links.get(r[0], ())), min(seen), r[0] == min(seen)))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, vectors.near_duplicates(frame).collect())) == want
    monkeypatch.setattr(vectors, "BASES", 16)
    monkeypatch.setattr(vectors, "QUERIES", 16)
    monkeypatch.setattr(vectors, "WHOLE", 32)
    assert sorted(map(tuple, vectors.near_duplicates(frame).collect())) == want
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# 10 ------------------------------------------------------------------------------------------


def test_marginals_by_enumeration():
    import itertools

    rng = np.random.default_rng(2)
    chains, moves = [rng.normal(size=n) for n in (1, 4, 6, 0)], rng.normal(size=(2, 2))
    got, expected = toxicity.marginals(chains, moves)
    total = np.zeros((2, 2))
    for c, p in zip(chains, got, strict=True):
        weight, on, pairs = 0.0, np.zeros(len(c)), np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=len(c)):
            w = math.exp(sum(x for x, t in zip(c, tags, strict=True) if t) + sum(moves[a, b] for a, b in itertools.pairwise(tags)))
            weight += w
            on += w * np.array(tags)
            for a, b in itertools.pairwise(tags):
                pairs[a, b] += w
        assert np.allclose(on / weight, p)
        total += pairs / weight
    assert np.allclose(total, expected)


def test_marginals_over_many_spans():
    rng = np.random.default_rng(5)
    sizes = [0, 1, 63, 64, 65, 0, 128, 1000, 2, 129, 0]
    chains = [rng.normal(size=n) * 5 for n in sizes] + [np.full(70, 1000.0), np.full(70, -1000.0), np.where(np.arange(200) % 2, 1000.0, -1000.0)]
    for moves in (rng.normal(size=(2, 2)), np.array([[6.0, -6.0], [-6.0, 6.0]]), np.array([[-9.0, 9.0], [9.0, -9.0]])):
        got, expected = toxicity.marginals(chains, moves)
        total = np.zeros((2, 2))
        for c, p in zip(chains, got, strict=True):
            # Sums of logarithms, token by token.
            node = np.stack([np.zeros(len(c)), np.clip(c, -60, 60)], axis=1)
            before, after = node.copy(), np.zeros_like(node)
            for i in range(1, len(c)):
                before[i] += np.logaddexp.reduce(before[i - 1][:, None] + moves, axis=0)
            for i in range(len(c) - 2, -1, -1):
                after[i] = np.logaddexp.reduce(moves + node[i + 1] + after[i + 1], axis=1)
            both = before + after
            assert np.allclose(np.exp(both[:, 1] - np.logaddexp.reduce(both, axis=1)), p, atol=1e-12)
            if len(c) > 1:
                pairs = before[:-1, :, None] + moves + (node + after)[1:, None, :]
                total += np.exp(pairs - np.logaddexp.reduce(pairs, axis=(1, 2), keepdims=True)).sum(axis=0)
        assert np.allclose(total, expected)


def test_a_long_chain_costs_what_its_tokens_cost():
    import time

    rng, moves = np.random.default_rng(6), np.array([[0.5, -1.0], [-2.0, 1.0]])

    def seconds(chains):
        took = []
        for _ in range(3):
            start = time.process_time()
            toxicity.marginals(chains, moves)
            took.append(time.process_time() - start)
        return min(took)

    # As many tokens in one chain, and in 100; step by step the one takes 100 times as many steps.
    assert seconds([rng.normal(size=100_000)]) < 10 * max(0.01, seconds([rng.normal(size=1000) for _ in range(100)]))


def test_evidence_is_what_the_features_weigh():
    rng = np.random.default_rng(7)
    words = ["", "a", "abc", "abcd", "Abcde,", "abcdef", "abcdefg", "(w:x)", "p4:abcd", "...", "É" * 5, "x" * 100, "\u0130stanbul"]
    weights = {f: float(rng.normal()) for w in words for f in toxicity.features(toxicity.form(w))}
    field = toxicity.Field(weights, -0.5, np.zeros((2, 2)), np.zeros(4))
    tokens = [*words, "abcdxy", "zbcd", "unseen"]
    want = [-0.5 + sum(weights.get(f, 0.0) for f in toxicity.features(toxicity.form(w))) for w in tokens]
    assert np.allclose(field.evidence(tokens), want) and np.allclose(field.evidence(tokens), want)


def test_toxicity(spark, docs, empty):
    sf = SF.replace("0.001", "0.01")
    real, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.report(real, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() >= 0.9 and ((held.score >= 0.5) == held.predicted).all() and got.score.between(0, 1).all()
    assert toxicity.report(docs, labels).count() == docs.count() and toxicity.report(empty, labels).count() == 0
    assert {r["score"] for r in toxicity.report(docs, labels.where("false")).collect()} == {0.0}


def test_bpe_equals_the_library_whatever_the_version_of_unicode():
    import unicodedata

    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(bpe.default_path()), bpe.encoder(open(bpe.default_path(), encoding="utf-8").read())
    rng, points = np.random.default_rng(11), [c for c in (*range(0x30000), *range(0xE0000, 0xE0200)) if not 0xD800 <= c < 0xE000]
    marks = [chr(c) for c in points if unicodedata.category(chr(c))[0] == "M"]
    every = [f"a{chr(c)}b" for c in points] + [f"a{''.join(rng.choice(marks, 3))}b" for _ in range(3000)] + ["".join(map(chr, rng.choice(points, 30))) for _ in range(2000)]
    every += ["".join(map(chr, rng.integers(0, 256, 60))) for _ in range(2000)] + ["x" * 30_000, "ab" * 20_000 + "é", "\t" * 5000 + "ж", " <|endoftext|><|startoftext|>x", "<|endoftext|"]
    for text, want in zip(every, t.encode_batch(every, add_special_tokens=False), strict=True):
        code = e.encode(text)
        assert np.frombuffer(code, "<u4").tolist() == want.ids and e.decode(code) == t.decode(want.ids, skip_special_tokens=False), text


# Rows that once ended a job, were lost, or took too much memory --------------------------------


def test_slices_go_by_the_rows_own_bytes():
    import pyarrow as pa

    from statuta.llm import common

    batch = pa.record_batch({"text": ["x"] * 9990 + ["y" * (4 << 20)] * 10, "n": list(range(10_000)), "l": [[1, 2]] * 10_000, "none": [None] * 10_000})
    parts = list(common.slices(batch))
    assert sum(p.num_rows for p in parts) == 10_000 and pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert all(p.num_rows <= common.SLICE_ROWS and (p.num_rows == 1 or sum(map(len, p.column("text").to_pylist())) <= common.SLICE_BYTES) for p in parts)


def test_bodies_that_no_json_can_say():
    for body in ('{"x":NaN}', '{"x":1e999}', "[" * 100_000, '"\\ud800"', None, "", "{"):
        assert toolcalls.checked(body, "f", "a", {"f": {}}) == (False, '{"arguments":null,"id":"a","name":"f","type":"call"}')
    assert toolcalls.checked("9" * 401, "f", "a", {"f": {"type": "integer"}})[0]


def test_long_runs_of_blanks():
    e = tokencount.encoder(open(tokencount.default_path(), encoding="utf-8").read())
    for text in ("a" + " " * 5000 + "b", "\n" * 6000 + "é x", "x \t" + " " * 4096, " " * 4097 + "\n" + "y" * 10, "　" * 5000 + "12"):
        assert e.encode(text) == e.encoding.encode_ordinary(text)
    assert (spans := e.spans("a" + " " * 1_000_000 + "b"))[-1].tolist() == [1_000_000, 1_000_002] and (spans[1:, 0] == spans[:-1, 1]).all()


def test_one_long_chain_among_short_ones():
    import tracemalloc

    rng = np.random.default_rng(4)
    chains = [rng.normal(size=20) for _ in range(255)] + [rng.normal(size=100_000)]
    tracemalloc.start()
    got, _ = toxicity.marginals(chains, rng.normal(size=(2, 2)))
    assert tracemalloc.get_traced_memory()[1] < 200 << 20 and [len(c) for c in got] == [len(c) for c in chains]
    tracemalloc.stop()


def test_deduplicated_loses_no_text(spark):
    rows = [(7, lorem(1)), (7, lorem(2)), (None, lorem(3)), (None, lorem(3)), (None, lorem(2)), (8, lorem(1)), (9, None), (9, None), (6, lorem(4)), (6, lorem(4))]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, mark string, `row` string")
    got = neardup.deduplicated(frame)
    assert got.columns == frame.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted([(7, lorem(1)), (7, lorem(2)), (None, lorem(3)), (9, None), (9, None), (6, lorem(4))], key=str)


def test_language_stage_decides(spark, real):
    known = real.where("lang IS NOT NULL").limit(150).collect()
    junk = [(10_000 + k, f"{lorem(k, 1)} " * 400, "en", "s", 0) for k in range(3)] + [(20_000, "avec", "fr", "s", 4)]
    frame = spark.createDataFrame([tuple(r) for r in known] * 3 + junk, DDL)
    kept = {r["doc_id"] for r in langid.accepted(frame).collect()}
    assert not kept & {10_000, 10_001, 10_002} and 20_000 in kept and len(kept) > 140
    nothing = frame.withColumn("lang", F.lit(None).cast("string"))
    assert langid.accepted(nothing).count() == frame.count()
    filled = langid.accepted(frame.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))).collect()
    assert all(r["lang"] for r in filled)


def test_tool_calls_ignore_columns_of_any_name_and_repeated_turns(spark):
    rows = [(1, 0, "call", "a", None, "reply", '{"turn": 0, "prompt": "x"}'), (1, 1, "result", "a", None, "assistant", "y"), (1, 2, "call", "b", "a", "reply", '{"prompt": "", "turn": 2}'), (1, 2, "call", "c", "b", "nothing", "{}"), (1, 2, "call", "c", "b", "nothing", "{}")]
    plain = spark.createDataFrame(rows, "conv_id long, turn long, kind string, id string, after string, name string, body string")
    extra = plain.selectExpr("*", "1 AS calls", "2 AS results", "3 AS depth", "4 AS many", "5 AS status", "6 AS position", "7 AS valid", "8 AS json")
    got = sorted(map(tuple, toolcalls.link(extra, toolcalls.REPLY).collect()))
    assert got == sorted(map(tuple, toolcalls.link(plain, toolcalls.REPLY).collect()))
    assert [(r[2], r[3], r[4], r[5], r[6]) for r in got] == [
        ("call", "linked", 1, 1, True), ("result", "linked", 1, 2, True), ("call", "ambiguous", 0, 0, False), ("call", "ambiguous", 0, 0, False), ("call", "pending", 2, 3, False),
    ]
