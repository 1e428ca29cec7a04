"""Toxicity by a linear-chain conditional random field over tokens.

Labels are known per document only, so tokens of the learning documents are labelled first: a token
of a toxic document is toxic if its form, or a beginning of STEM letters or more, occurs in different
contexts (pairs of neighbouring words, so that copies of one document count once) of toxic
documents, at least CONTEXTS and one to every hundred such documents, and in next to none of clean ones.  The field has two tags;
a token's evidence is the sum of the weights of its form, beginnings and ending, and two
neighbouring tags have a weight.  It is trained by gradient ascent on its likelihood, whose
gradient forward-backward gives.

Forward-backward over the whole of every text yields each token's marginal probability of being
toxic.  A logistic curve over a text's expected number of toxic tokens, its largest marginal and
their share gives the score; tokens with a marginal of at least 0.5 are the offending offsets.

The field learns from a bounded sample: PER_CLASS documents of each label, the first by a hash of
doc_id among those of at most MAX_CHARS characters; one of FOLD parts of it is kept for the curve,
which weighs them by how many labelled documents of each class there are in all.  Scoring covers whole texts of any length.

Null and empty texts have no tokens and get the score of that.  Where no label of one class is
known every score is the share of toxic labels, or 0 without any.  Null labels are ignored; of
several labels for one doc_id the largest counts, of several texts the first.  Repeated rows are
scored one by one.  A very long text is worked on alone, in memory linear in its length.  Other
columns, whatever their names, are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import crc, cut, map_slices, texts

PER_CLASS = 1000
MAX_CHARS = 20_000
STEM = 4
CONTEXTS = 3
ROUNDS = 30
LEAST = 8
FOLD = 4
STEP = 0.5
RIDGE = 5.0
#: Tokens of a span; the spans of all chains are worked on side by side.
SPAN = 64
#: Padded cells that are worked on at once.
CELLS = 1 << 18
CACHED = 300_000
_EDGES = " \t\n\r.,;:!?|\"'()[]{}<>#$%&*-_=+/\\"


def form(token: str) -> str:
    return token.strip(_EDGES).lower()


def features(word: str) -> list[str]:
    """What the field sees of a token."""
    if not word:
        return []
    return [f"w:{word}", *(f"p{n}:{word[:n]}" for n in range(STEM, 7) if len(word) >= n), f"s:{word[-4:]}"]


def _stems(word: str) -> list[str]:
    return [f"w:{word}", *(f"p{n}:{word[:n]}" for n in range(STEM, 7) if len(word) > n)]


def label_tokens(docs: list[list[str]], toxic: list[int]) -> list[np.ndarray]:
    """Tags of the tokens of labelled documents."""
    vocab: dict[str, int] = {"": 0}
    flat = [np.array([vocab.setdefault(w, len(vocab)) for w in words], np.int64) for words in docs]
    size = len(vocab)
    # Which stems a word has, a row for each kind of stem.
    names: dict[str, int] = {}
    stems = np.full((4, size), -1, np.int64)
    for w, k in vocab.items():
        for row, f in enumerate(_stems(w) if w else ()):
            stems[row, k] = names.setdefault(f, len(names))
    contexts = np.zeros((2, len(names)), np.int64)
    for t in (0, 1):
        mine = [f for f, y in zip(flat, toxic, strict=True) if y == t]
        word = np.concatenate([*mine, np.zeros(0, np.int64)])
        around = np.concatenate([*(np.concatenate([[0], f[:-1]]) * size + np.concatenate([f[1:], [0]]) for f in mine if len(f)), np.zeros(0, np.int64)])
        for row in stems:
            stem = row[word]
            contexts[t] += np.bincount(np.unique(np.stack([stem, around])[:, stem >= 0], axis=1)[0], minlength=len(names))
    bad = (contexts[1] >= max(CONTEXTS, sum(toxic) / 100)) & (contexts[1] > 50 * contexts[0])
    known = np.append(bad, False)[stems].any(axis=0)
    return [known[f].astype(np.int8) if t else np.zeros(len(f), np.int8) for f, t in zip(flat, toxic, strict=True)]


def _groups(lengths: list[int]) -> list[list[int]]:
    """Chains in groups of at most CELLS cells with padding; a longer chain is one alone."""
    out: list[list[int]] = []
    held = CELLS
    for k, n in enumerate(lengths):
        cells = max(1, -(-n // SPAN)) * SPAN
        if held + cells > CELLS:
            out.append([])
            held = 0
        out[-1].append(k)
        held += cells
    return out


def _messages(evidence: np.ndarray, lengths: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Odds of tag 1 at each token of chains that stand end to end, given what stands up to there.

    A token turns odds r into e * (t01 + r * t11) / (t00 + r * t10), so a span of tokens is a 2 x 2
    matrix up to a factor: the odds of each row, and how its rows compare in column 0.  Matrices of all
    spans grow token by token side by side, then the odds that enter each span follow from the span before.
    """
    spans = -(-lengths // SPAN)
    first = np.cumsum(spans) - spans
    cell = np.arange(len(evidence)) + np.repeat(first * SPAN - np.cumsum(lengths) + lengths, lengths)
    n = int(spans.sum())
    e = np.ones(n * SPAN)
    e[cell] = evidence
    e = np.ascontiguousarray(e.reshape(n, SPAN).T)
    rows, ratio = np.empty((SPAN, 2, n)), np.empty((SPAN, n))
    rows[0] = e[0] * np.array([[t[0, 1] / t[0, 0]], [t[1, 1] / t[1, 0]]])
    ratio[0] = t[1, 0] / t[0, 0]
    heads = np.zeros(n, bool)  # spans that nothing enters
    heads[first[lengths > 0]] = True
    rows[0][:, heads], ratio[0, heads] = e[0, heads], 1.0
    for i in range(1, SPAN):
        r = rows[i - 1]
        below = t[0, 0] + r * t[1, 0]
        rows[i] = e[i] * (t[0, 1] + r * t[1, 1]) / below
        ratio[i] = ratio[i - 1] * (below[1] / below[0])
    enter, r = [], 0.0
    for head, a, b, w in zip(heads.tolist(), *rows[-1].tolist(), ratio[-1].tolist(), strict=True):
        r = 0.0 if head else r
        enter.append(r)
        r = (a + r * w * b) / (1 + r * w)
    ratio *= np.array(enter)
    return ((rows[:, 0] + ratio * rows[:, 1]) / (1 + ratio)).T.ravel()[cell]


def marginals(chains: list[np.ndarray], moves: np.ndarray, count: bool = True) -> tuple[list[np.ndarray], np.ndarray]:
    """Probabilities of tag 1 along chains with the given evidence, and expected numbers of moves (2, 2) if they are to be counted.

    Forward and backward messages are kept as odds of tag 1, so they need no scaling.
    """
    t = np.exp(moves)
    out: list[np.ndarray] = []
    expected = np.zeros((2, 2))
    for group in _groups([len(c) for c in chains]):
        lengths = np.array([len(chains[k]) for k in group])
        ends = np.cumsum(lengths)
        evidence = np.exp(np.clip(np.concatenate([chains[k] for k in group]), -60, 60))
        before = _messages(evidence, lengths, t)
        after = _messages(evidence[::-1], lengths[::-1], t.T)[::-1]  # odds given what stands from here on
        odds = before * after / evidence
        out += np.split(odds / (1 + odds), ends[:-1])
        if count:
            inside = np.ones(len(evidence), bool)
            inside[ends[lengths > 0] - 1] = False  # nothing follows a chain's end
            at = np.flatnonzero(inside)
            x, y = before[at], after[at + 1]
            both = [np.full(len(at), t[0, 0]), t[0, 1] * y, t[1, 0] * x, t[1, 1] * x * y]
            total = sum(both)
            expected += np.array([(b / total).sum() for b in both]).reshape(2, 2)
    return out, expected


class _Evidence(dict):
    """Evidence by token, worked out where it is missing: the bias and the weights of what features() names."""

    def __init__(self, weights: dict[str, float], bias: float):
        super().__init__()
        kinds: dict[str, dict[str, float]] = defaultdict(dict)
        for f, x in weights.items():
            kind, _, part = f.partition(":")
            kinds[kind][part] = x
        self.bias, self.words, self.ends = bias, kinds["w"], kinds["s"]
        self.stems = [(n, kinds[f"p{n}"]) for n in range(STEM, 7)]

    def __missing__(self, token: str) -> float:
        word = form(token)
        out = self.bias
        if word:
            out += self.words.get(word, 0.0) + self.ends.get(word[-4:], 0.0)
            for n, stems in self.stems:
                if len(word) < n:
                    break
                out += stems.get(word[:n], 0.0)
        if len(self) > CACHED:
            self.clear()
        if len(token) < 64:
            self[token] = out
        return out


class Field:
    def __init__(self, weights: dict[str, float], bias: float, moves: np.ndarray, curve: np.ndarray):
        self.weights, self.bias, self.moves, self.curve = weights, bias, moves, curve
        self.cache: _Evidence | None = None

    def evidence(self, tokens: list[str]) -> np.ndarray:
        if self.cache is None:
            self.cache = _Evidence(self.weights, self.bias)
        return np.fromiter(map(self.cache.__getitem__, tokens), float, len(tokens))

    def tag(self, batch: list[str]) -> list[np.ndarray]:
        """Marginals of the white-space separated tokens of texts."""
        return marginals([self.evidence(t.split()) for t in batch], self.moves, count=False)[0]

    def score(self, batch: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summaries(self.tag(batch)) @ self.curve, -40, 40)))


def summaries(chains: list[np.ndarray]) -> np.ndarray:
    total = np.array([c.sum() for c in chains])
    most = np.array([c.max() if len(c) else 0.0 for c in chains])
    share = total / np.maximum([len(c) for c in chains], 1)
    return np.stack([np.ones(len(chains)), np.log1p(total), most, np.sqrt(share)], axis=1)


def _field(docs: list[str], toxic: list[int]) -> Field:
    tokens = [[form(w) for w in t.split()] for t in docs]
    tags = label_tokens(tokens, toxic)
    names: dict[str, int] = {}
    of_word: dict[str, np.ndarray] = {}
    freq: dict[str, int] = defaultdict(int)
    for words in tokens:
        for w in words:
            freq[w] += 1
    often: dict[str, int] = defaultdict(int)
    for w, n in freq.items():
        for f in features(w):
            often[f] += n
    for w in freq:
        of_word[w] = np.array([names.setdefault(f, len(names)) for f in features(w) if often[f] >= LEAST], np.int64)
    vocab = {w: k for k, w in enumerate(of_word)}
    flat = np.array([vocab[w] for words in tokens for w in words], np.int64)
    tag = np.concatenate([*tags, np.zeros(0, np.int8)]).astype(float)
    sizes = [len(x) for x in tokens]
    cuts = np.cumsum(sizes)[:-1]
    rows = np.repeat(np.arange(len(of_word)), [len(x) for x in of_word.values()])
    cols = np.concatenate([*of_word.values(), np.zeros(0, np.int64)])
    seen = np.zeros((2, 2))
    for x in tags:
        np.add.at(seen, (x[:-1], x[1:]), 1)
    w, bias, moves = np.zeros(len(names)), -3.0, np.zeros((2, 2))
    past, past_moves, past_bias = np.full(len(names), 1e-2), np.full((2, 2), 1e-2), 1e-2
    truth = np.bincount(flat, weights=tag, minlength=len(of_word))
    for _ in range(ROUNDS):
        by_word = bias + np.bincount(rows, weights=w[cols], minlength=len(of_word))
        p, expected = marginals(np.split(by_word[flat], cuts), moves)
        miss = truth - np.bincount(flat, weights=np.concatenate(p), minlength=len(of_word))
        slope = np.bincount(cols, weights=miss[rows], minlength=len(names)) - RIDGE * w
        past += slope**2
        w += STEP * slope / np.sqrt(past)
        turn = seen - expected
        past_moves += turn**2
        moves += 0.1 * turn / np.sqrt(past_moves)
        past_bias += miss.sum() ** 2
        bias += 0.1 * miss.sum() / np.sqrt(past_bias)
    kept = {f: float(w[k]) for f, k in names.items() if abs(w[k]) > 1e-3}
    return Field(kept, float(bias), moves, np.zeros(4))


def train(docs: list[str], toxic: list[int], counts: dict[int, int]) -> Field:
    """The field from three of FOLD parts of the sample, the curve from the part that it has not seen."""
    own = [k for k in range(len(docs)) if k % FOLD or len(docs) < 10 * FOLD]
    rest = [k for k in range(len(docs)) if k % FOLD == 0] if len(own) < len(docs) else own
    field = _field([docs[k] for k in own], [toxic[k] for k in own])
    x = summaries(field.tag([docs[k] for k in rest]))
    y = np.array([toxic[k] for k in rest], float)
    have = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.array([counts[int(c)] / have[int(c)] for c in y])
    field.curve = _curve(x, y, weight / weight.mean())
    field.cache = None
    return field


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton's method, slightly shrunk."""
    c = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -40, 40)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(c))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - 1e-2 * c)
        c = c + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return c


def learn(docs: DataFrame, labels: DataFrame, usable: Column) -> Field | float:
    """The field, or a constant score where labels of one class are missing."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(usable & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length("text").alias("size")).where(F.col("size") <= MAX_CHARS)
    pool = cut(known.join(short, "doc_id"))
    counts = {0: 0, 1: 0} | {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    if not counts[0] or not counts[1]:
        return counts[1] / max(1, counts[0] + counts[1])
    picks = [pool.where(F.col("toxic") == c).select("doc_id", "toxic").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS) for c in (0, 1)]
    ids = picks[0].unionByName(picks[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") <= MAX_CHARS).join(F.broadcast(ids), "doc_id")  # 2 * PER_CLASS rows
    # Of rows with one doc_id the first text counts, so that at most 2 * PER_CLASS rows reach the driver.
    sample = sorted(tuple(r) for r in rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).select("doc_id", "text", "toxic").collect())
    if len({t for _, _, t in sample}) < 2:
        return counts[1] / (counts[0] + counts[1])
    return train([t for _, t, _ in sample], [y for _, _, y in sample], counts)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted, with the number and places of offending tokens."""
    held_out = crc(F.col("doc_id")) % 5 == 0
    field = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, ~held_out))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def step(batch):
        batch_texts = texts(batch.column("text"))
        if isinstance(field.value, float):
            scores, chains = np.full(len(batch_texts), field.value), [np.zeros(0)] * len(batch_texts)
        else:
            chains = field.value.tag(batch_texts)
            scores = 1 / (1 + np.exp(-np.clip(summaries(chains) @ field.value.curve, -40, 40)))
        return {
            "doc_id": batch.column("doc_id"),
            "score": scores,
            "predicted": (scores >= 0.5).astype(np.int32),
            "offsets": [offsets(t, c) for t, c in zip(batch_texts, chains, strict=True)],
        }

    scored = map_slices(rows, "doc_id long, score double, predicted int, offsets string", step)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "offsets")


_TOKEN = re.compile(r"\S+")


def offsets(text: str, chain: np.ndarray) -> str:
    """start:end of the offending tokens, comma-joined; code points, end exclusive."""
    bad = set(np.flatnonzero(chain >= 0.5).tolist())
    if not bad:
        return ""
    return ",".join(f"{m.start()}:{m.end()}" for i, m in enumerate(_TOKEN.finditer(text)) if i in bad)
