"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps, for two bases modulo 2**31 - 1, the sums of code point times power for every
prefix of a text.  Any span's hash is then two look-ups, a difference and a shift by an inverse
power, so spans of any two texts can be compared in constant time and the longest common extension
from two positions is found by binary search.

A text's fingerprint is its length, the hash of the whole span, and the SKETCH smallest mixed
hashes among its spans of SPAN code points (shorter texts: the one span that they are).  Equal
texts have equal fingerprints.  ``likeness`` estimates from two fingerprints the share of common
spans (Jaccard): 1 for equal ones, exact while the sketches hold all spans.

Null text counts as empty; two empty texts have likeness 1, an empty and another 0.

The next document is the next row by ascending doc_id (null first, ties by text, null first),
after the last the first.  Rows are dealt to ranges of doc_id, the head of each range goes to the
range before it as well, and each range is read through in order, one row at a time; so texts are
shuffled once and a task holds two of them.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import arrow_schema, map_slices, parts, slices, texts

P = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
SPAN = 16
SKETCH = 64
PIECE = 1 << 16
BLOCKS_PER_PART = 4

_M, _S = np.uint64(P), np.uint64(31)


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1, for x below 2**63."""
    x = (x & _M) + (x >> _S)
    x = (x & _M) + (x >> _S)
    return np.where(x >= _M, x - _M, x)


class _Powers:
    """Powers of the bases and of their inverses, extended as longer texts come."""

    def __init__(self):
        self.up = [np.ones(1, np.uint64) for _ in BASES]
        self.down = [np.ones(1, np.uint64) for _ in BASES]

    def upto(self, n: int) -> None:
        while len(self.up[0]) <= n:
            k = len(self.up[0])
            for table, bases in ((self.up, BASES), (self.down, [pow(b, P - 2, P) for b in BASES])):
                for i, b in enumerate(bases):
                    table[i] = np.concatenate([table[i], _mod(table[i] * np.uint64(pow(b, k, P)))])


_POWERS = _Powers()


class PrefixHash:
    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        _POWERS.upto(self.n)
        self.sums = []
        for up in _POWERS.up:
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(_mod(codes * up[: self.n]), out=sums[1:])
            self.sums.append(_mod(sums))

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The hash of a span, the same wherever the span stands."""
        return tuple((int(s[end]) - int(s[start])) % P * int(d[start]) % P for s, d in zip(self.sums, _POWERS.down, strict=True))

    def spans(self, width: int) -> np.ndarray:
        """The hashes of all spans of a width, as 62-bit numbers."""
        m = self.n - width + 1
        a, b = (_mod((s[width:] + _M - s[:m]) * d[:m]) for s, d in zip(self.sums, _POWERS.down, strict=True))
        return a << _S | b

    def common(self, at: int, other: PrefixHash, other_at: int) -> int:
        """The longest common extension from two positions."""
        low, high = 0, min(self.n - at, other.n - other_at)
        while low < high:
            k = (low + high + 1) // 2
            if self.span(at, at + k) == other.span(other_at, other_at + k):
                low = k
            else:
                high = k - 1
        return low


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(32)


def sketch(hashed: PrefixHash) -> np.ndarray:
    """The SKETCH smallest distinct mixed span hashes, ascending."""
    if not hashed.n:
        return np.zeros(0, np.uint64)
    x = _mixed(hashed.spans(min(SPAN, hashed.n)))
    if len(x) > 8 * SKETCH:
        # Spans are hashed evenly, so those under this bound are enough unless many repeat.
        few = np.unique(x[x < np.uint64((1 << 32) // len(x) * 4 * SKETCH)])
        if len(few) >= SKETCH:
            return few[:SKETCH]
    return np.unique(x)[:SKETCH]


def fingerprint(hashed: PrefixHash) -> str:
    whole = hashed.span(0, hashed.n)
    return f"{hashed.n:x}-{whole[0]:08x}{whole[1]:08x}-{sketch(hashed).astype('>u4').tobytes().hex()}"


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f.rpartition("-")[2]), ">u4") for f in (a, b))
    if not len(x) or not len(y):
        return 0.0
    both = np.union1d(x, y)
    # A sketch with fewer than SKETCH values is whole; otherwise only values that both could show count.
    if len(x) == SKETCH or len(y) == SKETCH:
        both = both[:SKETCH]
    return float(np.isin(both, np.intersect1d(x, y)).sum() / len(both))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the first code points, as many, of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long"


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every document, without its neighbours."""
    def step(batch):
        hashed = [PrefixHash(t) for t in texts(batch.column("text"))]
        return {"doc_id": batch.column("doc_id"), "n_chars": [h.n for h in hashed], "fingerprint": [fingerprint(h) for h in hashed]}

    return map_slices(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id long, n_chars long, fingerprint string", step)


def _ranges(docs: DataFrame) -> DataFrame:
    """Rows with the range (column at) whose neighbours they need; extra: only as the follower of its last."""
    from pyspark.ml.feature import Bucketizer

    n = BLOCKS_PER_PART * parts(docs.sparkSession)
    bounds = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    bounds = sorted({float(x) for x in bounds})
    split = Bucketizer(splits=[-float("inf"), *bounds, float("inf")] if bounds else [-float("inf"), 0.0, float("inf")], inputCol="key", outputCol="bucket")
    keyed = split.transform(docs.withColumn("key", F.coalesce(F.col("doc_id").cast("double"), F.lit(-float("inf"))))).withColumn("at", F.col("bucket").cast("int"))
    # One row per range; their number is that of the bounds.
    heads = sorted(keyed.groupBy("at").agg(F.min("key").alias("key")).collect())
    before = [0] * (len(bounds) + 2)
    for (a, _), (b, _) in zip([heads[-1], *heads], heads, strict=False):
        before[b] = a
    is_head = F.col("key").isin([k for _, k in heads])
    own = F.struct(F.col("at"), F.lit(False).alias("extra"))
    also = F.struct(F.element_at(F.array(*map(F.lit, before)), F.col("at") + 1).alias("at"), F.lit(True).alias("extra"))
    return keyed.select("doc_id", "text", F.explode(F.when(is_head, F.array(own, also)).otherwise(F.array(own))).alias("to")).select("doc_id", "text", "to.at", "to.extra")


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are; see SCHEMA."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], SCHEMA)
    ordered = _ranges(docs).repartition(F.col("at")).sortWithinPartitions("at", "extra", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())

    schema = arrow_schema(SCHEMA)

    def run(batches):
        last = None  # range, doc_id, text, hashed, fingerprint of the row that still needs its follower
        for batch in (part for whole in batches for part in slices(whole)):
            out = []
            for doc_id, text, at, extra in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "at", "extra")), strict=True):
                text = text or ""
                if last is not None and last[0] != at:
                    last = None
                if extra and last is None:
                    continue  # of several extra rows the first has served
                hashed = PrefixHash(text)
                mark = fingerprint(hashed)
                if last is not None:
                    _, last_id, last_text, last_hashed, last_mark = last
                    new = edited(last_text, text)
                    new_hashed = PrefixHash(new)
                    new_mark = fingerprint(new_hashed)
                    out.append((last_id, last_hashed.n, sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), last_mark, new_mark, likeness(last_mark, new_mark), likeness(last_mark, mark), last_hashed.common(0, new_hashed, 0)))
                last = None if extra else (at, doc_id, text, hashed, mark)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * len(schema), schema, strict=True)], schema=schema)

    return ordered.mapInArrow(run, SCHEMA)
