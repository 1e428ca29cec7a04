"""Language identification with hyperdimensional profiles.

Every character of a word has a random vector of DIM signs, drawn from its code point.  The vector
of an n-gram is the product of its characters' vectors, each rotated by its distance from the end
(binding by permutation), and a text is the sum of its n-grams' vectors (bundling).  A language's
prototype is the mean over all its learning documents of the sum divided by the number of
n-grams; what all prototypes have in common is taken off them and off the documents.  A text gets the language whose
prototype has the largest cosine with its vector; ties go to the language first by code point.

Texts are lower-cased; runs of characters that are no letters become one space, also at both ends.
Null texts and texts without a letter are ``und`` with score 0, as is every text where nothing was
learned.  Null languages are not learned from.  Rows are independent, so repeated rows and extra
columns, whatever their names, do not matter.  A very long text is worked on alone, in memory
linear in its length.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from statuta.llm.common import Shelf, arrow_schema, crc, give_back, slices, texts

DIM = 1024
N = 3
UNKNOWN = "und"
SEED = 20_240_601
DENSE = 1 << 18
COLUMNS = 2048
#: Languages whose vectors a task, the driver or a broadcast holds at once; texts meet further ones in further passes.
LANGUAGES = 1000
#: Of the expected cosine; a text with less is in no learned language.
SHARE = 0.4
TELLING = 0.6
LEAST = 30


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=10_000)
def _signs(code: int) -> np.ndarray:
    return np.random.default_rng((SEED, code)).integers(0, 2, DIM, dtype=np.int8) * np.int8(2) - np.int8(1)


def _normal(text: str) -> np.ndarray:
    """Code points of the lower-cased text, other characters than letters as single spaces (0)."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, 0)
    codes = np.concatenate([[0], codes, [0]])
    return codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]


def _grams(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of a batch of texts as code points (G, N); the text and the gram of each occurrence."""
    normal = [_normal(t) for t in batch]
    sizes = np.array([max(0, len(x) - N + 1) for x in normal], np.int64)
    # No n-gram spans two texts: positions where it would are left out.
    joined = np.concatenate([*normal, np.zeros(0, np.int64)]).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum([len(x) for x in normal])[:-1]]) if normal else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(batch)), sizes)
    first = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begins, sizes)
    alphabet = np.unique(joined)
    small = np.searchsorted(alphabet, joined)
    code = np.zeros(len(first), np.int64)
    for k in range(N):
        code = code * len(alphabet) + small[first + k]
    if len(alphabet) ** N <= DENSE:
        found = np.flatnonzero(np.bincount(code, minlength=1))
        place = np.zeros(len(alphabet) ** N, np.int64)
        place[found] = np.arange(len(found))
        gram = place[code]
    else:
        found, gram = np.unique(code, return_inverse=True)
    letters = np.stack([alphabet[found // len(alphabet) ** (N - 1 - k) % len(alphabet)] for k in range(N)], axis=1) if len(found) else np.zeros((0, N), np.int64)
    return letters, text, gram


def _vectors(letters: np.ndarray) -> np.ndarray:
    """Bound vectors (G, DIM) of n-grams."""
    used, at = np.unique(letters, return_inverse=True)
    signs = np.stack([_signs(int(c)) for c in used])
    out = np.ones((len(letters), DIM), np.int8)
    for k in range(N):
        out *= np.roll(signs, N - 1 - k, axis=1)[at.reshape(letters.shape)[:, k]]
    return out.astype(np.float32)


def bundles(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The vectors (B, DIM) of texts, and their numbers of n-grams."""
    letters, text, gram = _grams(batch)
    out = np.zeros((len(batch), DIM), np.float32)
    for at in range(0, len(letters), COLUMNS):
        width = min(COLUMNS, len(letters) - at)
        here = (gram >= at) & (gram < at + width)
        counts = np.bincount(text[here] * width + gram[here] - at, minlength=len(batch) * width).reshape(len(batch), width)
        out += counts.astype(np.float32) @ _vectors(letters[at : at + width])
    return out, np.bincount(text, minlength=len(batch))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Learned:
    """What was learned: a table of lang, n (documents that taught it) and vector (the sum of their mean n-grams).

    ``blocks`` gives the prototypes out by code point, at most LANGUAGES at a time, so neither the
    driver nor a broadcast holds those of any number of languages.
    """

    def __init__(self, found: DataFrame):
        self.found = found
        self.count = found.count()
        self.cuts = [r["lang"] for i, r in enumerate(found.select("lang").sort("lang").toLocalIterator()) if i % LANGUAGES == 0] if self.count > LANGUAGES else []
        self.mean = self._mean()

    def _mean(self) -> np.ndarray:
        """The mean of the prototypes' directions, in whole numbers, so that it doesn't depend on the order of tasks."""
        if self.count < 2:
            return np.zeros(DIM)

        def units(batches):
            for batch in batches:
                rows = np.array(batch.column("vector").to_pylist(), float).reshape(batch.num_rows, DIM)
                rows /= np.maximum(1e-9, np.linalg.norm(rows, axis=1, keepdims=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(DIM, dtype=np.int32), len(rows))), pa.array(np.rint(rows * 2**40).astype(np.int64).ravel())], names=["axis", "value"])

        sums = self.found.select("vector").mapInArrow(units, "axis int, value long").groupBy("axis").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(DIM)
        for axis, value in sums:
            out[axis] = value / 2**40 / self.count
        return out

    def blocks(self) -> Iterator[Profiles]:
        bounds = [*self.cuts, None] if self.cuts else [None, None]
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            rows = self.found if low is None else self.found.where(F.col("lang") >= low)
            rows = (rows if high is None else rows.where(F.col("lang") < high)).collect()
            yield Profiles({r["lang"]: np.array(r["vector"], float) / 2**20 / r["n"] for r in rows}, {r["lang"]: r["n"] for r in rows}, self.mean)


def learn(docs: DataFrame, usable: Column | None = None) -> Learned:
    """Prototypes by language, the mean n-gram vector over all usable rows with text and language.

    Tasks add up their own documents, for LANGUAGES languages at once.
    """
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = (rows.where(usable) if usable is not None else rows).select("text", "lang")

    def sums(batches):
        total: dict[str, np.ndarray] = {}
        taught: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            langs = list(total)
            out = pa.RecordBatch.from_arrays([
                pa.array(np.repeat(np.array(langs, object), DIM + 1), pa.string()),
                pa.array(np.tile(np.arange(DIM + 1, dtype=np.int32), len(langs))),
                pa.array(np.concatenate([np.append(total[x], taught[x]) for x in langs] or [np.zeros(0, np.int64)]), pa.int64()),
            ], names=["lang", "axis", "value"])
            total.clear()
            taught.clear()
            return out

        for batch in batches:
            for part in slices(batch):
                vectors, n = bundles(texts(part.column("text")))
                unit = vectors / np.maximum(n, 1)[:, None]
                langs = np.array(part.column("lang").to_pylist(), object)
                for lang in set(langs):
                    # Whole numbers, so that sums do not depend on the order of tasks.
                    add = np.rint(unit[langs == lang].astype(np.float64) * 2**20).sum(axis=0).astype(np.int64)
                    total[lang] = total.get(lang, 0) + add
                    taught[lang] = taught.get(lang, 0) + int((langs == lang).sum())
                if len(total) > LANGUAGES:
                    yield flush()
        give_back()
        yield flush()

    sums_ = rows.mapInArrow(sums, "lang string, axis int, value long").groupBy("lang", "axis").agg(F.sum("value").alias("value"))
    # One row a language: DIM sums in order, and the number of documents behind them.
    values = F.transform(F.array_sort(F.collect_list(F.struct("axis", "value"))), lambda x: x["value"])
    found = sums_.groupBy("lang").agg(values.alias("v")).select("lang", F.element_at("v", DIM + 1).alias("n"), F.slice("v", 1, DIM).alias("vector"))
    return Learned(Shelf(docs.sparkSession, "languages").put(found, "found"))


class Profiles:
    """Prototypes made ready for comparison."""

    def __init__(self, prototypes: dict[str, np.ndarray], taught: dict[str, int], mean: np.ndarray):
        self.names = sorted(prototypes)
        self.sure = np.array([taught[x] >= LEAST for x in self.names])
        unit = {x: prototypes[x] / max(1e-9, float(np.linalg.norm(prototypes[x]))) for x in self.names}
        self.mean = mean
        own = np.array([unit[x] - self.mean for x in self.names]).reshape(len(self.names), DIM)
        size = np.linalg.norm(own, axis=1, keepdims=True)
        self.own = own / np.maximum(size, 1e-9)
        # What is a language's own in its mean n-gram, squared.
        self.strength = np.array([float((prototypes[x] @ o) ** 2) for x, o in zip(self.names, self.own, strict=True)])

    def cosines(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cosines with each language (texts, languages), and the texts' numbers of n-grams."""
        vectors, n = bundles(batch)
        unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        # What all languages share is taken off the text as far as the text has it.
        common = float(self.mean @ self.mean)
        if common > 0:
            unit = unit - (unit @ self.mean / common)[:, None] * self.mean
            unit = unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)
        return unit @ self.own.T, n

    def expected(self, n: np.ndarray, language: np.ndarray) -> np.ndarray:
        """The cosine with its language that a text of n n-grams, drawn from the language one by one, has.

        Its vector is n times the language's mean n-gram and n random parts of squared length DIM.
        """
        signal = n * self.strength[language]
        return np.sqrt(signal / (signal + DIM))

    def judge(self, batch: list[str]) -> list[tuple[str, float, bool]]:
        """The language of each text among these, its cosine, and whether the text is too unlike it.

        That is so if its cosine is below SHARE of what its language and length let expect, unless
        that is below TELLING, the text being too short to tell, or fewer than LEAST documents have
        taught the language.
        """
        cosines, n = self.cosines(batch)
        best = cosines.argmax(axis=1)
        top, wanted = cosines[np.arange(len(batch)), best], self.expected(n, best)
        bad = self.sure[best] & (wanted >= TELLING) & (top < SHARE * wanted)
        return [(self.names[b], float(c), bool(x)) for b, c, x in zip(best, top, bad, strict=True)]


_JUDGED = "struct<lang: string, cosine: double, bad: boolean>"


def judged(docs: DataFrame, learned: Learned, name: str, whole: bool = True) -> DataFrame:
    """docs with a struct column called name: the best language of every row with a letter, its cosine, and whether the row is too unlike it.

    The struct is null where there is no letter.  Each block of languages is a pass over the texts,
    and stands in where its cosine is larger, so ties go to the language first by code point.  Without
    whole, the text is left out of the result.
    """
    kind = arrow_schema(f"x {_JUDGED}")[0].type
    rest = [c for c in docs.columns if whole or c != "text"]

    def over(profiles, first: bool, keep: list[str]):
        def run(batches):
            for batch in batches:
                for part in slices(batch):
                    held = texts(part.column("text"))
                    now = [x if has_letter(t) else None for t, x in zip(held, profiles.value.judge(held), strict=True)]
                    if not first:
                        now = [x if x is None or x[1] > old["cosine"] else tuple(old.values()) for x, old in zip(now, part.column(name).to_pylist(), strict=True)]
                    found = pa.array([x and dict(zip(("lang", "cosine", "bad"), x, strict=True)) for x in now], kind)
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), found], names=[*keep, name])
            give_back()

        return run

    blocks = -(-learned.count // LANGUAGES)
    for i, block in enumerate(learned.blocks()):
        keep = rest if i == blocks - 1 else list(dict.fromkeys([*rest, "text"]))
        schema = StructType([docs.schema[c] for c in keep]).add(name, StructType.fromDDL(f"x {_JUDGED}")["x"].dataType)
        source = docs.select(*dict.fromkeys([*rest, "text"])) if i == 0 else out
        out = source.mapInArrow(over(docs.sparkSession.sparkContext.broadcast(block), i == 0, keep), schema)  # LANGUAGES times DIM numbers at most
    return out


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; learned from the rows that are not held out."""
    held_out = crc(F.col("doc_id")) % 4 == 2
    learned = learn(docs, ~held_out)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    if not learned.count:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    score = F.coalesce(F.least(F.greatest("found.cosine", F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    return judged(rows, learned, "found", whole=False).select("doc_id", "held_out", F.coalesce("found.lang", F.lit(UNKNOWN)).alias("lang_pred"), score.alias("score"))


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that are in a language of the corpus, with their columns; a null lang is filled in.

    Texts without a letter go, and those that ``Profiles.judge`` finds too unlike their language.
    Where nothing could be learned, as no row has a text with a language, all rows stay as they are.
    """
    learned = learn(docs)
    if not learned.count:
        return docs
    name = "judged"
    while name in docs.columns:
        name += "_"
    kept = judged(docs, learned, name).where(F.col(name).isNotNull() & ~F.col(f"{name}.bad"))
    return kept.select(*(F.coalesce("lang", f"{name}.lang").alias("lang") if c == "lang" else F.col(c) for c in docs.columns))
