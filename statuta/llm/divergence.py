"""Source divergence audit: which sources of a language use which words unlike the language as a whole.

Texts are read once: each task counts its terms per language and source (occurrences, and documents
that hold them), and writes the counts.  A count-min sketch of the document frequencies, which
Spark's own aggregate merges from all tasks, part by part, then tells an upper bound of every term's frequency in
its language; terms whose bound is too low can't be kept and go before anything is shuffled.  The
others are counted exactly, so what the sketch lets through by mistake goes there.  The sketch has
a fixed size: on a corpus that fills it more terms pass, and the result stays the same.

A term's share in a group is smoothed, so terms that a group lacks have one and the same share
there.  The divergence of two sources is therefore the sum over each one's own terms against the
other's smallest share, and a correction for the terms that both hold.  The first needs a histogram
of counts per source, the second a join by term, summed up before it is shuffled; no term is ever
written down for a source that lacks it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from statuta.llm.common import Shelf, arrow_schema, give_back, slices

#: Documents of a language that must hold a term; terms listed per group; parts that a share is counted in.
LEAST = 3
TOP = 200
SCALE = 1_000_000_000
#: Of the sketch: the relative error, and the confidence. They make 4 rows of 2**18 counters, in so many parts by key.
ERROR = 2 / (1 << 18)
CONFIDENCE = 0.93
SHARES = 64
#: Counts that a task holds in memory before it passes them on, and how many at once.
HELD = 1 << 20
BATCH = 1 << 16
_LETTERS = bytes(c if c >= 0x80 else c | 0x20 if chr(c).isalpha() else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, in lower case, and of all that is not ASCII, in UTF-8."""
    return text.translate(_LETTERS).split()


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], *(np.add.reduceat(v[order], begins) if len(keys) else v for v in values)


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, df: what each task has counted; a key may come several times.

    A (lang, source) group comes with a null term as well, so that groups without terms are known.
    Tasks number terms and groups as they meet them and count the pairs of numbers in arrays.
    """
    schema = "lang string, source string, term string, n long, df long"
    arrow = arrow_schema(schema)
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: defaultdict[bytes, int] = defaultdict()
        groups: defaultdict[tuple, int] = defaultdict()
        numbers.default_factory, groups.default_factory = numbers.__len__, groups.__len__
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys, n, df = held.pop()
            words, names = pa.array(list(numbers), pa.binary()).cast(pa.string()), [pa.array(c, pa.string()) for c in zip(*groups, strict=True)]
            for at in range(0, len(keys), BATCH):
                group, word = (pa.array(x) for x in np.divmod(keys[at : at + BATCH], 1 << 32))
                yield pa.RecordBatch.from_arrays([*(c.take(group) for c in names), words.take(word), pa.array(n[at : at + BATCH]), pa.array(df[at : at + BATCH])], schema=arrow)
            yield pa.RecordBatch.from_arrays([*names, *(pa.nulls(len(groups), f.type) for f in list(arrow)[2:])], schema=arrow)
            numbers.clear()
            groups.clear()

        for batch in batches:
            for part in slices(batch):
                found = [terms(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                group = np.fromiter((groups[g] for g in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True)), np.int64, len(found))
                word = np.fromiter(map(numbers.__getitem__, chain.from_iterable(found)), np.int64, int(sizes.sum()))
                # First by document, for the number of documents; then by group.
                keys, n = np.unique(np.repeat(np.arange(len(found)), sizes) << 32 | word, return_counts=True)
                held.append(_summed(group[keys >> 32] << 32 | keys & 0xFFFFFFFF, n, np.ones(len(keys), np.int64)))
                if len(held) > 64 or sum(len(k) for k, _, _ in held) > 2 * HELD:
                    held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
                    if len(held[0][0]) > HELD or len(numbers) > HELD:
                        yield from flush()
        if groups:
            held = [_summed(*map(np.concatenate, zip(*held, strict=True)))]
            yield from flush()
        give_back()

    return docs.select(empty("text"), empty("lang"), empty("source")).mapInArrow(run, schema)


def _sketch(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The multipliers and the counters (up to 255) of Spark's count-min sketch in its documented binary form."""
    depth, width = (int.from_bytes(blob[i : i + 4], "big") for i in (12, 16))
    words = np.frombuffer(blob, ">i8", depth * (width + 1), 20)
    return words[:depth].astype(np.int64), np.minimum(words[depth:].reshape(depth, width), 255).astype(np.uint8)


def likely(parts: DataFrame, least: int = LEAST, error: float = ERROR, confidence: float = CONFIDENCE) -> DataFrame:
    """The rows of ``counted`` whose term may be in least documents of its language: all that are, and few others.

    The sketch is one of SHARES parts by key, so that no task merges what all tasks send.
    """
    key = F.xxhash64("lang", "term")
    rows = parts.where(F.col("term").isNotNull())
    # A count adds itself up to least times: enough to tell, and never too little.
    each = rows.select(F.explode(F.array_repeat(key, F.least("df", F.lit(least)).cast("int"))).alias("key"))
    made = each.groupBy(F.pmod("key", F.lit(SHARES)).alias("share")).agg(F.count_min_sketch("key", F.lit(min(1.0, error * SHARES)), F.lit(confidence), F.lit(42)).alias("s")).collect()
    if not made:
        return rows
    read = {r["share"]: _sketch(bytes(r["s"])) for r in made}
    factors, one = next(iter(read.values()))  # one seed, so the same multipliers in all parts
    shared = parts.sparkSession.sparkContext.broadcast((factors, np.stack([read[i][1] if i in read else np.zeros_like(one) for i in range(SHARES)])))

    @F.arrow_udf("boolean")
    def enough(keys: pa.Array) -> pa.Array:
        factors, counters = shared.value
        x, out = keys.to_numpy(zero_copy_only=False).astype(np.int64), np.full(len(keys), 255, np.uint8)
        part = x % SHARES
        with np.errstate(over="ignore"):
            for i, factor in enumerate(factors):
                h = x * factor
                h = (h + (h >> 32)) & 0x7FFFFFFF
                out = np.minimum(out, counters[part, i, h % counters.shape[2]])
        return pa.array(out >= least)

    return rows.where(enough.asNondeterministic()(key))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + size)), exact for totals up to 9e15: long division by thousands."""
    rest, over = count + 1, F.greatest(total + size, F.lit(1))
    out, rest = _div(rest, over), rest % over
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + _div(rest, over), rest % over
    return out + 1


def excess(p: Column, q: Column) -> Column:
    """The floor of (p - q)**2 / q; sums over a language's terms fit into a long up to some 1e9 terms."""
    return _div((p - q) * (p - q), q)


def _pairs(own: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, other, value: the divergence of every group from every other one of its language.

    own: lang, source, term, n, share of the terms that a group holds; groups: lang, source, size (terms that
    the language keeps), held (of them in the group) and least, the share of a term that is not.
    """
    one = groups.select("lang", "source", "size", "held", "least")
    two = groups.select("lang", F.col("source").alias("other"), F.col("held").alias("other_held"), F.col("least").alias("other_least"))
    pairs = one.join(two, "lang").where(F.col("source") != F.col("other"))
    none = (F.col("size") - F.col("held") - F.col("other_held")) * excess(F.col("least"), F.col("other_least"))
    base = pairs.select("lang", "source", "other", none.alias("value"))
    # Terms of one group against the other's least share; terms of equal counts are alike.
    hist = own.groupBy("lang", "source", "share").agg(F.count(F.lit(1)).alias("m"))
    against = hist.join(two, "lang").where(F.col("source") != F.col("other"))
    against = against.groupBy("lang", "source", "other").agg(F.sum(F.col("m") * excess(F.col("share"), F.col("other_least"))).alias("to"), F.sum(F.col("m") * excess(F.col("other_least"), F.col("share"))).alias("from"))
    to, back = against.select("lang", "source", "other", F.col("to").alias("value")), against.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("from").alias("value"))
    # Terms that both hold were counted against the least shares twice. Terms that the same groups hold
    # as often, as most rare ones do, are taken together; a term's groups are at most the language's.
    held = own.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("source", F.col("share").alias("p"), F.col("least").alias("p0")))).alias("held"))
    alike = held.where(F.size("held") > 1).groupBy("lang", "held").agg(F.count(F.lit(1)).alias("m"))
    one_of = alike.select("lang", "held", "m", F.posexplode("held").alias("at", "a"))
    two_of = one_of.select("lang", "m", "a", F.explode(F.slice("held", F.col("at") + 2, F.size("held"))).alias("b"))
    mend = lambda p, q, p0, q0: excess(p, q) - excess(p, q0) - excess(p0, q) + excess(p0, q0)
    p, q, p0, q0 = F.col("a.p"), F.col("b.p"), F.col("a.p0"), F.col("b.p0")
    both = two_of.groupBy("lang", F.col("a.source").alias("source"), F.col("b.source").alias("other")).agg(F.sum(F.col("m") * mend(p, q, p0, q0)).alias("there"), F.sum(F.col("m") * mend(q, p, q0, p0)).alias("back"))
    there, again = both.select("lang", "source", "other", F.col("there").alias("value")), both.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("back").alias("value"))
    every = base.unionByName(to).unionByName(back).unionByName(there).unionByName(again)
    return every.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank of every group (lang, source) of docs.

    Part 'pair': item is another source of the language, value the sum of ``excess`` over its kept
    terms, the other's share below.  Part 'term': item is a kept term that the group holds with more
    than its share in the language, ranks up to top.  Ranks go by value, the largest first, then by
    item in UTF-8.

    Null texts, languages and sources are the empty text, which is a name like others; a group of
    empty texts has pairs alone, as have groups of a language that keeps no term.  Ties go by item.
    Repeated rows are documents of their own.  Texts of any length are read whole, in one task each.
    Other columns, whatever their names, are not read; an empty table gives an empty result.
    """
    shelf = Shelf(docs.sparkSession, "divergence")
    parts = shelf.put(counted(docs), "parts")
    counts = shelf.put(likely(parts, least).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("df").alias("df")).where(F.col("df") >= least).drop("df")
    own = shelf.put(counts.drop("df").join(kept, ["lang", "term"]), "own")
    sizes = own.groupBy("lang", "term").agg(F.first("all").alias("all")).groupBy("lang").agg(F.count(F.lit(1)).alias("size"), F.sum("all").alias("lang_total"))
    sums = own.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("held"), F.sum("n").alias("total"))
    groups = parts.where(F.col("term").isNull()).select("lang", "source").distinct()
    groups = groups.join(sizes, "lang", "left").join(sums, ["lang", "source"], "left").na.fill(0)
    groups = shelf.put(groups.withColumn("least", share(F.lit(0).cast("long"), F.col("total"), F.col("size"))), "groups")
    shelf.clear("parts", "counts")
    own = own.join(groups, ["lang", "source"]).withColumn("share", share(F.col("n"), F.col("total"), F.col("size"))).withColumn("usual", share(F.col("all"), F.col("lang_total"), F.col("size")))
    ranked = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = _pairs(own, groups).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value").withColumn("rank", F.row_number().over(ranked))
    more = own.where(F.col("share") > F.col("usual")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess(F.col("share"), F.col("usual")).alias("value"))
    return pairs.unionByName(more.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top))
