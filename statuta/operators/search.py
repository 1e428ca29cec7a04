"""An inverted index of texts and ranked search with bounds.

Texts are dealt by span, SPAN ids that follow each other, so that all postings of a span are made in one task.
They are packed into blocks: one row per term and span, with the ids, the weights of the term
in these texts, and their maximum.  No row holds more than SPAN postings, however common its term; a
span of more than HELD postings has several rows for a term.
A search adds up, for each query and span, the most that the span's blocks allow; it scores the few
spans that promise most, takes the k-th best score found there as the bar, and scores only the
other spans that may reach it.  What is left out can't be among the best k, so the result is exact.
Only blocks of terms that are asked are moved, once to their span's task, which adds up scores in arrays of
queries by ids and gives out the best k of its queries; so no pair of a query and a text is ever shuffled.

Rules of our own: terms are runs of ASCII letters and digits, in lower case.  A term's weight in a
text is 2200 * 1000 * tf div (1000 * tf + 300 + 900 * length div mean length), at most 2200; times round(1000 *
ln(1 + texts / texts with the term)) it is the term's part of the score.  All scores are whole numbers.
"""

from __future__ import annotations

import string
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from statuta.sources.scratch import put, scratch

SPAN = 1024
#: Spans of each query that are scored first.
FIRST = 4
#: Postings that a task holds before it writes them as blocks.
HELD = 1 << 20
#: Queries, and terms of queries, of one turn over the index; more are dealt to several turns.
QUERIES, ASKED = 1000, 50_000

BLOCKS = "term string, span long, ids array<long>, weights array<int>, most int, n int"
#: Of a posting, the bits that hold its weight.
_BITS = 12
_KEPT = (string.ascii_lowercase + string.digits).encode()
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEPT else 32 for c in range(256))


def terms(text: Column) -> Column:
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(folded, F.lit("[a-z0-9]+"), F.lit(0))


def _terms(text: bytes) -> list[bytes]:
    """What ``terms`` finds in a text of UTF-8."""
    return text.translate(_FOLD).split()


@dataclass
class Index:
    """blocks: term, span, ids, weights, most, n (ids of the block).  texts: how many there are."""

    blocks: DataFrame
    texts: int


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [len(_terms(t.as_py())) for t in batch.column("text")]
        yield pa.RecordBatch.from_pydict({"texts": [len(found)], "length": [sum(found)]}, pa.schema([("texts", pa.int64()), ("length", pa.int64())]))


def _packed(mean: int, width: int, held: int):
    """Turns texts in the order of span and id into blocks."""
    arrow = to_arrow_schema(StructType.fromDDL(BLOCKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings: defaultdict[bytes, list[int]] = defaultdict(list)
        copies: dict[int, Counter[bytes]] = {}  # of one id, by length
        now, count = (None, None), 0

        def add() -> int:
            span, ident = now
            place, n = ident - span * width, 0
            for length, tf in copies.items():
                below = 300 + length * 900 // mean
                packed = {x: place << _BITS | x * 2_200_000 // (x * 1000 + below) for x in set(tf.values())}
                for term, x in tf.items():
                    postings[term].append(packed[x])
                n += len(tf)
            copies.clear()
            return n

        def flush() -> Iterator[pa.RecordBatch]:
            sizes = np.fromiter(map(len, postings.values()), np.int64, len(postings))
            ends = np.cumsum(sizes)
            flat = np.fromiter((x for found in postings.values() for x in found), np.int64, int(ends[-1]) if len(ends) else 0)
            ids, weights = (flat >> _BITS) + now[0] * width, (flat & (1 << _BITS) - 1).astype(np.int32)
            names = list(postings)
            postings.clear()
            first = 0
            while first < len(names):  # blocks of some 64 k postings at a time
                begins = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, begins + (1 << 16), "right")))
                cut, stop = ends[first:last], int(ends[last - 1])
                offsets = pa.array(np.concatenate([[0], cut - begins]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(names[first:last], pa.binary()).cast(pa.string()), pa.array(np.full(last - first, now[0], np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(ids[begins:stop])), pa.ListArray.from_arrays(offsets, pa.array(weights[begins:stop])),
                    pa.array(np.maximum.reduceat(weights[begins:stop], (cut - begins) - sizes[first:last])), pa.array(sizes[first:last].astype(np.int32)),
                ], schema=arrow)
                first = last

        for batch in batches:
            for span, ident, text in zip(batch.column("span").to_pylist(), batch.column("id").to_pylist(), batch.column("text"), strict=True):
                if (span, ident) != now:
                    if copies:
                        count += add()
                    if postings and (span != now[0] or count > held):
                        yield from flush()
                        count = 0
                    now = span, ident
                found = _terms(text.as_py())
                if found:
                    copies.setdefault(len(found), Counter()).update(found)
        if copies:
            add()
        if postings:
            yield from flush()

    return run


def build(docs: DataFrame, ident: str, text: str) -> Index:
    """The index of all texts; ids are whole numbers.  Null texts and ids are left out, and texts without terms count as texts.

    Texts of one id are one text for each length that they have, as if it held the terms of all of them.
    """
    at = scratch(docs.sparkSession, "index")
    rows = docs.select(F.col(ident).cast("long").alias("id"), F.col(text).cast("binary").alias("text")).dropna()
    texts, length = rows.select("text").mapInArrow(_lengths, "texts long, length long").agg(F.sum("texts"), F.sum("length")).first()
    mean = max(1, (length or 0) // max(1, texts or 0))
    dealt = rows.withColumn("span", F.expr(f"(id - pmod(id, {SPAN})) div {SPAN}")).repartition("span").sortWithinPartitions("span", "id")
    return Index(put(dealt.mapInArrow(_packed(mean, SPAN, HELD), BLOCKS), f"{at}/blocks"), texts or 0)


def _best(names: list, asked: list[tuple[int, str, int]], width: int, k: int, kind: StructField):
    """Turns the blocks of each span, behind a row without a term that names the queries to score there by number, into the best k of each query."""
    arrow = to_arrow_schema(StructType.fromDDL("query int, id long, score long"))
    arrow = arrow.set(0, to_arrow_schema(StructType([kind])).field(0).with_name("query"))
    by: defaultdict[str, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))
    for number, term, idf in asked:
        by[term][0].append(number)
        by[term][1].append(idf)
    wanted = {t: (np.array(q), np.array(idf, np.int64)) for t, (q, idf) in by.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {}
        now, row = None, np.full(len(names), -1)  # of a query: its row in the arrays below
        scores, hit, queries = np.zeros((0, width), np.int64), np.zeros((0, width), bool), np.zeros(0, np.int64)

        def finish() -> None:
            for i, q in enumerate(queries.tolist()):
                places = np.flatnonzero(hit[i])
                top = places[np.argsort(-scores[i][places], kind="stable")[:k]]
                best[q] = sorted([*best.get(q, ()), *zip((-scores[i][top]).tolist(), (top + now * width).tolist(), strict=True)])[:k]

        for batch in batches:
            found, spans = batch.column("term").to_pylist(), batch.column("span").to_pylist()
            ids, weights = batch.column("ids"), batch.column("weights")
            starts, flat, heavy = ids.offsets.to_numpy(), ids.values.to_numpy(), weights.values.to_numpy()
            others = weights.offsets.to_numpy()
            for i, (term, span) in enumerate(zip(found, spans, strict=True)):
                own = flat[starts[i] : starts[i + 1]]
                if term is None:
                    finish()
                    now, queries = span, own.astype(np.int64)
                    row[:] = -1
                    row[queries] = np.arange(len(queries))
                    scores, hit = np.zeros((len(queries), width), np.int64), np.zeros((len(queries), width), bool)
                    continue
                if span != now:
                    continue  # no query asks this span
                q, idf = wanted[term]
                at = row[q]
                at, idf = at[at >= 0], idf[at >= 0]
                if len(at):
                    places, parts = own - span * width, idf[:, None] * heavy[others[i] : others[i + 1]].astype(np.int64)
                    # An id stands in a block once, unless it has several texts.
                    cells = np.ix_(at, places)
                    if (places[1:] > places[:-1]).all():
                        scores[cells] += parts
                    else:
                        np.add.at(scores, cells, parts)
                    hit[cells] = True
        finish()
        rows = [(names[q], i, -s) for q, found in best.items() for s, i in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return run


def search(index: Index, queries: DataFrame, ident: str, text: str, k: int = 10) -> DataFrame:
    """query, rank, id, score: the k texts of the highest scores for each query, the smaller id first where scores are equal.

    A query's terms count once each.  Queries without a known term have no rows.
    """
    at = scratch(queries.sparkSession, "search")
    asked = put(queries.select(F.col(ident).alias("query"), F.explode(F.array_distinct(terms(F.col(text)))).alias("term")).dropna().distinct(), f"{at}/asked")
    count, rows = asked.agg(F.count_distinct("query"), F.count(F.lit(1))).first()
    turns = max(1, -(-count // QUERIES), -(-rows // ASKED))
    mine = F.pmod(F.xxhash64("query"), F.lit(turns))
    parts = [_turn(index, asked.where(mine == i), k, f"{at}/{i}") for i in range(turns)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _turn(index: Index, asked: DataFrame, k: int, at: str) -> DataFrame:
    """``search`` for so many queries that a task can hold them."""
    spark = asked.sparkSession
    own = F.broadcast(asked.select("term").distinct())
    idf = F.round(F.log(1 + F.lit(index.texts) / F.sum("n")) * 1000).cast("long")
    known = index.blocks.select("term", "n").join(own, "term", "left_semi").groupBy("term").agg(idf.alias("idf"))
    asked = put(asked.join(known, "term"), f"{at}/asked")
    every = [tuple(r) for r in asked.select("query", "term", "idf").sort("query", "term").collect()]  # some ASKED at most
    names = list(dict.fromkeys(q for q, _, _ in every))
    number = {q: i for i, q in enumerate(names)}
    numbers = F.broadcast(spark.createDataFrame(list(number.items()), StructType([asked.schema["query"], StructField("number", StructType.fromDDL("n long")["n"].dataType)])))
    blocks = index.blocks.join(F.broadcast(asked.select("term").distinct()), "term", "left_semi").select("term", "span", "ids", "weights")
    bounds = put(index.blocks.select("term", "span", "most").join(F.broadcast(asked), "term").groupBy("query", "span").agg(F.sum(F.col("idf") * F.col("most")).alias("bound")), f"{at}/bounds")
    task = _best(names, [(number[q], t, i) for q, t, i in every], SPAN, k, asked.schema["query"])
    kind = StructType([asked.schema["query"], *StructType.fromDDL("id long, score long").fields])

    def scored(blocks: DataFrame, spans: DataFrame) -> DataFrame:
        """query, id, score of texts in the given (query, span) pairs, among them the best k of each query."""
        heads = spans.join(numbers, "query").groupBy("span").agg(F.collect_list("number").alias("ids"))
        heads = heads.select(F.lit(None).cast("string").alias("term"), "span", "ids", F.array().cast("array<int>").alias("weights"))
        return blocks.unionByName(heads).repartition("span").sortWithinPartitions("span", F.col("term").asc_nulls_first()).mapInArrow(task, kind)

    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("bound"), "span"))
    first = put(bounds.withColumn("place", place).where(F.col("place") <= FIRST), f"{at}/first")
    best = lambda rows: rows.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
    near = blocks.join(F.broadcast(first.select("span").distinct()), "span", "left_semi").select(*blocks.columns)  # FIRST for each query at most
    seen = put(best(scored(near, first)), f"{at}/seen")
    bar = seen.where(F.col("rank") == k).select("query", F.col("score").alias("bar"))
    # A span whose bound is the bar itself may hold a text of equal score and smaller id.
    rest = bounds.join(F.broadcast(first.select("query", "span")), ["query", "span"], "left_anti").join(F.broadcast(bar), "query", "left").where(F.col("bound") >= F.coalesce("bar", F.lit(0)))
    return best(seen.drop("rank").unionByName(scored(blocks, rest))).select("query", "rank", "id", "score")
