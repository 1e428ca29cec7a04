"""Line dedup: lines that many documents share stay in one of them, and what goes is told by bitmaps.

Each document gives one row per distinct line (its key's 128-bit digest) with the places where the
line stands.  The rows are range-partitioned by digest and document and sorted, documents from the
largest id on and then by place, so one pass over a partition sees every key's documents in order:
the first keeps the line, the others lose it once a third one has shown that the line is common.
A pass holds the rows of at most LEAST - 1 documents of one key.

A key with a third of all rows fills several partitions.  A pass can't decide the first and the last
key of its partition, which may go on elsewhere: it sets their rows aside and states how many
documents it has seen, and which is the largest.  Those statements, two a partition, add up to the
decision, and the rows set aside meet it in a broadcast join.  So no task gets a key's rows together.

The result is the places that go, as one compressed bitmap per document, a set bit for each line
that stays; texts take no part in the shuffle, and meet their bitmaps in one join.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import Shelf, arrow_schema, give_back, map_slices, parts

#: Code points that a key has at least, and documents that it must be found in.
SHORTEST = 20
LEAST = 3
_BLANK = b" \t\n\x0b\x0c\r"


def key_of(line: bytes, shortest: int = SHORTEST) -> bytes | None:
    """The line's key in UTF-8, or None if that is too short to count."""
    key = line.strip(_BLANK).lower()  # bytes.lower() changes A-Z alone
    if len(key) < shortest or len(key) < 4 * shortest and len(key.decode()) < shortest:
        return None
    return key


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, mark and text: rows of one doc_id are told apart by their texts' hash."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def lines(rows: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """digest, doc_id, mark, places: a row for every distinct key of every row of ``marked``."""

    def step(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("digest", "doc_id", "mark", "places")}
        for doc, mark, text in zip(batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            found: dict[bytes, list[int]] = {}
            for place, line in enumerate(text.split(b"\n")):
                if key := key_of(line, shortest):
                    found.setdefault(key, []).append(place)
            for key, places in found.items():
                for column, value in zip(out.values(), (_digest(key), doc, mark, places), strict=True):
                    column.append(value)
        return out

    return map_slices(rows, "digest binary, doc_id long, mark long, places array<int>", step)


def _passed(found: DataFrame, least: int) -> DataFrame:
    """One pass over every sorted partition: rows that go, rows set aside, and statements about their keys.

    kind is 'drop' (doc_id, mark, places), 'open' (the same and the digest) or 'seen' (the digest,
    the number of documents, and the largest of them as doc_id).
    """
    schema = "kind string, digest binary, doc_id long, mark long, places array<int>, documents long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now, first, top, last, documents, held = None, True, None, None, 0, []

        def close(edge: bool) -> None:
            if edge and now is not None:
                out.extend(("open", now, *row, None) for row in held)
                out.append(("seen", now, top, None, None, documents))

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), arrow, strict=True)], schema=arrow)
            out.clear()
            return batch

        for batch in batches:
            for digest, doc, mark, places in zip(*(batch.column(c).to_pylist() for c in ("digest", "doc_id", "mark", "places")), strict=True):
                if digest != now:
                    if now is not None:
                        close(first)
                        first = False
                    now, top, last, documents, held = digest, doc, doc, 1, []
                elif doc != last:
                    last, documents = doc, documents + 1
                if first:  # perhaps it began in the partition before
                    out.append(("open", digest, doc, mark, places, None))
                elif doc == top:
                    pass
                elif documents >= least:
                    out.extend(("drop", None, *row, None) for row in [*held, (doc, mark, places)])
                    held = []
                else:
                    held.append((doc, mark, places))
                if len(out) >= 4096:
                    yield flush()
            del batch
        close(True)
        if out:
            yield flush()
        give_back()

    return found.mapInArrow(run, schema)


def _keep(places: list[int]) -> bytes:
    stays = np.ones(8 * (max(places) // 8 + 1), bool)
    stays[places] = False
    return zlib.compress(np.packbits(stays).tobytes())


def kept_lines(text: bytes, bitmap: bytes | None) -> tuple[bytes, int, int]:
    """The text without the lines whose bit is unset, its number of lines before, and that of those that went."""
    every = text.split(b"\n")
    if bitmap is None:
        return text, len(every), 0
    stays = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[: len(every)]
    left = [x for x, keep in zip(every, stays, strict=False) if keep] + every[len(stays) :]
    return b"\n".join(left), len(every), len(every) - len(left)


def keep_bitmaps(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """doc_id, mark and bitmap of every document that loses lines.

    The bitmap is compressed (zlib, bits packed from the highest on); lines past its end stay.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark, "lines")
    found = shelf.put(lines(marked(docs), shortest), "found")
    order = [F.col("digest"), F.col("doc_id").desc_nulls_last()]
    ranged = found.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order, "mark", "places")
    passed = shelf.put(_passed(ranged, least), "passed")
    shelf.clear("found")
    # Two rows a partition at most.
    seen = passed.where("kind = 'seen'").groupBy("digest").agg(F.sum("documents").alias("all"), F.max("doc_id").alias("top")).where(F.col("all") >= least)
    late = passed.where("kind = 'open'").join(F.broadcast(seen), "digest").where(~F.col("doc_id").eqNullSafe(F.col("top")))
    gone = passed.where("kind = 'drop'").select("doc_id", "mark", "places").unionByName(late.select("doc_id", "mark", "places"))
    # Rows that repeat another one have its places again: the set has them once.
    gone = gone.groupBy("doc_id", "mark").agg(F.flatten(F.collect_set("places")).alias("places"))
    return map_slices(gone, "doc_id long, mark long, bitmap binary", lambda b: {"doc_id": b.column("doc_id"), "mark": b.column("mark"), "bitmap": [_keep(x) for x in b.column("places").to_pylist()]})


def applied(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, text without the lines that go, n_lines before, n_dropped."""
    marks = bitmaps.select(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"), "bitmap").hint("merge")  # bitmaps grow with the documents
    rows = marked(docs).join(marks, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark")), "left").select("doc_id", "text", "bitmap")

    def step(batch: pa.RecordBatch) -> dict:
        cells = [kept_lines(t, b) for t, b in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("bitmap").to_pylist(), strict=True)]
        return {"doc_id": batch.column("doc_id"), "text": [x[0].decode() for x in cells], "n_lines": [x[1] for x in cells], "n_dropped": [x[2] for x in cells]}

    return map_slices(rows, "doc_id long, text string, n_lines long, n_dropped long", step)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the lines that stay, joined.

    Keys of SHORTEST code points or more that LEAST documents hold lose all their lines but those in
    the largest doc_id; rows of one doc_id count as one document, null being the smallest id.  A null
    or empty text is one empty line, which is too short to go.  A text of any length is split whole,
    and repeated rows get equal results, one each.  Other columns, whatever their names, are not
    read; an empty table gives an empty result.
    """
    out = applied(docs, keep_bitmaps(docs))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
