"""Token counts of sections: texts are encoded once, whole, and tokens are attributed by offset.

Sections are spans of code points in ascending order that cover the text; by default its lines,
each with its line feed.  A token is attributed to the sections that its span overlaps: one that
lies inside a section counts for it; one that crosses a boundary counts for the section that holds
most of its code points, the first of several.  So the counts of a text's sections add up to its
tokens.  Tokens that are parts of one character have that character's span.

Null and empty texts have no tokens and no sections.  Rows are independent, so ties and repeated
rows do not matter; very long texts are encoded whole, one at a time.  Extra columns, whatever
their names, are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import map_slices, texts


#: Runs of white space as the library's matcher knows it, too long to be left to it.
_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


class Encoder:
    """Token spans of whole texts: the tokens' byte lengths are summed up and turned into code points."""

    def __init__(self, source: str):
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in source.splitlines() if line)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def encode(self, text: str) -> list[int]:
        """The token ids of a text.

        The library's matcher overflows its stack on runs of a million blanks, so long runs are cut
        out first.  The pattern makes all of a run but its last character one piece, and all of it
        at the end of a text; what stands before and behind is split the same with or without it.
        """
        out, at = [], 0
        for m in _RUN.finditer(text):
            end = m.end() if m.end() == len(text) else m.end() - 1
            out += self.encoding.encode_ordinary(text[at : m.start()])
            out += self.encoding._encode_single_piece(text[m.start() : end])
            at = end
        return out + self.encoding.encode_ordinary(text[at:]) if at else self.encoding.encode_ordinary(text)

    def spans(self, text: str) -> np.ndarray:
        ids = np.array(self.encode(text), np.int64)
        if not len(ids):
            return np.zeros((0, 2), np.int64)
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        if not text.isascii():
            data = np.frombuffer(text.encode(), np.uint8)
            character = np.cumsum((data & 0xC0) != 0x80) - 1
            starts, ends = character[starts], character[ends - 1] + 1
        return np.stack([starts, ends], axis=1)


@lru_cache(maxsize=2)
def encoder(source: str) -> Encoder:
    return Encoder(source)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def lines(text: str) -> np.ndarray:
    """The ends of a text's lines; each holds its line feed."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if text and (not ends or ends[-1] < len(text)):
        ends.append(len(text))
    return np.array(ends, np.int64)


def attribute(spans: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """Tokens per section, and how many tokens crossed a boundary.

    Sections and tokens are both sorted, so the join of their intervals is two binary searches.
    """
    if not len(ends):
        return np.zeros(0, np.int64), 0
    start, end = spans[:, 0], np.maximum(spans[:, 1], spans[:, 0] + 1)
    first = np.minimum(np.searchsorted(ends, start, side="right"), len(ends) - 1)
    last = np.minimum(np.searchsorted(ends, end - 1, side="right"), len(ends) - 1)
    owner = first.copy()
    crossing = np.flatnonzero(last > first)
    for k in crossing.tolist():
        sections = np.arange(first[k], last[k] + 1)
        begins = np.where(sections > 0, ends[sections - 1], 0)
        share = np.minimum(ends[sections], end[k]) - np.maximum(begins, start[k])
        owner[k] = sections[int(share.argmax())]
    return np.bincount(owner, minlength=len(ends)), len(crossing)


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, n_sections, n_crossing and section_tokens (comma-joined) of every document."""
    with open(path or default_path(), encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def step(batch):
        e = encoder(source.value)
        out = {c: [] for c in ("n_tokens", "n_sections", "n_crossing", "section_tokens")}
        for text in texts(batch.column("text")):
            spans = e.spans(text)
            counts, crossing = attribute(spans, lines(text))
            out["n_tokens"].append(len(spans))
            out["n_sections"].append(len(counts))
            out["n_crossing"].append(crossing)
            out["section_tokens"].append(",".join(map(str, counts.tolist())))
        return {"doc_id": batch.column("doc_id"), **out}

    schema = "doc_id long, n_tokens long, n_sections long, n_crossing long, section_tokens string"
    return map_slices(docs.select(F.col("doc_id").cast("long"), "text"), schema, step)
