"""Where two versions of a text differ, line by line: shortest edit scripts as hunks, and their application."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

HUNK = "struct<old_start: int, removed: int, new_start: int, added: array<string>>"
#: Edits that one search goes through; a longer script is put together from searches, and may then not be the shortest.
EDITS = 2000


def _common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of equal items in a longest common subsequence, by the furthest point that d edits reach on each diagonal.

    Where EDITS edits do not reach the end, the path to the furthest point is kept, and the search
    goes on from there.
    """
    out: list[tuple[int, int]] = []
    x0 = y0 = 0
    while x0 < len(a) and y0 < len(b):
        n, m = len(a) - x0, len(b) - y0
        reach, trace, end = {1: 0}, [], None
        for d in range(min(n + m, EDITS) + 1):
            trace.append(reach)
            now = {}
            for k in range(-d, d + 1, 2):
                if k < -m or k > n:
                    continue
                down = k == -d or k != d and reach.get(k - 1, -1) < reach.get(k + 1, -1)
                x = reach.get(k + 1, 0) if down else reach.get(k - 1, -1) + 1
                while x < n and x - k < m and a[x0 + x] == b[y0 + x - k]:
                    x += 1
                now[k] = x
                if x >= n and x - k >= m:
                    end = k
            reach = now
            if end is not None:
                break
        if end is None:
            end = max((k for k in reach if 0 <= reach[k] <= n and 0 <= reach[k] - k <= m), key=lambda k: 2 * reach[k] - k)
        x, k, path = reach[end], end, []
        stop = x, x - k
        for d in range(len(trace) - 1, -1, -1):
            before = trace[d]
            down = k == -d or k != d and before.get(k - 1, -1) < before.get(k + 1, -1)
            came = k + 1 if down else k - 1
            start = (before.get(came, 0) if down else before.get(came, -1) + 1) if d else 0
            while x > start:
                x -= 1
                path.append((x0 + x, y0 + x - k))
            if d:
                k, x = came, before.get(came, 0)
        out += reversed(path)
        x0, y0 = x0 + stop[0], y0 + stop[1]
    return out


def hunks(old: str | None, new: str | None) -> list[tuple[int, int, int, list[str]]]:
    """The edits that make new of old: (line of old, lines removed there, line of new, lines put there), in order.

    Lines are what stands between line feeds, so an empty text is one empty line; null counts as
    empty.  What begins and ends both texts is cut off first, and lines that only one of them has
    take no part in the search, as nothing can match them: that leaves the script as short.
    """
    a, b = (old or "").split("\n"), (new or "").split("\n")
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    number: dict[str, int] = {}
    both = set(a[head : len(a) - tail]) & set(b[head : len(b) - tail])
    left = [(i, number.setdefault(a[i], len(number))) for i in range(head, len(a) - tail) if a[i] in both]
    right = [(i, number.setdefault(b[i], len(number))) for i in range(head, len(b) - tail) if b[i] in both]
    same = [(left[i][0], right[j][0]) for i, j in _common([x for _, x in left], [x for _, x in right])]
    out, i, j = [], head, head
    for x, y in [*same, (len(a) - tail, len(b) - tail)]:
        if x > i or y > j:
            out.append((i, x - i, j, b[j:y]))
        i, j = x + 1, y + 1
    return out


def patched(old: str | None, edits: list[tuple[int, int, int, list[str]]]) -> str:
    """The text that hunks make of old."""
    a, out, at = (old or "").split("\n"), [], 0
    for start, removed, _, added in edits:
        out += a[at:start] + list(added)
        at = start + removed
    return "\n".join(out + a[at:])


def _mapped(rows: DataFrame, keep: list[str], ddl: str, columns: tuple[str, str], of) -> DataFrame:
    schema = StructType([rows.schema[k] for k in keep] + StructType.fromDDL(ddl).fields)
    arrow, most = to_arrow_schema(schema), 256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, most):
                batch = whole.slice(at, most)
                made = [of(*x) for x in zip(*(batch.column(c).to_pylist() for c in columns), strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(made, type=arrow[-1].type)], schema=arrow)

    return rows.select(*dict.fromkeys([*keep, *columns])).mapInArrow(run, schema)


def differences(rows: DataFrame, old: str, new: str, *keep: str) -> DataFrame:
    """The columns in keep and ``hunks``, an array of HUNK, for every row with two texts."""
    fields = ("old_start", "removed", "new_start", "added")
    return _mapped(rows, list(keep), f"hunks array<{HUNK}>", (old, new), lambda a, b: [dict(zip(fields, h, strict=True)) for h in hunks(a, b)])


def applied(rows: DataFrame, old: str, edits: str, *keep: str) -> DataFrame:
    """The columns in keep and ``text``, the old text with its hunks applied."""
    return _mapped(rows, list(keep), "text string", (old, edits), lambda a, h: patched(a, [(x["old_start"], x["removed"], x["new_start"], x["added"]) for x in h]))


def between_tiers(old: DataFrame, new: DataFrame, key: str = "article_id", text: str = "body") -> DataFrame:
    """key and hunks of every article that both tiers have with different texts; a key that repeats gives every pair."""
    a, b = old.select(key, F.col(text).alias("_old")), new.select(key, F.col(text).alias("_new"))
    return differences(a.join(b, key).where(~F.col("_old").eqNullSafe(F.col("_new"))), "_old", "_new", key)
