"""Near-duplicate documents: a chosen-path similarity join on word shingles.

1. ``profiles``: per row the number of its shingles, a key of its shingle set, TOKENS minwise
   tokens and a sketch of SKETCH_BITS one-bit minwise values.  Rows with one key are one class.
2. ``candidates``: TREES independent trees.  A tree's root node is chosen by one minwise token.
   In a node of at most SMALL classes all pairs are compared by sketch and size.  In a larger node
   all classes are first compared with PIVOTS of them; those that are like one pivot hang together
   through it and need no comparison with each other.  The rest is compared with all the node's
   classes, in pieces, if that takes at most PAIRS comparisons; else the node branches: each class goes
   on to BRANCHES nodes, chosen by further tokens.  At depth DEPTH the rest is compared in pieces
   whatever its size.  A node tells which of its classes hang together, as stars, never as all pairs.
   A pair at the threshold misses a root with probability 0.2, and a branching node with all its
   branches with about 0.25, so TREES small roots miss it with 1e-7, trees that branch
   down to DEPTH with 3e-5 (in trials; the trees share the tokens that choose branches).
   Sketches rule out pairs whose estimate is under LOOSE, 4.8 standard errors below the
   threshold; that loses a pair at the threshold with 7e-6.  More alike pairs fare better.
3. ``links``: the full sets of classes that may hang together are gathered by group, and links are
   decided by exact intersections: 100 * common >= 80 * union.  A group of more than PIECE
   shingles (a document counts for DOCUMENT more) is dealt in pieces: first all classes meet
   PIVOTS of the group, then those that did not link up with most others meet all classes, each
   piece of them each piece of the group.  So a group of near copies takes time in proportion to
   its size, and no task holds a group.
4. Components of the confirmed links give each row the smallest doc_id that it reaches.

Null or empty texts have an empty set and link with nothing; a text shorter than a shingle is one
shingle as a whole; lower case is A-Z only; words are split at ASCII white space.  Rows with one
doc_id are rows of their own and share that id; null ids count last.  A very long text is worked
on alone, in memory linear in its length.  Extra columns, whatever their names, are ignored by
``near_duplicates`` and kept by ``deduplicated``.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import CACHES, HOT, Shelf, arrow_schema, attach, cut, give_back, map_slices, sieve, slices, texts
from statuta.llm.components import components

WORDS = 2
TREES = 10
BRANCHES = 2
DEPTH = 6
SMALL = 1000
#: Comparisons by sketch for which a node need not branch.
PAIRS = 100_000_000
BASES = 4096
PIVOTS = 16
#: Tokens among which a path picks at each depth below the root.
CHOICES = 10
TOKENS = TREES + CHOICES * (DEPTH - 1)
#: Bytes of a row's tokens: four for each root, one for each branch, which only has to part what its node holds.
PACKED = 4 * TREES + TOKENS - TREES
SKETCH_BITS = 256
LOOSE = 0.62
PIECE = 300_000
DOCUMENT = 500
CACHED_WORDS = 100_000
SHARED_BLOCK = 4096

_U = np.uint64
_RNG = np.random.default_rng(8)
_MULTIPLIERS = _RNG.integers(0, 1 << 63, SKETCH_BITS, dtype=np.uint64) * _U(2) + _U(1)
_MASKS = _RNG.integers(0, 1 << 63, SKETCH_BITS, dtype=np.uint64)
_words: dict[bytes, int] = {}
CACHES.append(_words.clear)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(_words) > CACHED_WORDS:
        _words.clear()
    get = _words.get
    codes = []
    for w in found:
        code = get(w)
        if code is None:
            code = _words[w] = xxhash.xxh3_64_intdigest(w)
        codes.append(code)
    h = np.array(codes, np.uint64)
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + h[k : k + len(out)])
    return np.unique(out)


def minwise(found: np.ndarray) -> np.ndarray:
    """SKETCH_BITS minwise values of a set, 32 bits each."""
    out = np.empty(SKETCH_BITS, np.uint64)
    for at in range(0, SKETCH_BITS, 64):
        low = None
        for i in range(0, len(found), 8192):
            x = (found[None, i : i + 8192] ^ _MASKS[at : at + 64, None]) * _MULTIPLIERS[at : at + 64, None]
            low = x.min(axis=1) if low is None else np.minimum(low, x.min(axis=1))
        out[at : at + 64] = low
    return (_mix(out) >> _U(32)).astype(np.uint32)


def key_of(found: np.ndarray) -> bytes:
    return blake2b(found.tobytes(), digest_size=16).digest()


def mark() -> Column:
    """A digest of the text: with doc_id it tells rows with different texts apart, ids being neither unique nor never null."""
    return F.xxhash64("text")


def profiles(docs: DataFrame, words: int = WORDS) -> DataFrame:
    def step(batch):
        out = {c: [] for c in ("n_shingles", "key", "tokens", "bits")}
        for text in texts(batch.column("text")):
            found = shingles(text, words)
            out["n_shingles"].append(len(found))
            if not len(found):
                for c in ("key", "tokens", "bits"):
                    out[c].append(None)
                continue
            low = minwise(found)
            out["key"].append(key_of(found))
            out["tokens"].append(low[:TREES].tobytes() + low[TREES:TOKENS].astype(np.uint8).tobytes())
            out["bits"].append(np.packbits(low & 1).tobytes())
        return {"doc_id": batch.column("doc_id"), "mark": batch.column("mark"), **out}

    source = docs.select(F.col("doc_id").cast("long"), mark().alias("mark"), "text")
    return map_slices(source, "doc_id long, mark long, n_shingles long, key binary, tokens binary, bits binary", step)


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


_NODES = "node long, depth int, path long, key binary, n_shingles long, bits binary"


def _roots(classes: DataFrame) -> DataFrame:
    """The root nodes of each class: one token for each tree."""
    schema = arrow_schema(_NODES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _matrix(batch.column("tokens"), np.uint8, PACKED)[:, : 4 * TREES].copy().view(np.uint32)
            for tree in range(TREES):
                node = _mix(tokens[:, tree].astype(np.uint64) | _U(tree + 1) << _U(32)).view(np.int64)
                yield _rows(schema, node, 1, np.full(len(node), tree), batch)

    return classes.select("key", "n_shingles", "tokens", "bits").mapInArrow(run, _NODES)


def _rows(schema, node, depth, path, batch) -> pa.RecordBatch:
    columns = [pa.array(node), pa.array(np.full(len(node), depth, np.int32)), pa.array(np.asarray(path, np.int64)), batch.column("key"), batch.column("n_shingles"), batch.column("bits")]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _branches(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """Each class of a large node goes on to BRANCHES nodes.

    path holds the tree and the branches taken; it picks which token comes next, another one at
    each step of a path.
    """
    schema = arrow_schema(_NODES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _matrix(batch.column("tokens"), np.uint8, PACKED)[:, 4 * TREES :].astype(np.uint64)
            path, node = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("path", "node"))
            depth = int(batch.column("depth")[0].as_py())
            for branch in range(BRANCHES):
                new = path * BRANCHES + branch + TREES * depth
                start = (_mix(path.astype(np.uint64)) % _U(CHOICES)).astype(np.int64)
                pick = CHOICES * (depth - 1) + (start + branch) % CHOICES
                token = tokens[np.arange(len(new)), pick]
                yield _rows(schema, _mix(node.view(np.uint64) ^ _mix(token | _U(branch + 1) << _U(32))).view(np.int64), depth + 1, new, batch)

    joined = nodes.select("node", "depth", "path", "key").join(classes.select("key", "n_shingles", "tokens", "bits"), "key")
    return joined.mapInArrow(run, _NODES)


def _alike(bits: np.ndarray, sizes: np.ndarray, other_bits: np.ndarray, other_sizes: np.ndarray) -> np.ndarray:
    """Which classes may be linked with which others, by sketch and size."""
    differ = np.zeros((len(bits), len(other_bits)), np.uint16)
    for k in range(bits.shape[1]):
        differ += np.bitwise_count(bits[:, k][:, None] ^ other_bits[None, :, k])
    near = differ <= (1 - LOOSE) / 2 * SKETCH_BITS
    a, b = sizes[:, None] * 100, other_sizes[None, :] * 100
    return near & (a >= b * 4 // 5) & (b >= a * 4 // 5)


def stars(n: int, alike, block: int) -> np.ndarray:
    """The first member of each member's group, by comparing all n members in blocks."""
    root = np.arange(n)
    for at in range(0, n, block):
        rows = slice(at, min(n, at + block))
        i, j = np.nonzero(alike(rows))
        if len(i) > rows.stop - rows.start:
            _union(root, i + at, j)
    return _flat(root)


def _flat(root: np.ndarray) -> np.ndarray:
    while True:
        up = root[root]
        if np.array_equal(up, root):
            return root
        root[:] = up


def _union(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the groups of i and j; a root is the smallest index of its group."""
    while True:
        a, b = _flat(root)[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))


_FOUND = "a binary, b binary, node long, depth int, path long"


def _compare(nodes: DataFrame) -> DataFrame:
    """Compares small nodes: rows (a, b) of what hangs together.  Members of larger nodes come back with their node, b null."""
    schema = arrow_schema(_FOUND)

    def small(keys, bits, sizes) -> list[tuple]:
        root = stars(len(keys), lambda rows: _alike(bits[rows], sizes[rows], bits, sizes), max(1, (1 << 21) // len(keys)))
        return [(keys[i], keys[r], None, None, None) for i, r in enumerate(root) if i != r]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # arrays of the node that is being read
        state = {"node": None, "n": 0, "large": False}

        def close() -> list[tuple]:
            if state["large"] or state["n"] < 2:
                return []
            return small(*(np.concatenate([h[k] for h in held]) if k else sum((h[0] for h in held), []) for k in range(3)))

        def large(keys, node, depth, paths) -> list[tuple]:
            return [(k, None, node, depth, int(p)) for k, p in zip(keys, paths, strict=True)]

        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            keys = batch.column("key").to_pylist()
            bits = _matrix(batch.column("bits"), np.uint64, SKETCH_BITS // 64)
            sizes = batch.column("n_shingles").to_numpy()
            paths = batch.column("path").to_numpy()
            depth = int(batch.column("depth")[0].as_py())
            edges = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1], [True]]))
            out: list[tuple] = []
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if node[start] != state["node"]:
                    out += close()
                    held.clear()
                    state.update(node=node[start], n=0, large=False)
                    if end - start == 1 and end < len(node):
                        state["n"] = 1
                        continue  # alone in its node
                state["n"] += end - start
                if state["large"] or state["n"] > SMALL:
                    if not state["large"]:
                        for k, _, _, p in held:
                            out += large(k, int(node[start]), depth, p)
                        held.clear()
                        state["large"] = True
                    out += large(keys[start:end], int(node[start]), depth, paths[start:end])
                else:
                    held.append((keys[start:end], bits[start:end], sizes[start:end], paths[start:end]))
            if out:
                yield _found(schema, out)
        if out := close():
            yield _found(schema, out)
        give_back()

    return nodes.repartition(F.col("node")).sortWithinPartitions("node", "key").mapInArrow(run, _FOUND)


_MARKED = "a binary, b binary, node long, depth int, path long, key binary, n_shingles long, bits binary, label int"


def _pivots(large: DataFrame) -> DataFrame:
    """Of each node its number of rows n and at most PIVOTS of its classes, those with the smallest keys of as many parts."""
    part, one = F.pmod(F.xxhash64("key"), F.lit(PIVOTS)), F.struct("key", "n_shingles", "bits")
    least = F.array(*(F.min(F.when(part == i, one)) for i in range(PIVOTS)))
    return large.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.array_compact(least)).alias("pivots"))


def _meet_pivots(large: DataFrame, pivots: DataFrame, total: int) -> DataFrame:
    """Compares all classes of large nodes with their node's pivots.

    Rows (a, b) of what hangs together, and each class again with its label: the first pivot that
    it is like, null if none.
    """
    schema = arrow_schema(_MARKED)
    rows = attach(large, pivots, ["node"], "n", total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            node, sizes = (batch.column(c).to_numpy() for c in ("node", "n_shingles"))
            keys = batch.column("key").to_pylist()
            bits = _matrix(batch.column("bits"), np.uint64, SKETCH_BITS // 64)
            label: list[int | None] = [None] * len(keys)
            out = []
            for value in np.unique(node):
                here = np.flatnonzero(node == value)
                pivots = batch.column("pivots")[int(here[0])].as_py()
                their_bits = np.frombuffer(b"".join(p["bits"] for p in pivots), np.uint64).reshape(len(pivots), -1)
                like = _alike(bits[here], sizes[here], their_bits, np.array([p["n_shingles"] for p in pivots]))
                first = like.argmax(axis=1)
                root = np.arange(len(pivots))
                for k, row in enumerate(here.tolist()):
                    if like[k, first[k]]:
                        label[row] = int(first[k])
                        if keys[row] != pivots[first[k]]["key"]:
                            out.append((keys[row], pivots[first[k]]["key"], *[None] * 7))
                i, j = np.nonzero(like)
                _union(root, first[i], j)
                out += [(pivots[k]["key"], pivots[r]["key"], *[None] * 7) for k, r in enumerate(_flat(root)) if k != r]
            if out:
                yield _found(schema, out)
            empty = pa.nulls(len(keys), pa.binary())
            columns = [empty, empty, *(batch.column(c) for c in ("node", "depth", "path", "key", "n_shingles", "bits")), pa.array(label, pa.int32())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.select("node", "depth", "path", "key", "n_shingles", "bits", "pivots").mapInArrow(run, _MARKED)


def _deal(rows: DataFrame, group: str, asks: Column) -> DataFrame:
    """Deals groups to tasks: rows that ask (in nq pieces) meet all rows (in nb pieces), each pair of pieces once."""
    h = F.xxhash64("key")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own_q, own_b = (F.pmod(h, F.col(n)).cast("int") for n in ("nq", "nb"))
    task = lambda i, j, first: F.struct(i.alias("i"), j.alias("j"), F.lit(first).alias("asks"))
    base = F.transform(every("nq"), lambda i: task(i, own_b, False))
    ask = F.when(asks, F.transform(every("nb"), lambda j: task(own_q, j, True))).otherwise(F.array().cast("array<struct<i:int,j:int,asks:boolean>>"))
    return rows.withColumn("t", F.explode(F.concat(base, ask))).withColumn("task", F.xxhash64(group, "t.i", "t.j")).withColumn("asks", F.col("t.asks"))


def _meet_all(dealt: DataFrame) -> DataFrame:
    """Compares by sketch, within each task of rows (task, asks, key, n_shingles, bits), those that ask with the others."""
    schema = arrow_schema("a binary, b binary")

    def scan(asks: list[bool], keys: list[bytes], sizes: list[int], bits: list[bytes]) -> list[tuple]:
        x, n = np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1), np.array(sizes)
        first, second = (np.flatnonzero(np.array(asks) == want) for want in (True, False))
        root = np.arange(len(keys))
        step = max(1, (1 << 21) // max(1, len(second)))
        for at in range(0, len(first), step):
            part = first[at : at + step]
            i, j = np.nonzero(_alike(x[part], n[part], x[second], n[second]))
            _union(root, part[i], second[j])
        # A class that asks stands among the others of some task as well, under the same key.
        return [(keys[i], keys[r]) for i, r in enumerate(_flat(root)) if keys[i] != keys[r]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []
        for batch in batches:
            out: list[tuple] = []
            for t, *row in zip(*(batch.column(c).to_pylist() for c in ("task", "asks", "key", "n_shingles", "bits")), strict=True):
                if t != task:
                    out += scan(*zip(*held, strict=True)) if held else []
                    task, held = t, []
                held.append(row)
            if out:
                yield _found(schema, out)
        if held and (out := scan(*zip(*held, strict=True))):
            yield _found(schema, out)
        give_back()

    return dealt.select("task", "asks", "key", "n_shingles", "bits").repartition(F.col("task")).sortWithinPartitions("task", "key").mapInArrow(run, "a binary, b binary")


def _found(schema, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def candidates(classes: DataFrame, shelf: Shelf) -> DataFrame:
    """Pairs (a, b) of class keys such that all linkable classes hang together through them."""
    edges, nodes = [], _roots(classes)
    for depth in range(1, DEPTH + 1):
        hot = _hot_nodes(nodes, shelf, depth)
        found = cut(_compare(nodes if hot is None else nodes.join(hot, "node", "left_anti")))
        edges.append(found.where(F.col("b").isNotNull()).select("a", "b"))
        more = found.where(F.col("b").isNull()).select(F.col("a").alias("key"), "node", "depth", "path")
        if hot is not None:
            more = more.unionByName(nodes.join(hot, "node").select("key", "node", "depth", "path"))
        large = cut(more.join(classes.select("key", "n_shingles", "bits"), "key"))
        pivots = shelf.put(_pivots(large), f"pivots-{depth}")
        total = pivots.agg(F.sum("n")).first()[0]
        if not total:
            break
        marked = shelf.put(_meet_pivots(large, pivots, total), f"marked-{depth}")
        edges.append(marked.where(F.col("b").isNotNull()).select("a", "b"))
        marked = marked.where(F.col("key").isNotNull()).drop("a", "b")
        # Those with the commonest label hang together; the rest of the node asks.
        best = cut(_commonest(marked, "node", F.count(F.lit(1)).alias("n")).withColumn("rest", F.col("n") - F.col("most")).where("rest > 0"))
        done = F.lit(depth == DEPTH) | (F.col("rest") * F.col("n") <= PAIRS)
        pieces = best.where(done).select("node", "n", "common", F.ceil(F.col("n") / BASES).cast("int").alias("nb"), F.ceil(F.col("rest") / BASES).cast("int").alias("nq"))
        rows = attach(marked, pieces, ["node"], "n", total)
        edges.append(cut(_meet_all(_deal(rows, "node", ~F.coalesce(F.col("label") == F.col("common"), F.lit(False))))))
        split = best.where(~done).select("node", "n")
        if split.isEmpty():
            break
        nodes = shelf.put(_branches(attach(marked, split, ["node"], "n", total), classes), f"nodes-{depth + 1}")
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def _commonest(rows: DataFrame, group: str, *more: Column) -> DataFrame:
    """Of each group the commonest label (0 to PIVOTS - 1) as common, null where no row has one, and how many rows have it, as most."""
    counts = F.array(*(F.struct(F.count_if(F.col("label") == i).alias("most"), F.lit(-i).alias("label")) for i in range(PIVOTS)))
    out = rows.groupBy(group).agg(F.array_max(counts).alias("best"), *more)
    return out.withColumn("common", F.when(F.col("best.most") > 0, -F.col("best.label"))).withColumn("most", F.col("best.most")).drop("best")


def _hot_nodes(nodes: DataFrame, shelf: Shelf, depth: int) -> DataFrame | None:
    """The nodes with more than SMALL rows and more than one in HOT of all rows, so fewer than HOT; None if there is none."""
    sizes = shelf.put(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"sizes-{depth}")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = sizes.where(F.col("n") > max(SMALL, total // HOT)).select("node")
    return None if hot.isEmpty() else F.broadcast(hot)


def common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of a with each of b, summed over blocks of shared shingles."""
    every = np.concatenate([*a, *b])
    values, counts = np.unique(every, return_counts=True)
    shared = values[counts > 1]
    out = np.zeros((len(a), len(b)), np.float32)
    rows = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (a, b)]
    flat = [np.concatenate(s) if s else np.zeros(0, np.uint64) for s in (a, b)]
    place = [np.searchsorted(shared, f) for f in flat]
    kept = [(p < len(shared)) & (shared[np.minimum(p, len(shared) - 1)] == f) if len(shared) else np.zeros(len(f), bool) for p, f in zip(place, flat, strict=True)]
    place, rows = [p[k] for p, k in zip(place, kept, strict=True)], [r[k] for r, k in zip(rows, kept, strict=True)]
    for at in range(0, len(shared), SHARED_BLOCK):
        width = min(SHARED_BLOCK, len(shared) - at)
        blocks = []
        for p, r, s in zip(place, rows, (a, b), strict=True):
            here = (p >= at) & (p < at + width)
            m = np.zeros((len(s), width), np.float32)
            m[r[here], p[here] - at] = 1
            blocks.append(m)
        out += blocks[0] @ blocks[1].T
    return out.astype(np.int64)


def linked(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    both = common(a, b)
    union = np.array([len(x) for x in a])[:, None] + np.array([len(x) for x in b])[None, :] - both
    return 100 * both >= 80 * union


def _confirm(gathered: DataFrame) -> DataFrame:
    """Exact links, as stars, within each task of rows (task, asks, key, set): of those that ask with the others; if none asks, of all."""
    schema = arrow_schema("a binary, b binary")

    def decide(asks: list[bool], keys: list[bytes], sets: list[np.ndarray]) -> list[tuple]:
        first, second = (np.flatnonzero(np.array(asks) == want) for want in (True, False))
        if not len(first):
            first = second
        root = np.arange(len(keys))
        size = max(1, (64 << 20) // (4 * max(SHARED_BLOCK, len(second))))
        for at in range(0, len(first), size):
            rows = first[at : at + size]
            i, j = np.nonzero(linked([sets[k] for k in rows], [sets[k] for k in second]))
            _union(root, rows[i], second[j])
        return [(keys[i], keys[r]) for i, r in enumerate(_flat(root)) if keys[i] != keys[r]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, asks, keys, sets = None, [], [], []
        for batch in (part for whole in batches for part in slices(whole)):
            out: list[tuple] = []
            for t, m, k, s in zip(*(batch.column(c).to_pylist() for c in ("task", "asks", "key", "set")), strict=True):
                if t != task:
                    out += decide(asks, keys, sets) if len(keys) > 1 else []
                    task, asks, keys, sets = t, [], [], []
                asks.append(m)
                keys.append(k)
                sets.append(np.frombuffer(s, np.uint64))
            if out:
                yield _found(schema, out)
        if len(keys) > 1 and (out := decide(asks, keys, sets)):
            yield _found(schema, out)
        give_back()

    return gathered.select("task", "asks", "key", "set").repartition(F.col("task")).sortWithinPartitions("task", "key").mapInArrow(run, "a binary, b binary")


def _sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """The full sets of the members (key, root, nb, doc_id, mark), which are few among all documents.

    Only texts that a sieve of the members' marks lets pass are moved.  Rows that repeat doc_id and
    text stand side by side behind the join and give one set; should the planner part them, a
    set that comes twice links with itself.
    """
    passes = sieve(members.select("mark"))
    wanted = members.select("key", "root", "nb", F.col("doc_id").alias("of"), F.col("mark").alias("its"))
    texts_ = docs.select("doc_id", mark().alias("mark"), "text").where(passes("mark"))
    rows = texts_.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("its"))).select("key", "root", "nb", "text")
    schema = arrow_schema("key binary, root binary, nb int, set binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in (part for whole in batches for part in slices(whole)):
            keys = batch.column("key").to_pylist()
            new = [k != before for k, before in zip(keys, [last, *keys[:-1]], strict=True)]
            last = keys[-1]
            batch = batch.filter(pa.array(new, pa.bool_()))
            sets = pa.array([shingles(t, words).tobytes() for t in texts(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("root"), batch.column("nb"), sets], schema=schema)
        give_back()

    return rows.mapInArrow(run, "key binary, root binary, nb int, set binary")


def links(docs: DataFrame, classes: DataFrame, words: int, shelf: Shelf) -> DataFrame:
    """Confirmed links between class keys, as stars."""
    groups = components(candidates(classes, shelf))
    cost = F.col("n_shingles") + DOCUMENT
    members = shelf.put(groups.join(classes.select(F.col("key").alias("node"), "doc_id", "mark", cost.alias("cost")), "node").withColumnRenamed("node", "key"), "grouped")
    sizes = cut(members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.sum("cost") / PIECE).cast("int").alias("nb")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    members = shelf.put(attach(members, sizes, ["root"], "n", total).drop("n"), "members")
    sets = shelf.put(_sets(docs, members, words), "sets")
    small = cut(_confirm(sets.where("nb = 1").select(F.xxhash64("root").alias("task"), F.lit(False).alias("asks"), "key", "set")))
    large = sets.where("nb > 1")
    if sizes.where("nb > 1").isEmpty():
        return small
    # Every class meets the pivots of its group, which go to all pieces of it.
    spread = members.where("nb > 1")
    part = F.pmod(F.xxhash64("key"), F.lit(PIVOTS))
    pivots = spread.groupBy("root").agg(F.array_sort(F.array_compact(F.array(*(F.min(F.when(part == i, F.col("key"))) for i in range(PIVOTS))))).alias("pivots"))
    pivots = shelf.put(pivots.select("root", F.posexplode("pivots").alias("label", "key")), "pivots")
    asking = large.join(pivots.select("key", "label"), "key").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    own = F.pmod(F.xxhash64("key"), F.col("nb")).cast("int")
    task, none = F.xxhash64("root", "piece").alias("task"), F.lit(None).cast("int").alias("label")
    met = asking.select(task, "label", "key", "set").unionByName(large.withColumn("piece", own).select(task, none, "key", "set"))
    met = shelf.put(_spine(met), "spine")
    spine = met.where("b IS NOT NULL").select("a", "b")
    # What is not linked with the pivot that most are linked with meets all of the group.
    labelled = spread.select("key", "root", "cost").join(met.select(F.col("a").alias("key"), "label").where("label IS NOT NULL"), "key", "left")
    labelled = shelf.put(labelled, "labelled")
    best = _commonest(labelled, "root", F.count(F.lit(1)).alias("n"))
    best = shelf.put(attach(labelled, best, ["root"], "n", total), "best")
    asks = ~F.coalesce(F.col("label") == F.col("common"), F.lit(False))
    pieces = best.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.sum("cost") / PIECE).cast("int").alias("nb"), F.ceil(F.sum(F.when(asks, F.col("cost"))) / PIECE).cast("int").alias("nq"))
    pieces = cut(pieces.where("nq > 0"))
    if pieces.isEmpty():
        return small.unionByName(spine)
    asked = attach(best.select("key", "root", asks.alias("rest")), pieces, ["root"], "n", total)
    dealt = _deal(large.select("key", "set").join(asked, "key"), "root", F.col("rest"))
    return small.unionByName(spine).unionByName(cut(_confirm(dealt)))


def _spine(met: DataFrame) -> DataFrame:
    """Exact links with pivots, within each task of rows (task, label, key, set), where label is null but for pivots.

    Rows (a, b, label) of a class a, the first pivot b that it is linked with (null if it is that pivot) and its
    label; and, label null, of pivots that hang together.
    """
    schema = arrow_schema("a binary, b binary, label int")

    def decide(labels: list[int | None], keys: list[bytes], sets: list[np.ndarray]) -> list[tuple]:
        pivots = sorted((i for i, x in enumerate(labels) if x is not None), key=labels.__getitem__)
        rest = [i for i, x in enumerate(labels) if x is None]
        if not rest:
            return []
        like = linked([sets[i] for i in rest], [sets[i] for i in pivots])
        first, root = like.argmax(axis=1), np.arange(len(pivots))
        out = []
        for k in np.flatnonzero(like.any(axis=1)).tolist():
            p = pivots[first[k]]
            out.append((keys[rest[k]], keys[p] if keys[p] != keys[rest[k]] else None, labels[p]))
        i, j = np.nonzero(like)
        _union(root, first[i], j)
        return out + [(keys[pivots[k]], keys[pivots[r]], None) for k, r in enumerate(_flat(root)) if k != r]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []
        for batch in (part for whole in batches for part in slices(whole)):
            out: list[tuple] = []
            for t, label, key, s in zip(*(batch.column(c).to_pylist() for c in ("task", "label", "key", "set")), strict=True):
                if t != task:
                    out += decide(*zip(*held, strict=True)) if held else []
                    task, held = t, []
                held.append((label, key, np.frombuffer(s, np.uint64)))
            if out:
                yield _found(schema, out)
        if held and (out := decide(*zip(*held, strict=True))):
            yield _found(schema, out)
        give_back()

    return met.repartition(F.col("task")).sortWithinPartitions("task", "key").mapInArrow(run, "a binary, b binary, label int")


def _grouped(docs: DataFrame, words: int) -> tuple[Shelf, DataFrame, DataFrame, int]:
    """All rows' profiles; and per class the smallest (null ids last) doc_id and mark of its component, with the class's size."""
    shelf = Shelf(docs.sparkSession, "neardup")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = shelf.put(profiles(docs, words), "profiles")
    light = rows.where(F.col("key").isNotNull())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first")
    firsts = light.groupBy("key").agg(first, F.count(F.lit(1)).alias("many"), F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"), F.first("bits").alias("bits"))
    classes = shelf.put(firsts.select("key", "first", "first.doc_id", "first.mark", "many", "n_shingles", "tokens", "bits"), "classes")
    roots = components(links(docs, classes, words, shelf))
    labels = shelf.put(classes.select("key", "first", "many").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key")), "labels")
    least = labels.groupBy("root").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("n"))
    total = max(1, labels.count())
    found = shelf.put(attach(labels, least, ["root"], "n", total).select("key", "many", "least"), "found")
    return shelf, rows, found, light.count()


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    _, rows, found, total = _grouped(docs, words)
    out = attach(rows.select("doc_id", "n_shingles", "key"), found, ["key"], "many", total, "left")
    component = F.coalesce("least.doc_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def deduplicated(docs: DataFrame, words: int = 5) -> DataFrame:
    """One document of each group of near-duplicates, with the columns of docs.

    The document with the smallest doc_id stays (null last; of different texts with that id one,
    of rows that repeat it one).  Texts without a word are in no group, so all such rows stay.
    """
    shelf, rows, found, total = _grouped(docs, words)
    rows = attach(rows.where(F.col("key").isNotNull()).select("doc_id", "mark", "key"), found, ["key"], "many", total)
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("mark") == F.col("least.mark"))
    gone = shelf.put(rows.where(~stays).select(F.col("doc_id").alias("of"), F.col("mark").alias("its")).distinct(), "gone")
    again = shelf.put(rows.where(stays).groupBy(F.col("doc_id").alias("of"), F.col("mark").alias("its")).count().where("count > 1").drop("count"), "again")
    whole = docs.select(F.col("doc_id").cast("long").alias("id"), mark().alias("mark"), F.struct(*docs.columns).alias("row"))
    same = lambda other: F.col("id").eqNullSafe(other["of"]) & (F.col("mark") == other["its"])
    # Only what a sieve lets pass is moved; the rest has no copy that comes before it.
    passes = sieve(gone.select("its").unionByName(again.select("its")))
    asked = whole.where(passes("mark")).join(gone.hint("merge"), same(gone), "left_anti")
    if not again.isEmpty():
        once = asked.join(again.hint("merge"), same(again), "left_semi").dropDuplicates(["id", "mark"])
        asked = asked.join(again.hint("merge"), same(again), "left_anti").unionByName(once)
    return whole.where(~passes("mark")).unionByName(asked).select("row.*")
