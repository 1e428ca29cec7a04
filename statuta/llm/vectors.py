"""Near-duplicate embeddings by product quantisation.

Vectors of one label and dimension are compared.  A coarse quantiser and residual codebooks of
SUBSPACES times CODES entries are fitted on a bounded sample (SAMPLE vectors, by hash).  The
quantiser has about LISTS_PER_ROOT times the square root of the number of vectors as lists, at most
MOST_LISTS; for each label they are cut into groups of neighbours of about WHOLE vectors.  Every vector is put in the list of its nearest centroid with
its residual code and the length of what the code leaves over.  A vector searches every list that
can hold a vector within the radius of the threshold: one whose bisecting plane with its own
centroid is no farther than the radius.  It goes once to every group with such a list.  Table look-ups
give the distance to each code; with the left over length as slack the triangle inequality rules
out pairs without losing any, and the exact cosine in double precision decides the rest.  So recall
is 1 up to rounding.

Equal vectors of a label are one class with a count.  Groups are searched in pieces of at most
BASES stored and QUERIES searching vectors, so a hot group is spread over many tasks, and tasks
report counts and stars of links, never all pairs.

Vectors that are null, empty, zero, or hold null or non-finite components, and those without a
label, link with nothing.  Repeated rows are vectors of their own, also with one vec_id.  A very
long vector is one row's matter.  Extra columns, whatever their names, are ignored.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.llm.common import Shelf, arrow_schema, attach, cut, slices
from statuta.llm.components import components

COSINE = 0.98
SAMPLE = 8192
LISTS_PER_ROOT = 2.0
MOST_LISTS = 1024
WHOLE = 8192
SUBSPACES = 16
CODES = 64
ROUNDS = 6
BASES = 8192
QUERIES = 16384
SLACK = 1e-5
BLOCK = 1 << 22


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        near = _squared(x, centres).argmin(axis=1)
        counts = np.bincount(near, minlength=len(centres))
        order = np.argsort(near, kind="stable")
        found, starts = np.unique(near[order], return_index=True)
        sums = np.zeros_like(centres)
        sums[found] = np.add.reduceat(x[order], starts, axis=0)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T, 0)


class Index:
    """The quantisers of one dimension; fitted on unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 9):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.cuts = np.linspace(0, self.dim, min(SUBSPACES, self.dim) + 1).astype(int)
        self.centres = _kmeans(sample, lists, rng)
        rest = sample - self.centres[_squared(sample, self.centres).argmin(axis=1)]
        self.books = [_kmeans(rest[:, a:b], CODES, rng) for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True)]
        self.apart = np.sqrt(_squared(self.centres, self.centres))
        # Lists in an order in which neighbours mostly stand together, to be cut into groups.
        near = _squared(self.centres, _kmeans(self.centres, math.ceil(math.sqrt(len(self.centres))), rng)).argmin(axis=1)
        self.rank = np.argsort(np.argsort(near, kind="stable"))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, code, left-over length, and the part of a distance that is the coded vector's alone, of unit vectors."""
        where = _squared(x, self.centres).argmin(axis=1)
        centre = self.centres[where]
        rest = x - centre
        codes = np.empty((len(x), len(self.books)), np.uint8)
        left, own = np.zeros(len(x)), np.zeros(len(x))
        for m, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            codes[:, m] = _squared(rest[:, a:b], self.books[m]).argmin(axis=1)
            said = self.books[m][codes[:, m]]
            left += ((rest[:, a:b] - said) ** 2).sum(axis=1)
            own += (said * said).sum(axis=1) + 2 * (said * centre[:, a:b]).sum(axis=1)
        return where, codes, np.sqrt(left), own

    def probes(self, x: np.ndarray, radius: float) -> np.ndarray:
        """Which lists (rows: vectors) may hold a vector within the radius."""
        d = _squared(x, self.centres)
        own = d.argmin(axis=1)
        beyond = d - d[np.arange(len(x)), own][:, None]
        return beyond <= 2 * (radius + SLACK) * self.apart[own] + SLACK

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Twice the products of queries with every entry of the codebooks (queries, subspaces, CODES).

        The squared distance to a coded vector is that to its list's centroid, plus the vector's
        own part, less one entry for each subspace.
        """
        out = np.zeros((len(queries), len(self.books), CODES), np.float32)
        for m, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:], strict=True)):
            out[:, m, : len(self.books[m])] = 2 * queries[:, a:b] @ self.books[m].T
        return out


_CLASS = "vec_id long, key binary, label string, dim int, raw binary"


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors in double precision from stored components, which are 4 or 8 bytes each."""
    kind = np.float32 if len(raw[0]) == 4 * dim else np.float64
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _classes(vectors: DataFrame) -> DataFrame:
    """Per row its vec_id; for vectors that can link also the key of its class and its components as stored."""
    schema = arrow_schema(_CLASS)
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = np.float32 if single else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            out = []
            for vec_id, values, label in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "embedding", "label")), strict=True):
                row = (vec_id, None, None, None, None)
                if values and label is not None and None not in values:
                    x = np.array(values, kind)
                    if np.isfinite(x).all() and x.any():
                        raw = x.tobytes()
                        key = blake2b(f"{label}:{len(x)}:".encode() + _unit([raw], len(x)).tobytes(), digest_size=16).digest()
                        row = (vec_id, key, label, len(x), raw)
                out.append(row)
            yield _table(schema, out)

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>" if single else "array<double>"), F.col("label").cast("string"))
    return rows.mapInArrow(run, _CLASS)


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    # Structs are given as tuples in their fields' order.
    return pa.RecordBatch.from_arrays([_column(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _column(values, kind: pa.DataType) -> pa.Array:
    if pa.types.is_list(kind) and pa.types.is_struct(kind.value_type):
        names = [f.name for f in kind.value_type]
        values = [[dict(zip(names, x, strict=True)) for x in v] for v in values]
    return pa.array(values, type=kind)


def fit(classes: DataFrame) -> dict[int, Index]:
    """An index for each dimension found in a sample of SAMPLE classes, chosen by hash."""
    lists = min(MOST_LISTS, math.ceil(LISTS_PER_ROOT * math.sqrt(classes.count())))
    rows = classes.select("key", "dim", "raw").orderBy(F.xxhash64("key")).limit(SAMPLE).collect()
    by_dim: dict[int, list[bytes]] = {}
    for r in rows:
        by_dim.setdefault(r["dim"], []).append(bytes(r["raw"]))
    return {d: Index(_unit(x, d), lists) for d, x in by_dim.items()}


_INDEXED = "label string, dim int, key binary, many long, raw binary, group int, list int, code binary, left_over double, own double, lists binary, probes array<struct<group: int, lists: binary>>"


def _index(classes: DataFrame, shared, radius: float) -> DataFrame:
    """Each class with its place in the index, the lists that it searches in its own group, and those in others."""
    schema = arrow_schema(_INDEXED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                rows = list(zip(*(part.column(c).to_pylist() for c in ("label", "dim", "key", "many", "raw")), strict=True))
                pieces = part.column("pieces").to_numpy()
                out = []
                for dim in {r[1] for r in rows}:
                    mine = [k for k, r in enumerate(rows) if r[1] == dim]
                    here = [rows[k] for k in mine]
                    index = shared.value.get(dim)
                    if index is None:  # a dimension that the sample lacks: one list, searched exactly
                        out += [(*r, 0, 0, None, None, None, b"", []) for r in here]
                        continue
                    x = _unit([r[4] for r in here], dim)
                    where, codes, left, own = index.encode(x)
                    probes, n = index.probes(x, radius), len(index.centres)
                    for i, r in enumerate(here):
                        lists = np.flatnonzero(probes[i]).astype(np.uint16)
                        groups = index.rank[lists] * min(n, pieces[mine[i]]) // n
                        group = int(index.rank[where[i]] * min(n, pieces[mine[i]]) // n)
                        asked = [(int(g), lists[groups == g].tobytes()) for g in np.unique(groups) if g != group] if pieces[mine[i]] > 1 else []
                        out.append((*r, group, int(where[i]), codes[i].tobytes(), float(left[i]), float(own[i]), lists[groups == group].tobytes(), asked))
                yield _table(schema, out)

    return classes.select("label", "dim", "key", "many", "raw", "pieces").mapInArrow(run, _INDEXED)


def _place(index: DataFrame) -> DataFrame:
    """Each class in the group of its list, where it is stored and searches, and in every other group with a list that it searches."""
    rows = ("label", "dim", "key", "many", "raw")
    stored = index.select(*rows, "group", F.lit(True).alias("stored"), "lists", "list", "code", "left_over", "own")
    asked = index.select(*rows, F.explode("probes").alias("p"))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return stored.unionByName(asked.select(*rows, "p.group", F.lit(False).alias("stored"), "p.lists", none("int", "list"), none("binary", "code"), none("double", "left_over"), none("double", "own")))


def _near(index: Index | None, x: np.ndarray, probed: list[np.ndarray], base: dict[str, np.ndarray], radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, stored) that table look-ups cannot rule out."""
    if index is None:
        return np.nonzero(np.ones((len(x), len(base["list"])), bool))
    tables = index.tables(x)
    limit = (radius + base["left"] + SLACK) ** 2 + SLACK
    flat = np.concatenate(probed)
    of = np.repeat(np.arange(len(x)), [len(p) for p in probed])
    found = []
    for lst in np.unique(flat):
        q, y = of[flat == lst], np.flatnonzero(base["list"] == lst)
        if not len(y):
            continue
        far = _squared(x[q], index.centres[lst][None, :]).astype(np.float32) + base["own"][y].astype(np.float32)[None, :]
        for m in range(tables.shape[1]):
            far -= tables[q, m][:, base["codes"][y, m]]
        i, j = np.nonzero(far <= limit[y].astype(np.float32))
        found.append((q[i], y[j]))
    return tuple(np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))


def _search(placed: DataFrame, shared, cosine: float, radius: float) -> DataFrame:
    """Rows (key, n, other): n more vectors linked to key; or, n null, a star of links between classes."""
    ddl = "key binary, n long, other binary"
    schema = arrow_schema(ddl)

    def scan(rows: list[tuple], dim: int) -> list[tuple]:
        index = shared.value.get(dim)
        stored, queries = [r for r in rows if r[0]], [r[2:] for r in rows if r[1]]
        stored = [r[2:] for r in stored]
        if not stored or not queries:
            return []
        y = _unit([r[1] for r in stored], dim)
        many = np.array([r[2] for r in stored], np.int64)
        _, names = np.unique(np.array([r[0].hex() for r in stored] + [r[0].hex() for r in queries]), return_inverse=True)
        base = {"list": np.zeros(len(stored), np.int64)}
        if index is not None:
            base = {
                "list": np.array([r[4] for r in stored]), "codes": np.frombuffer(b"".join(r[5] for r in stored), np.uint8).reshape(len(stored), -1),
                "left": np.array([r[6] for r in stored]), "own": np.array([r[7] for r in stored]),
            }
        out, pairs = [], []
        step = max(1, BLOCK // max(len(stored), SUBSPACES * CODES))
        for at in range(0, len(queries), step):
            part = queries[at : at + step]
            x = _unit([r[1] for r in part], dim)
            i, j = _near(index, x, [np.frombuffer(r[3] or b"", np.uint16) for r in part], base, radius)
            keep = np.zeros(len(i), bool)
            for k in range(0, len(i), max(1, BLOCK // dim)):
                s = slice(k, k + max(1, BLOCK // dim))
                keep[s] = np.einsum("ij,ij->i", x[i[s]], y[j[s]]) >= cosine
            i, j = i[keep], j[keep]
            other = names[len(stored) + at + i] != names[j]
            i, j = i[other], j[other]
            n = np.bincount(i, weights=many[j], minlength=len(part)).astype(np.int64)
            out += [(part[k][0], int(n[k]), None) for k in np.flatnonzero(n)]
            if len(i):
                # What hangs together is kept as stars between steps.
                pairs.append(_stars(names[len(stored) + at + i], names[j]))
        if pairs:
            by_name = {int(n): k for n, k in zip(names, [r[0] for r in stored] + [r[0] for r in queries], strict=True)}
            a, b = _stars(*np.concatenate(pairs, axis=1))
            out += [(by_name[p], None, by_name[q]) for p, q in zip(a.tolist(), b.tolist(), strict=True)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, of = None, [], 0
        for batch in batches:
            out: list[tuple] = []
            for t, dim, *row in zip(*(batch.column(c).to_pylist() for c in ("task", "dim", "stands", "asks", "key", "raw", "many", "lists", "list", "code", "left_over", "own")), strict=True):
                if t != task:
                    out += scan(held, of)
                    task, held, of = t, [], dim
                held.append(tuple(row))
            if out:
                yield _table(schema, out)
        if out := scan(held, of):
            yield _table(schema, out)

    return placed.repartition(F.col("task")).sortWithinPartitions("task").mapInArrow(run, ddl)


def _stars(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edges between numbers as edges to the smallest of each component."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(values))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    far = np.flatnonzero(root != np.arange(len(root)))
    return np.stack([values[far], values[root[far]]])


def _pieces(placed: DataFrame, shelf: Shelf) -> DataFrame:
    """Deals each group's stored and searching classes to tasks of bounded size, each pair of pieces once."""
    of = ["label", "dim", "group"]
    sizes = placed.groupBy(*of).agg(F.count(F.lit(1)).alias("n"), F.count_if("stored").alias("b")).where("b > 0")
    sizes = shelf.put(sizes.select(*of, "n", F.ceil(F.col("b") / BASES).cast("int").alias("nb"), F.ceil(F.col("n") / QUERIES).cast("int").alias("nq")), "groups")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    rows = attach(placed, sizes, of, "n", total)
    h = F.xxhash64("key")
    own_i, own_j = (F.pmod(h, F.col(n)).cast("int") for n in ("nq", "nb"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    task = lambda i, j, stands, asks: F.struct(i.alias("i"), j.alias("j"), stands.alias("stands"), asks.alias("asks"))
    # A stored class stands in its piece for all who ask, and asks in all pieces.
    standing = F.transform(every("nq"), lambda i: task(i, own_j, F.lit(True), i == own_i))
    asking = F.transform(every("nb"), lambda j: task(own_i, j, F.lit(False), F.lit(True)))
    to = F.when(F.col("stored"), F.concat(standing, F.filter(asking, lambda t: t["j"] != own_j))).otherwise(asking)
    rows = rows.withColumn("t", F.explode(to))
    return rows.select(F.xxhash64(*of, "t.i", "t.j").alias("task"), "dim", "t.stands", "t.asks", "key", "raw", "many", "lists", "list", "code", "left_over", "own")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    radius = float(np.sqrt(2 - 2 * cosine))
    shelf = Shelf(vectors.sparkSession, "vectors")
    rows = cut(_classes(vectors))
    light = rows.where(F.col("key").isNotNull())
    classes = cut(light.groupBy("key").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("many"), F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("raw").alias("raw")))
    shared = vectors.sparkSession.sparkContext.broadcast(fit(classes))  # bounded by MOST_LISTS, CODES and the sample's dimensions
    labels = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    labels = cut(labels.withColumn("pieces", F.ceil(F.col("n") / WHOLE).cast("int")))
    total = labels.agg(F.sum("n")).first()[0] or 0
    index = shelf.put(_index(attach(classes, labels, ["label", "dim"], "n", total), shared, radius), "index")
    found = cut(_search(_pieces(_place(index), shelf), shared, cosine, radius))
    counts = found.where(F.col("n").isNotNull()).groupBy("key").agg(F.sum("n").alias("n"))
    roots = components(found.where(F.col("other").isNotNull()).select(F.col("key").alias("a"), F.col("other").alias("b")))
    labels = shelf.put(classes.select("key", "vec_id", "many").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key")), "labels")
    least = labels.groupBy("root").agg(F.min("vec_id").alias("component_id"), F.count(F.lit(1)).alias("size"))
    full = attach(labels, least, ["root"], "size", max(1, labels.count())).join(counts, "key", "left")
    full = shelf.put(full.select("key", "many", "component_id", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links")), "full")
    out = attach(rows.select("vec_id", "key"), full, ["key"], "many", light.count(), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
