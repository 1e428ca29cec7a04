"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_ROWS = 256
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a fresh local one only where that is unset and Spark runs in one process."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = tempfile.mkdtemp(prefix="statuta-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(known)
    return known


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage of df by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Shelf:
    """Tables in the shared folder that a query needs on its way.

    ``clear`` removes those that nothing reads any more; the others go when the driver's JVM ends,
    as results are read lazily.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at = spark, f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.at}/{name}" if name else self.at)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and gives it back as read: its lineage is cut, and its size known to the planner."""
        df.write.parquet(f"{self.at}/{name}")
        path, files = self._path("")
        files.deleteOnExit(path)
        return self.spark.read.parquet(f"{self.at}/{name}")

    def clear(self, *names: str) -> None:
        for name in names:
            path, files = self._path(name)
            files.delete(path, True)


#: A key is hot if it holds more than one in HOT rows; so there are fewer than HOT hot keys, however many rows there are.
HOT = 1000


def attach(rows: DataFrame, summary: DataFrame, keys: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """Joins rows with a summary of one row per key, whatever the keys' sizes.

    count: the summary's column with the number of rows that a key has; total: their sum at least.
    The fewer than HOT keys with more than total / HOT rows are joined by broadcast, the others by
    a shuffle in which no key has more than that.  Null keys match nothing.
    """
    bound = max(1, total // HOT)
    hot = F.broadcast(summary.where(F.col(count) > bound))
    light = summary.where(F.col(count) <= bound)
    rest = rows.join(hot.select(*keys), keys, "left_anti")
    return rows.join(hot, keys).unionByName(rest.join(light, keys, how))


#: Bits of a sieve, whatever it holds: 4 MB.
SIEVE_BITS = 1 << 25


def sieve(digests: DataFrame) -> Callable[[Column], Column]:
    """A test of 64-bit digests for a one-column table of them: true for all of these and few others.

    It is a Bloom filter of fixed size, put together by the tasks.  Where the table is so large
    that most bits are set it lets most digests pass, so what follows must decide exactly.
    """
    c = F.col(digests.columns[0])
    mask = F.lit(SIEVE_BITS - 1).cast("long")
    places = F.explode(F.array(*(F.shiftrightunsigned(c, shift).bitwiseAND(mask) for shift in _SHIFTS))).alias("place")
    words = digests.select(places).groupBy(F.shiftright("place", 6).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
    found = words.toArrow()  # at most SIEVE_BITS / 64 rows
    bits = np.zeros(SIEVE_BITS // 64, np.int64)
    bits[found["at"].to_numpy()] = found["bits"].to_numpy()
    shared = digests.sparkSession.sparkContext.broadcast(bits.tobytes())

    @F.arrow_udf("boolean")
    def passes(digest: pa.Array) -> pa.Array:
        words = np.frombuffer(shared.value, np.uint64)
        x = digest.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        out = np.ones(len(x), bool)
        for shift in _SHIFTS:
            at = (x >> np.uint64(shift)) & np.uint64(SIEVE_BITS - 1)
            out &= (words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return pa.array(out)

    return passes.asNondeterministic()  # so that it is not evaluated twice


_SHIFTS = (0, 19, 39)


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def crc(doc_id: Column) -> Column:
    """crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def _row_bytes(column: pa.Array) -> np.ndarray:
    """Bytes of each value of a column; nested ones by their own values, null as none."""
    kind = column.type
    if pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) or pa.types.is_large_binary(kind):
        return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        inner = np.concatenate([[0], np.cumsum(_row_bytes(column.flatten()))])
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        return inner[ends] - inner[ends - sizes]
    if pa.types.is_struct(kind):
        return sum((_row_bytes(x) for x in column.flatten()), np.zeros(len(column), np.int64))
    return np.full(len(column), column.nbytes // max(1, len(column)) + 1, np.int64)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most SLICE_ROWS rows and SLICE_BYTES bytes, by the rows' own sizes; a longer row is one alone."""
    upto = np.cumsum(sum((_row_bytes(c) for c in batch.columns), np.zeros(batch.num_rows, np.int64)))
    at = 0
    while at < batch.num_rows:
        before = upto[at - 1] if at else 0
        end = int(np.searchsorted(upto, before + SLICE_BYTES, side="right"))
        end = min(max(end, at + 1), at + SLICE_ROWS)
        yield batch.slice(at, end - at)
        at = end


#: What tasks keep between batches and can build again.
CACHES: list[Callable[[], None]] = []


def give_back() -> None:
    """At a task's end drops its caches and returns memory to the system, as workers live on for tasks of other kinds."""
    for clear in CACHES:
        clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only some C libraries can trim
        ctypes.CDLL(None).malloc_trim(0)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a schema; only the driver can parse it."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def map_slices(df: DataFrame, schema: str, step: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """Maps slices of Arrow batches to columns; the schema names them in order."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = step(part)
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
        give_back()

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """A text column as a list, null as the empty text."""
    return [x or "" for x in column.to_pylist()]
