"""Files that are read once: a ledger of what has been parsed, by path, size and content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.sources.scratch import hadoop

#: Files that a run opens by name; where more are new, all are read.
MOST = 10_000
LEDGER = "path string, length long, modified timestamp, digest string"


class Ledger:
    """A folder of numbered versions; each is a whole table of the files known, and the newest finished one counts.

    A version is written beside the others and renamed once it is whole, so a run that fails leaves
    the ledger as it was, and a reader sees one version or the next.
    """

    def __init__(self, spark: SparkSession, at: str):
        self.spark, self.at = spark, at.rstrip("/")

    def versions(self) -> list[int]:
        path, files = hadoop(self.spark, self.at)
        names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit())

    def known(self) -> DataFrame:
        found = self.versions()
        return self.spark.read.schema(LEDGER).parquet(f"{self.at}/v{found[-1]}") if found else self.spark.createDataFrame([], LEDGER)

    def _publish(self, rows: DataFrame) -> None:
        found = self.versions()
        number = found[-1] + 1 if found else 1
        (made, files), (to, _) = hadoop(self.spark, f"{self.at}/_made-v{number}"), hadoop(self.spark, f"{self.at}/v{number}")
        rows.write.mode("overwrite").parquet(f"{self.at}/_made-v{number}")
        if not files.rename(made, to):
            raise RuntimeError(f"version {number} was published by another run")
        for old in found[:-1]:
            files.delete(hadoop(self.spark, f"{self.at}/v{old}")[0], True)

    def update(self, root: str, take: Callable[[DataFrame], None], glob: str = "*.md") -> dict[str, int]:
        """Gives the new and changed files below root to take, as path and value, and then publishes what is there now.

        A file of the same path, size and time as before is not opened.  One whose time or size is
        another is read, and taken only if its content is.  take must be repeatable: it sees the same
        files again if a run ends before the ledger is published.  Returns how many files there are, were
        opened, and were taken, and how many are gone.
        """
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
        listed = files.select("path", "length", F.col("modificationTime").alias("modified"))
        known = self.known()
        opened = listed.join(known.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")
        paths = [r[0] for r in opened.select("path").limit(MOST + 1).collect()] if self.versions() else None
        if paths == []:
            some = files.where("false")
        elif paths is not None and len(paths) <= MOST:
            some = self.spark.read.format("binaryFile").load(paths)
        else:
            some = files.join(opened.select("path"), "path", "left_semi")
        read = some.select("path", "length", F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("digest"), F.col("content").cast("string").alias("value"))
        read = read.persist()
        try:
            fresh = read.join(known.select("path", "digest"), ["path", "digest"], "left_anti")
            counts = {"files": listed.count(), "opened": read.count(), "taken": fresh.count(), "gone": known.join(listed, "path", "left_anti").count()}
            if counts["taken"]:
                take(fresh.select("path", "value"))
            if counts["opened"] or counts["gone"]:
                same = known.join(listed, ["path", "length", "modified"], "left_semi")
                self._publish(same.unionByName(read.select("path", "length", "modified", "digest")))
        finally:
            read.unpersist()
        return counts
