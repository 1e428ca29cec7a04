"""Article files: one Markdown file with front matter per row."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta import schema
from statuta.functions.keys import path_keys
from statuta.sources import frontmatter


def scan(spark: SparkSession, *roots: str) -> DataFrame:
    """path and value (a whole file) of every Markdown file below the roots."""
    files = spark.read.text(list(roots), wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    return files.select(F.col("_metadata.file_path").alias("path"), "value")


def parse(files: DataFrame) -> DataFrame:
    """Articles from path and value.  No row is dropped: one that cannot be read has its reason in ``corrupt``.

    Spark has no reader for YAML, so this step is an Arrow function with a fixed schema.  Filter
    on the path before it; nothing can be pushed below it.
    """
    keyed = files.select("path", "value", path_keys(F.col("path")).alias("k")).select("path", "value", "k.tier", "k.phase", "k.law_abbrev")
    names = [f.name for f in schema.ARTICLE.fields]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content, tier, phase, abbrev in frame[["path", "value", "tier", "phase", "law_abbrev"]].itertuples(index=False):
                row = dict.fromkeys(names) | {"path": path, "tier": tier, "phase": phase, "law_abbrev": abbrev}
                try:
                    front, row["body"] = frontmatter.split_document(content or "")
                    fields = frontmatter.parse(front)
                    row["keys"] = list(fields)
                    row |= frontmatter.conform(fields, schema.FRONT)
                except frontmatter.Malformed as e:
                    row["corrupt"] = str(e)
                if row["phase"] is None and row["tags"]:
                    row["phase"] = row["tags"][0]
                rows.append(row)
            yield pd.DataFrame(rows, columns=names)

    return keyed.mapInPandas(run, schema.ARTICLE)


def read_articles(spark: SparkSession, *roots: str, phase: str | None = None, law_abbrev: str | None = None) -> DataFrame:
    """All articles below the roots, or those of one phase or law, which are the only ones parsed."""
    files = scan(spark, *roots)
    keys = path_keys(F.col("path"))
    if phase is not None:
        files = files.where(keys["phase"] == phase)
    if law_abbrev is not None:
        files = files.where(keys["law_abbrev"] == law_abbrev)
    return parse(files)


def flat_field(content: F.Column, key: str) -> F.Column:
    """One unnested field of a file's front matter, without parsing the rest; quotes are taken off."""
    raw = F.regexp_extract(F.split(content, "\n---\n", 2)[0], rf"(?m)^{key}: (.+)$", 1)
    return F.nullif(F.regexp_replace(raw, r"^(['\"])(.*)\1$", "$2"), F.lit(""))


def render(articles: DataFrame) -> DataFrame:
    """path and value of article files: front matter, caption, and paragraphs with their segment markers.

    A marker stands right before its segment's own text, never in the caption.
    """
    columns = [f.name for f in schema.FRONT.fields]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = []
            for row in frame.to_dict("records"):
                fields = {c: _plain(row[c]) for c in columns}
                values.append(f"---\n{frontmatter.dump(fields)}---\n{row['body'] or ''}")
            yield pd.DataFrame({"path": frame["out_path"], "value": values})

    from statuta.functions.keys import article_path

    out = articles.withColumn("out_path", article_path(F.col("law_abbrev"), F.col("article_number"), F.coalesce("tier", F.lit("data")), F.col("phase")))
    return out.select("out_path", "body", *columns).mapInPandas(run, "path string, value string")


def _plain(value):
    """Rows and arrays as mappings and lists."""
    if value is None or isinstance(value, float) and value != value:
        return None
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)) or hasattr(value, "tolist") and getattr(value, "ndim", 0):
        return [_plain(v) for v in value]
    value = value.item() if hasattr(value, "item") else value
    # pandas makes whole numbers beside nulls floating; the schema has no floating field.
    return int(value) if isinstance(value, float) else value


def write_articles(articles: DataFrame, root: str, mounted: bool = False) -> None:
    """Writes one file per article below root, by its canonical path; a task that is run again writes the same bytes."""
    write_files(render(articles), root, mounted)


def write_files(files: DataFrame, root: str, mounted: bool = False) -> None:
    """Writes one file per row of path and value below root.

    Executors write with plain file calls, each file under another name first, so that none is ever
    seen half written.  So unless Spark runs in one process, the caller has to say that root is
    mounted by all of them.
    """
    if not mounted and not files.sparkSession.sparkContext.master.startswith("local"):
        raise NotImplementedError("one file per row needs a folder that all executors mount")
    top = root.removeprefix("file://").removeprefix("file:")

    def save(rows) -> None:
        import os
        from pathlib import Path

        for row in rows:
            at = Path(top) / row["path"]
            at.parent.mkdir(parents=True, exist_ok=True)
            made = at.with_name(f".{at.name}.{os.getpid()}")
            made.write_text(row["value"], encoding="utf-8")
            made.replace(at)

    files.foreachPartition(save)
