"""A corpus pipeline of five operators: each stage's result is written and read again for the next."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from statuta.llm import bpe, langid, mixing, neardup, pii
from statuta.llm.common import Shelf
from statuta.ship import ship


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that are in a language of the corpus."""
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group that shares four fifths of its five-word shingles."""
    return neardup.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind's name in place of every span of personal data."""
    return pii.clean(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources meet their targets."""
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every document of the mix."""
    return bpe.report(docs)


def _shipped(stage):
    return wraps(stage)(lambda spark, docs, sf_dir: stage(ship(spark), docs, sf_dir))


STAGES = [(name, _shipped(stage)) for name, stage in (
    ("language_id", language), ("minhash", near_duplicates), ("pii", personal_data), ("mixing", mix), ("bpe", encode),
)]

#: Stages that learn from the corpus or compare all of it cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    shelf = Shelf(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = shelf.put(stage(spark, docs, sf_dir), name)
        if last:
            shelf.clear(last)
        last = name
    return STAGES[-1][1](spark, docs, sf_dir)
