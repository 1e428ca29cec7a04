"""Values of any shape in JSON text: parsed once into a variant, read by path, counted by shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """The text as a variant, null where it is null or no JSON; ``reason`` says which.

    Spark reads the first JSON value of a text, and does not look at what follows it.
    """
    return F.try_parse_json(text)


def reason(text: Column) -> Column:
    """Why ``parsed`` gives no value: 'missing' or 'empty' text, 'cut off' (brackets or a quote stay open), or 'malformed'; null for JSON.

    A text counts as cut off if it has more opening than closing brackets outside of its strings, or a string that doesn't end.
    """
    outside = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', "")
    count = lambda signs: F.regexp_count(outside, F.lit(signs))
    open_ = outside.contains('"') | (count(r"[\[{]") > count(r"[\]}]"))
    why = F.when(F.trim(text) == "", "empty").when(open_, "cut off").otherwise("malformed")
    return F.when(text.isNull(), "missing").when(F.try_parse_json(text).isNull(), why)


def field(value: Column, path: str, kind: str) -> Column:
    """What stands at a path like $.a.b[0], as kind; null where there is nothing, or nothing that can be cast."""
    return F.try_variant_get(value, path, kind)


def keys(value: Column) -> Column:
    """The names of an object's fields in order; null for other values."""
    return F.array_sort(F.map_keys(F.try_variant_get(value, "$", "map<string, variant>")))


def elements(rows: DataFrame, value: str, path: str, *keep: str) -> DataFrame:
    """A row for every element of the array at the path: the columns in keep, position from 0 on, and element, a variant."""
    return rows.select(*keep, F.posexplode(F.try_variant_get(F.col(value), path, "array<variant>")).alias("position", "element"))


def shapes(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """Per group of by: the names of fields that objects have together, and the number of rows with just these."""
    return rows.groupBy(*by, F.array_join(keys(F.col(value)), ",").alias("shape")).agg(F.count(F.lit(1)).alias("n"))


def merged_schema(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """Per group of by: the one schema that holds all values, as Spark writes it."""
    return rows.groupBy(*by).agg(F.schema_of_variant_agg(value).alias("schema"))
