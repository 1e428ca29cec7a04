"""Functions of users: a table function over ordered partitions and an aggregate in two steps, registered for SQL.

``runs(TABLE(...) PARTITION BY k ORDER BY t)`` reads columns k, t and kind and gives a row for every
run of rows of one kind: it holds one run at a time, so a partition may be of any size.

``harmonic_part(x)`` sums up a group's share in batches, ``harmonic(state)`` brings the shares of a
group together; a group of any size is dealt to shares first, so that no task holds it::

    SELECT k, harmonic(s) FROM (SELECT k, harmonic_part(x) AS s FROM t GROUP BY k, pmod(hash(id), 64)) GROUP BY k
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import Row


class Runs:
    def __init__(self) -> None:
        self.now: list | None = None

    def eval(self, row: Row) -> Iterator[tuple]:
        if self.now is not None and self.now[1] == row["kind"]:
            self.now[3], self.now[4] = row["t"], self.now[4] + 1
            return
        if self.now is not None:
            yield tuple(self.now)
        self.now = [row["k"], row["kind"], row["t"], row["t"], 1]

    def terminate(self) -> Iterator[tuple]:
        if self.now is not None:
            yield tuple(self.now)


def harmonic_part(x: pd.Series) -> list[float]:
    """The number of positive values, and the sum of their inverses; others count for nothing."""
    x = x[x > 0].to_numpy(float)
    return [float(len(x)), float(np.sum(1 / x))]


def harmonic(states: pd.Series) -> float | None:
    """The harmonic mean behind states; null where no value was positive."""
    n, inverse = np.sum(np.stack(states.to_numpy()), axis=0) if len(states) else (0.0, 0.0)
    return float(n / inverse) if n else None


def register(spark: SparkSession) -> None:
    """Makes runs, harmonic_part and harmonic known to the session's SQL."""
    # Of the session's Arrow settings only the one for table functions matters, and it is set per function.
    spark.udtf.register("runs", F.udtf(Runs, returnType="k long, kind string, started timestamp, ended timestamp, n int", useArrow=True))
    spark.udf.register("harmonic_part", F.pandas_udf(harmonic_part, "array<double>", F.PandasUDFType.GROUPED_AGG))
    spark.udf.register("harmonic", F.pandas_udf(harmonic, "double", F.PandasUDFType.GROUPED_AGG))
