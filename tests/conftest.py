import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def rows_of(frame):
    """A pandas frame's rows, sorted, columns by name, for comparison."""
    import pandas as pd

    def plain(x):
        if x is None or x is pd.NA or isinstance(x, float) and x != x:
            return "null"
        return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) or type(x).__module__ == "numpy" and not isinstance(x, str) and str(x) not in ("True", "False") else str(x)

    return sorted(tuple(map(plain, r)) for r in frame[sorted(frame.columns)].astype(object).values.tolist())
