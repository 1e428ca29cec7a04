import pytest
from conftest import SF, rows_of

from statuta import queries, queries_pages, queries_time, queries_values  # noqa: F401  (they register their queries)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_says_what_sql_says(spark, duck, name):
    frame = queries.QUERIES[name](spark, SF)
    assert len(set(frame.columns)) == len(frame.columns)
    got = frame.toPandas()
    if name in queries.ORACLE:
        want = duck.execute(queries.ORACLE[name]).fetchdf()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)


def test_entry_needs_no_subpackage(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = queries.pii_raw_drop(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)]" in plan and "Python" not in plan
