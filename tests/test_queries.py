"""Every named query against its checking SQL, on the given tables."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, spark_bag, sql_bag
from workload.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    columns, rows = spark_bag(entry_points.queries()[name](spark, FOLDER))
    sql = entry_points.oracle_sql().get(name)
    assert sql is not None, "every query here can be said in SQL"
    want_columns, want = sql_bag(con, sql)
    assert columns == want_columns
    assert sum(rows.values()) == sum(want.values())
    assert rows - want == want - rows
    assert sum(want.values()) > 0


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
