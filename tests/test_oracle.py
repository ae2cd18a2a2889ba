"""Every registered query against its SQL, on the smallest data set."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL.get(name), SF) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 5


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)
