"""Every query with SQL gives DuckDB's rows; every query runs."""

import oracle
import pytest

import __spark_entry__ as driver
from weatherlake.plans.catalog import QUERIES, SQL

SF_DIR = str(oracle.TESTDATA / "sf0.01")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_equal_duckdb(spark, duck, name):
    result = oracle.rows_of_spark(QUERIES[name](spark, SF_DIR))
    expected = oracle.rows_of_duckdb(duck, SQL[name])
    assert expected[1], "the SQL gives no rows, so the comparison says nothing"
    assert oracle.difference(result, expected) is None


def test_entry(spark):
    assert driver.entry(spark).count() == 150
