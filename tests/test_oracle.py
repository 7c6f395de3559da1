"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import compare
import pytest

import __spark_entry__ as driver
from billsift.plans.oracle import ORACLES
from billsift.plans.registry import QUERIES

SF_DIR = driver.SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert driver.queries().items() >= QUERIES.items() and driver.oracle_sql().items() >= ORACLES.items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = compare.spark_rows(QUERIES[name](spark, SF_DIR))
    expected = compare.sql_rows(duck, ORACLES[name])
    assert got[0] == expected[0]
    assert got[1] == expected[1]
    assert got[1], "a query without rows checks nothing"


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns == list(driver.queries()["extract_records"](spark, SF_DIR).columns)
    assert not frame.isEmpty()
