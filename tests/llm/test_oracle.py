"""The queries that have SQL, against DuckDB."""

import compare
import pytest

from billsift.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    got = compare.spark_rows(QUERIES[name](spark, sf_dir))
    assert got == compare.sql_rows(compare.connect(sf_dir), ORACLES[name])
    assert got[1]
