"""The dealt queries that SQL can express, against DuckDB."""

import pytest

from terrarium.llm import queries
from oracle_check import compare

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    got = compare(spark, SF, name, queries.QUERIES[name], queries.ORACLE_SQL[name])
    assert got["status"] == "ok" and got["spark_rows"] > 0, got
