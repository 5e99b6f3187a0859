"""Every registered query against its DuckDB oracle (the driver's check)."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

from terrarium.plans import named, streamed

from conftest import SF001  # noqa: E402

OWN = {**named.QUERIES, **streamed.QUERIES}
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF001, name, E.queries()[name], E.oracle_sql().get(name), con)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 542
    assert df.columns == ["timestamp", "sensor", "grams", "stddev"]
