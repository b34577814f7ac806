import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_duckdb(spark, con, name):
    assert difference(spark, con, SMALL, name) is None


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns[0] == "window_s" and frame.count() > 0
