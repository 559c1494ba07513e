"""Every registered query against its SQL over the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference, oracle_connection
from yieldstone.registry.oracle import ORACLE
from yieldstone.registry.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["date", "ticker"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None
