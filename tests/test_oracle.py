"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from vecferry.plans import registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == ""


def test_entry(spark):
    assert all(row.passed for row in entry.entry(spark).collect())
