"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from harness.queries import QUERIES
from harness.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(entry.queries()) & set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 25


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name) is None
