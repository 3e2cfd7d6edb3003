"""Queries of the training-data operators that have a SQL twin, against it."""

import pytest

from harness.check import compare, connect
from morphloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(spark, connect(SF), SF, name, QUERIES, ORACLES) is None
