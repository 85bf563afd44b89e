"""Registered queries against their SQL on the smallest benchmark tables."""

import pytest

import __spark_entry__
from parcelwise.checks import compare
from parcelwise.checks.oracle import ORACLE
from parcelwise.checks.queries import QUERIES

@pytest.fixture(scope="module")
def con(tiny):
    return compare.connect(tiny)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, tiny, name):
    assert compare.differences(QUERIES[name](spark, tiny), con, ORACLE[name]) == []


def test_entry_points(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
