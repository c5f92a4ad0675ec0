"""Every catalogue query with SQL gives the rows of that SQL on the smallest tables."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as spark_entry
from quadspark.plans.registry import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_sql_belongs_to_queries():
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
