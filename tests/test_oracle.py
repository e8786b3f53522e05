"""Every registered query equals its DuckDB statement at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from rainfold.workload import oracle
from rainfold.workload.queries import QUERIES
from tests.oracle_compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_each_query_has_a_statement():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    problem = compare(spark, duck, SF_DIR, entry.queries()[name], entry.oracle_sql()[name])
    assert problem is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 300
