"""Every named query against its SQL on the smallest data."""

import pytest
from check_queries import connect, differences

import __spark_entry__ as entry
from clickloom.testbed.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    run, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert differences(spark, duck, name, run, sql, SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 572
