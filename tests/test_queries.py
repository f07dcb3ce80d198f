"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from jsonstrata.queries import CATALOGUE
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(CATALOGUE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 4
