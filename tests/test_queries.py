import pytest

import __spark_entry__ as entry
from compare import compare, connect
from registered.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert compare(entry.queries()[name](spark, SF), entry.oracle_sql()[name], connection) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 10
