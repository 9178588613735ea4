"""Every registered query against its SQL counterpart."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ordermill.workload import QUERIES, SQL
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_agrees_with_sql(spark, connection, name):
    assert compare(spark, connection, FOLDER, name, queries()[name], oracle_sql()[name]) is None
