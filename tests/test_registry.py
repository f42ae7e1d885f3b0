from __future__ import annotations

import pytest
from compare import difference, duck

import __spark_entry__ as contract

SQL = contract.oracle_sql()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries()) and len(contract.queries()) > 100


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, small, connection, name):
    assert difference(contract.queries()[name](spark, small), connection, SQL[name]) is None
