"""Every named query against its SQL."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference
from tests.conftest import SMALL

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())
    without = set(contract.queries()) - set(SQL)
    assert all(name.startswith("op") or name == "pipeline" for name in without)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert difference(contract.queries()[name](spark, SMALL), con, SQL[name]) == ""


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
