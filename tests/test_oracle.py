"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

SQL = oracle_sql()
# Fits of tree ensembles are checked on their own, not on all trips.
SLOW = {"baseline_models", "random_search"}


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", [n for n in queries() if n not in SLOW])
def test_query_matches_sql(spark, small, duck, name):
    problem, _, _ = compare(spark, duck, name, queries()[name], SQL.get(name), small)
    assert problem == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 4
