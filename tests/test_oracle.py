"""Every registered query against its SQL."""

import __spark_entry__ as entry
import pytest

from tests.compare import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, sf, name):
    ok, note = compare(spark, con, QUERIES[name], SQL[name], sf)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_sql_only_for_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["query_id", "n_docs", "context"]
