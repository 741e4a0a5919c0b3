"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    text, ok, detail = compare(spark, con, name, QUERIES[name], SQL.get(name), sf_dir)
    assert ok, (text, detail)


def test_entry_has_stable_schema(spark):
    assert entry.entry(spark).schema == entry.entry(spark).schema
