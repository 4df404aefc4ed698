"""Every query with SQL against DuckDB, and all others for rows, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.helpers import connect, same

NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()])
def test_against_sql(spark, sf, duck, name):
    same(entry.queries()[name](spark, sf), duck.execute(entry.oracle_sql()[name]).df())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_sql_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in NAMES if n not in entry.oracle_sql()])
def test_for_rows(spark, sf, name):
    df = entry.queries()[name](spark, sf)
    assert df.columns and len(set(df.columns)) == len(df.columns)
    assert df.count() >= 0
