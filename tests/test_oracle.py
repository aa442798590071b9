"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

from conftest import SF_SMALL

SQL_KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", SQL_KEYS)
def test_query_matches_sql(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL)
    assert r["status"] == "ok", r


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["item_description", "item_id", "year"]
    assert df.count() > 0
