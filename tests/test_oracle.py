"""Every registered query against its SQL oracle (DuckDB) on sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare, duck
from tablewright.plans import catalog

QUERIES = catalog.QUERIES  # the text operators have their own tests
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(SQL) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, name, QUERIES[name], SQL[name], SF_SMALL, con)
    assert info["cols_ok"] and info["hash_ok"], info


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]
    assert df.count() >= 0
