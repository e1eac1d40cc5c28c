"""Every registered query equals its DuckDB oracle (rows, names, values) at sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from crashlens.plans import registry
from oracle_check import compare, duck

QUERIES = registry.queries()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], SQL[name], SF001)
    assert result["match"], result


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["VEH_MAKE_ID", "n"]
    assert len(df.collect()) == 5
