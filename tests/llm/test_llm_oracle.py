"""Queries that SQL can express equal their DuckDB oracle (rows, names, values) at sf0.001; the others run on whole tables."""

import pytest

from conftest import SF001
from crashlens.llm import queries
from llm_common import workers_path  # noqa: F401
from oracle_check import compare, duck

SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, con, name):
    result = compare(spark, con, name, queries.queries()[name], SQL.get(name), SF001)
    assert result["match"] is not False, result
    table = {"op2": "embeddings", "op10": "pages"}.get(name.split("_")[0], "documents")
    if not name.startswith("op6"):
        assert result["rows"] == con.execute(f"SELECT count(*) FROM {table}").fetchall()[0][0]
