"""Every registered query against its DuckDB SQL twin at sf0.01."""

import pytest

import __spark_entry__ as entry
import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_check import compare, duck  # noqa: E402
from conftest import SF01

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL.get(name), SF01)
    assert r["status"] in ("ok", "rows-only"), r
    assert r["spark_rows"] >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["created_date", "stance", "n_comments"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
