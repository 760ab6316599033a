"""Registered queries: SQL on DuckDB where there is one, else a defined shape."""

from __future__ import annotations

import pytest

from compare import compare, duckdb_connection
from corpus_pipeline import PIPELINE
from tessera.llm.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
SQL = {name: v for name, v in {**REGISTRY, **PIPELINE}.items() if v[1] is not None}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    fn, sql = SQL[name]
    assert compare(fn(spark, SF_DIR), con, sql) is None


def test_all_are_registered():
    import __spark_entry__ as entry

    assert {**REGISTRY, **PIPELINE}.keys() <= entry.queries().keys()
    assert SQL.keys() <= entry.oracle_sql().keys()
