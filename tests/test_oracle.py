"""Every registered query against its SQL text on DuckDB (the driver's check)."""

from __future__ import annotations

import pytest

from compare import compare, duckdb_connection

SF_DIR = "/root/testdata/sf0.001"


def _registry():
    from tessera.queries import REGISTRY

    return REGISTRY


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(_registry()))
def test_query_matches_sql(spark, con, name):
    fn, sql = _registry()[name]
    df = fn(spark, SF_DIR)
    assert sql is not None  # every library query has its SQL
    difference = compare(df, con, sql)
    assert difference is None, difference


def test_entry_runs(spark):
    import __spark_entry__ as entry_mod

    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
