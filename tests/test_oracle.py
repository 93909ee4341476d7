"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from cograph.oracle_check import compare, duck
from cograph.plans import queries as core

SF = "/root/testdata/sf0.001"
QUERIES = core.SPARK
SQL = core.SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_twin_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_an_empty_result_is_no_match(spark, con):
    ok, msg = compare(spark.sql("SELECT 1 AS a WHERE false"), con, "SELECT 1 AS a WHERE false")
    assert not ok and "no rows" in msg


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["item_A", "item_B", "weight", "raw_weight", "rank"]
    assert df.count() > 0
