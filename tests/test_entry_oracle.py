"""The driver contract: every query runs, and every SQL twin agrees with its query."""

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
SQL_KEYS = sorted(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["column_name", "n", "corr"]
    assert len(rows) == 7


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", SQL_KEYS)
def test_query_matches_sql_twin(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF)
    assert r["cols_match"], r
    assert r["types_match"], r
    assert r["ok"], r


@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, key):
    df = E.queries()[key](spark, SF)
    assert df.count() >= 1
