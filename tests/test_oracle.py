"""Every registered query against its DuckDB oracle on the smallest tables,
and the driver contract (entry, queries, oracle_sql)."""

import pytest

import __spark_entry__ as entry
from tributary.plans.catalog import ORACLE, QUERIES
from tributary.plans.compare import compare, duck

SF = "/root/testdata/sf0.001"
SQL = ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.count() > 0 and "conversion_rate" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert r["columns"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values"], r
