"""Every catalogue key against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from sparklytics.plans.catalog import QUERIES
from sparklytics.plans.oracle import ORACLE

from .verify import compare, duckdb_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["repository", "week", "year", "count"] and df.count() > 0
