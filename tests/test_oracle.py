"""Every registered query against its DuckDB oracle: names, types, row count and exact values."""

import pytest

import __spark_entry__ as entry
from levyline.catalog import QUERIES
from levyline.oracle.catalog import ORACLE
from levyline.oracle.compare import compare, duck_connection
from tests.conftest import SF_CHECK, SF_SMALL



@pytest.fixture(scope="module")
def duck_small():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle_sf0001(spark, duck_small, name):
    out = compare(spark, duck_small, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert out.ok, out.detail


@pytest.mark.parametrize(
    "name", ["agg_revenue_daily", "agg_concession_by_plancode", "fct_agent_enumeration", "merge_agent_transactions"]
)
def test_matches_oracle_sf001(spark, name):
    out = compare(spark, duck_connection(SF_CHECK), name, QUERIES[name], ORACLE[name], SF_CHECK)
    assert out.ok, out.detail


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_amount" in df.columns
