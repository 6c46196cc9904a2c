"""Differential test: every registered query against its DuckDB oracle."""

import pytest
from helpers import SF001, SF01

from __spark_entry__ import oracle_sql, queries
from oracle.compare import compare, duck

from cartwheel.plans.catalog import QUERIES

NAMES = sorted(set(oracle_sql()) & set(QUERIES))


@pytest.fixture(scope="module")
def con001():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_sf0001(spark, con001, name):
    r = compare(spark, name, queries()[name], oracle_sql()[name], SF001, con001)
    assert not r.get("error"), r
    assert r["spark_rows"] == r["oracle_rows"] and r["mismatches"] == 0, r


@pytest.mark.parametrize("name", ["silver_orders", "rfm_segmentation", "delivery_performance", "quality_report"])
def test_query_matches_oracle_sf001(spark, name):
    r = compare(spark, name, queries()[name], oracle_sql()[name], SF01)
    assert r["spark_rows"] == r["oracle_rows"] and r["mismatches"] == 0, r


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
