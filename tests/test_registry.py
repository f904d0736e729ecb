"""Every registered query against its SQL in DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_matches_sql(spark, duck, name):
    sql = registry.oracle_sql().get(name)
    ok, note = compare(spark, duck, name, registry.queries()[name], sql, SF_DIR)
    assert ok, note


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry_has_rows(spark):
    df = registry.entry(spark)
    assert df.columns == ["Order_Year", "Total_Cost", "Order_Year_is_total"]
    assert df.filter("Order_Year_is_total = 1").count() == 1
    years = [r[0] for r in df.filter("Order_Year_is_total = 0").collect()]
    assert years and all(1990 < y < 2010 for y in years)
