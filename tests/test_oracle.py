"""Every registered query on the smallest tables, against DuckDB where an equivalent exists."""

import warnings

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from brightloom.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    if name in ORACLES:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            want = duck.execute(ORACLES[name]).to_arrow_table()
        assert compare(got, want) == []
    else:
        assert got.num_rows > 0


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert {r["kpi"] for r in rows} == {"daily_sales", "sales_ma_7d", "mom_growth", "daily_active", "retention_rate"}


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries()) >= set(QUERIES)
