"""The canned queries give the same rows over stored tables as over their sources."""

import os

import pytest

from barlake.catalog import CATALOG
from barlake.checks.bound import BoundTables
from barlake.plans.market import Market
from barlake.sources.store import Store

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def source(spark):
    return Market(BoundTables(spark, FOLDER))


@pytest.fixture(scope="module")
def stored(spark, source, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("stored")), source.tables.indices)
    for table in CATALOG:
        store.upsert(source.tables.scan(table), table)
    return Market(store)


QUERIES = {
    "get_daily": lambda m: m.get_daily("7", "20240110", "20240120"),
    "get_daily_latest": lambda m: m.get_daily_latest("7"),
    "top_volume": lambda m: m.top_volume("20240115", 10),
    "price_change_rank": lambda m: m.price_change_rank("20240110", "20240120"),
    "sector_performance": lambda m: m.sector_performance("20240115"),
    "search_stock": lambda m: m.search_stock("t_1"),
    "st_stocks_by_industry": lambda m: m.st_stocks_by_industry(),
    "get_income": lambda m: m.get_income("7", "19970331", "19991231"),
    "roe_rank": lambda m: m.roe_rank("19991231"),
    "asset_rank": lambda m: m.asset_rank("19991231"),
    "cashflow_summary": lambda m: m.cashflow_summary("7"),
    "moneyflow_rank": lambda m: m.moneyflow_rank("19980115"),
    "get_moneyflow": lambda m: m.get_moneyflow("7", "19960101", "19991231"),
    "index_count_by_category": lambda m: m.index_count_by_category(),
    "index_weight_latest": lambda m: m.index_weight_latest("BUILDING"),
    "index_weight_summary": lambda m: m.index_weight_summary("BUILDING"),
    "index_daily": lambda m: m.get_index_daily("MACHINERY", "19980101", "19981231"),
    "get_trade_calendar": lambda m: m.get_trade_calendar("19990101", "19991231", "SZSE"),
    "manifest": lambda m: m.manifest(),
    "raw": lambda m: m.raw_sql("SELECT count(*) AS n FROM index_daily_building_view"),
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_stored_rows_equal_source_rows(source, stored, name):
    query = QUERIES[name]
    got = query(stored)
    assert got.columns == query(source).columns
    assert sorted(map(str, got.collect())) == sorted(map(str, query(source).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_are_pruned(stored):
    assert "PartitionFilters: [isnotnull(ym" in plan(stored.get_daily("7", "20240110", "20240120"))
    assert "ym#" in plan(stored.top_volume("20240115")).split("PartitionFilters:")[1][:60]
    assert "end_date" in plan(stored.roe_rank("19991231")).split("PartitionFilters:")[1][:60]
    weights = plan(stored.get_index_weight("BUILDING", "19981231"))
    assert "index_short" in weights.split("PartitionFilters:")[1][:200]
