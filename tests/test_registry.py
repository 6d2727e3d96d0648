"""Every registered query against its SQL text, and rules about its plan."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point
from barlake.checks.bound import RAW_SCHEMAS
from barlake.checks.registry import CHECKS

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
QUERIES, SQL = {n: entry_point.queries()[n] for n in CHECKS}, entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in [*RAW_SCHEMAS, "documents"]:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else repr(v)

    return sorted(columns), sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|InPandas", plan)
    result = duck.execute(SQL[name])
    expected = comparable([c[0] for c in result.description], result.fetchall())
    assert expected[1] or name == "empty_view", "the check compares no rows"
    assert comparable(df.columns, df.collect()) == expected


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def plan_of(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "upsert_keep_last", "net_profit_rank", "asset_rank", "balance_ratios", "daily_latest_all",
])
def test_rows_per_key_are_cut_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .* Partial", plan_of(spark, name))


def test_scans_read_and_filter_what_is_needed(spark):
    plan = plan_of(spark, "get_daily")
    assert "EqualTo(user_id,7)" in plan and "LessThan(ts," in plan
    assert "event_type" not in plan and "props" not in plan
    plan = plan_of(spark, "moneyflow_rank")
    assert "GreaterThanOrEqual(o_orderdate," in plan and "l_tax" not in plan
    # Only names are looked up: the nation join is gone.
    assert "nation" not in plan


@pytest.mark.parametrize("name", [
    "top_volume", "price_change_rank", "net_profit_rank", "moneyflow_rank", "trading_dates",
    "index_top_weights", "index_performance_rank",
])
def test_top_rows_need_no_global_sort(spark, name):
    plan = plan_of(spark, name)
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
