import pytest

from barlake.plans.statements import latest_period
from barlake.sources.landing import classify_st
from conftest import make, rows_of


def bar(code, date, close, amount=None, pct=None):
    return {"ts_code": code, "trade_date": date, "close": close, "amount": amount, "pct_chg": pct}


def named(*codes):
    return [{"ts_code": c, "name": f"name {c}", "industry": "bank"} for c in codes]


def test_price_change_needs_both_dates(market):
    m = market(
        daily=[
            bar("A", "20240102", 10.0), bar("A", "20240105", 12.0),
            bar("B", "20240102", 10.0),
            bar("C", "20240105", 10.0),
            bar("D", "20240102", 0.0), bar("D", "20240105", 1.0),
            bar("E", "20240102", 10.0), bar("E", "20240105", None),
            bar("F", "20240102", 10.0), bar("F", "20240103", 99.0), bar("F", "20240105", 9.0),
        ],
        stock_basic=named("A", "F"),
    )
    down = rows_of(m.price_change_rank("20240102", "20240105"))
    assert down == [
        ("A", "name A", 10.0, 12.0, 20.0), ("F", "name F", 10.0, 9.0, -10.0),
        ("D", None, 0.0, 1.0, None), ("E", None, 10.0, None, None),
    ]
    up = rows_of(m.price_change_rank("20240102", "20240105", n=1, ascending=True))
    assert [r[0] for r in up] == ["F"]


def test_top_volume_ranks_by_amount_and_keeps_unknown_names(market):
    m = market(daily=[bar("A", "20240102", 1.0, 5.0), bar("B", "20240102", 1.0, 9.0),
                      bar("C", "20240102", 1.0, None), bar("D", "20240103", 1.0, 99.0)],
               stock_basic=named("A"))
    assert [(r[0], r[1]) for r in rows_of(m.top_volume("20240102", 2))] == [
        ("B", None), ("A", "name A")]


def test_sector_performance_leaves_out_null_industry(market):
    m = market(daily=[bar("A", "20240102", 1.0, 10.0, 1.0), bar("B", "20240102", 1.0, 21.0, 2.0),
                      bar("C", "20240102", 1.0, 1.0, 9.0)],
               stock_basic=[*named("A", "B"), {"ts_code": "C"}])
    assert rows_of(m.sector_performance("20240102")) == [("bank", 2, 1.5, 16.0)]


def test_net_profit_rank_does_not_step_back(market):
    def income(code, end, profit, flag="0"):
        return {"ts_code": code, "end_date": end, "n_income_attr_p": profit, "update_flag": flag}

    rows = [
        income("A", "20230930", 5e4), income("A", "20231231", None),
        income("B", "20230930", 9e4), income("B", "20231231", 12345.0),
        income("C", "20231231", 7e4, "0"), income("C", "20231231", 6e4, "1"),
        income("D", "20240331", 9e9), income("D", "20230630", 1e4),
    ]
    m = market(income=rows, stock_basic=named("B", "C", "D"))
    got = [(r["ts_code"], r["end_date"], r["net_profit_yi"])
           for r in m.roe_rank("20231231").collect()]
    assert got == [("C", "20231231", 7.0), ("C", "20231231", 6.0),
                   ("B", "20231231", 1.23), ("D", "20230630", 1.0)]
    assert latest_period(m.tables.scan("income"), "20231231").count() == 5


def test_ratios_with_zero_divisors(market):
    m = market(balancesheet=[
        {"ts_code": "A", "end_date": "20231231", "total_assets": 0.0, "total_liab": 1.0,
         "total_cur_assets": 3.0, "total_cur_liab": 0.0},
        {"ts_code": "A", "end_date": "20230930", "total_assets": 3.0, "total_liab": 1.0,
         "total_cur_assets": 3.0, "total_cur_liab": 2.0},
    ])
    got = [(r["current_ratio"], r["debt_ratio_pct"]) for r in m.balancesheet_summary("A").collect()]
    assert got == [(None, None), (1.5, 33.33)]
    assert m.balance_ratios(1).count() == 1
    assert [r["debt_ratio_pct"] for r in m.asset_rank("20231231").collect()] == [None]


def test_weights_of_the_latest_date(market):
    def w(con, date, weight, index="I"):
        return {"index_code": index, "con_code": con, "trade_date": date, "weight": weight}

    m = market(index_weight=[
        w("A", "20240131", 9.0), w("A", "20240229", 2.0), w("B", "20240229", 3.0),
        w("C", "20240229", 3.0), w("A", "20240331", 1.0, "J"), w("A", "20240331", 1.0, "J"),
    ])
    assert [r[1] for r in rows_of(m.index_weight_latest("I"))] == ["B", "C", "A"]
    assert m.index_weight_latest("nope").count() == 0
    assert [r[1] for r in rows_of(m.index_top_weights("I", n=1))] == ["B"]
    assert [r[1] for r in rows_of(m.index_top_weights("I", "20240131"))] == ["A"]
    assert rows_of(m.index_weight_summary("I"))[0][:4] == ("I", "20240229", 3, 8.0)
    assert rows_of(m.search_constituent("A"))[0] == ("J", "20240331", 1.0)
    assert m.search_constituent("A").count() == 3
    assert m.search_constituent_in_index("A", "I", 1).count() == 1
    assert [r[1] for r in rows_of(m.constituent_history("A", "I"))] == ["20240131", "20240229"]
    assert sorted(rows_of(m.max_constituents())) == [("I", 3), ("J", 2)]


def test_cumulative_return_needs_both_bars(market):
    bars = [{"ts_code": "I", "trade_date": d, "close": c, "pct_chg": c}
            for d, c in (("20240102", 4.0), ("20240105", 5.0))]
    m = market(index_daily=bars)
    assert rows_of(m.index_cumulative_return("I", "20240102", "20240105")) == [
        ("I", "20240102", 4.0, "20240105", 5.0, 25.0)]
    assert m.index_cumulative_return("I", "20240102", "20240104").count() == 0
    assert rows_of(m.index_performance_rank("20240105"))[0][0] == "I"
    assert m.get_index_daily_latest("I").first()["trade_date"] == "20240105"


def test_search_case_rules(market):
    m = market(stock_basic=[
        {"ts_code": "1", "name": "ALPHA", "symbol": "x", "cnspell": "zz"},
        {"ts_code": "2", "name": "alpha", "symbol": "x", "cnspell": "zz"},
        {"ts_code": "3", "name": "other", "symbol": "x", "cnspell": "alpha"},
        {"ts_code": "4", "name": None, "symbol": None, "cnspell": None},
    ])
    assert [r[0] for r in rows_of(m.search_stock("alpha"))] == ["1", "3"]
    m = market(index_basic=[{"ts_code": "1", "name": "Alpha"}, {"ts_code": "A%2", "name": "b"}])
    assert [r[0] for r in rows_of(m.search_index("alpha"))] == ["1"]


def test_st_names(spark):
    names = ["*ST A", "ST B", "S*ST C", "BEST", "plain", None]
    df = make(spark, "stock_basic", [{"ts_code": str(i), "name": n} for i, n in enumerate(names)])
    got = [(r["name"], r["st_type"]) for r in classify_st(df).collect()]
    assert got == [("*ST A", "*ST"), ("ST B", "ST"), ("S*ST C", "ST"), ("BEST", "ST")]


def test_counts_keep_the_null_group(market):
    m = market(index_basic=[{"ts_code": "1", "market": "SSE", "category": "c"}, {"ts_code": "2"},
                            {"ts_code": "3"}])
    assert rows_of(m.index_count_by_market()) == [(None, 2), ("SSE", 1)]
    assert rows_of(m.index_count_by_category("SSE")) == [("SSE", "c", 1)]


def test_scalar_calendar_queries(market):
    days = [("20251231", 1), ("20260101", 0), ("20260102", 0), ("20260105", 1)]
    rows = [{"exchange": "SSE", "cal_date": d, "is_open": o} for d, o in days]
    m = market(trade_calendar=rows)
    assert m.is_trading_day("20251231") and not m.is_trading_day("20260101")
    assert not m.is_trading_day("20300101") and not m.is_trading_day("20251231", "SZSE")
    assert m.next_trading_day("20260101") == "20260105"
    assert m.next_trading_day("20260105") == "20260105"
    assert m.next_trading_day("20260106") is None
    assert m.trading_days_count("20251231", "20260105") == 2


def test_raw_sql_with_parameters(market):
    m = market(daily=[bar("A", "20240102", 1.0), bar("A'; --", "20240103", 2.0)])
    got = m.raw_sql("SELECT close FROM DAILY_VIEW WHERE ts_code = :code", code="A'; --")
    assert rows_of(got) == [(2.0,)]
    assert m.raw_sql("SELECT 1 AS one").first()["one"] == 1
    assert m.raw_sql("SELECT * FROM index_weight_hs300_view").count() == 0
    with pytest.raises(Exception):
        m.raw_sql("SELECT * FROM no_such_view").collect()


def test_profiles_of_empty_tables(market):
    m = market(daily=[bar("A", "20240102", 1.0)])
    counts = dict(rows_of(m.record_counts()))
    assert counts["daily"] == 1 and counts["income"] == 0 and len(counts) == 12
    listing = {r["table"]: r for r in m.manifest().collect()}
    assert listing["daily"]["first"] == "20240102" and listing["income"]["partitions"] == 0
    assert m.get_schemas().count() == 344
