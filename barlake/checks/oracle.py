"""SQL texts of the bound market tables, as named common table expressions (``v_<table>``)."""

from __future__ import annotations

import re

from barlake.catalog import spec_of

_SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER"}


def fill(table: str, source: str, **exprs: str) -> str:
    """SELECT all catalogue columns of ``table``; those without an expression are null."""
    cols = []
    for f in spec_of(table).schema.fields:
        kind = _SQL_TYPES[f.dataType.simpleString()]
        cols.append(f'CAST({exprs.get(f.name, "NULL")} AS {kind}) AS "{f.name}"')
    return f"SELECT {', '.join(cols)} FROM {source}"


def _ymd(expr: str) -> str:
    return f"strftime({expr}, '%Y%m%d')"


def _cents(expr: str) -> str:
    return f"CAST(round({expr} * 100) AS BIGINT)"


def _money(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE) / CAST(100 AS DOUBLE)"


_QUARTER = "CAST(date_trunc('quarter', {0}) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)"


def quarter_end(expr: str) -> str:
    return _ymd(_QUARTER.format(expr))


def _part(condition: str | None = None) -> str:
    value = _cents("o_totalprice")
    return f"sum(CASE WHEN {condition} THEN {value} END)" if condition else f"sum({value})"


def _bars(source: str, code: str, ts: str, seq: str, price: str) -> str:
    return f"""
        SELECT {code} AS code, CAST({ts} AS DATE) AS d,
               min_by({price}, {seq}) AS open, max({price}) AS high, min({price}) AS low,
               max_by({price}, {seq}) AS close, CAST(count(*) AS DOUBLE) AS vol,
               {_money(f"sum({_cents(price)})")} AS amount
        FROM {source} GROUP BY 1, 2"""


def _changes(bars: str) -> str:
    return f"SELECT *, lag(close) OVER (PARTITION BY code ORDER BY d) AS pre_close FROM ({bars})"


_BAR_COLUMNS = {
    "ts_code": "code", "trade_date": _ymd("d"), "open": "open", "high": "high", "low": "low",
    "close": "close", "pre_close": "pre_close", "change": "close - pre_close",
    "pct_chg": "(close - pre_close) / nullif(pre_close, 0) * 100", "vol": "vol",
    "amount": "amount",
}


def _statement(table: str, **sums: str) -> str:
    aggregates = ", ".join(f"{expr} AS {name}" for name, expr in sums.items())
    source = f"""(
        SELECT o_custkey, {_QUARTER.format('o_orderdate')} AS q,
               {_ymd('max(o_orderdate)')} AS ann, {aggregates}
        FROM orders GROUP BY 1, 2)"""
    return fill(
        table, source, ts_code="o_custkey", end_date=_ymd("q"), ann_date="ann", f_ann_date="ann",
        report_type="1", comp_type="1", end_type="quarter(q)", update_flag="0",
        **{name: name for name in sums},
    )


def _or_zero(priority: str) -> str:
    return f"coalesce({_part(f'o_orderpriority = {priority!r}')}, 0)"


_OPEN = "o_orderstatus = 'O'"
_CURRENT = "o_orderpriority IN ('1-URGENT', '2-HIGH')"
_BANDS = {
    "sm": "l_extendedprice < 25000",
    "md": "l_extendedprice >= 25000 AND l_extendedprice < 50000",
    "lg": "l_extendedprice >= 50000 AND l_extendedprice < 75000",
    "elg": "l_extendedprice >= 75000",
}
_SIDES = {"buy": "l_returnflag <> 'R'", "sell": "l_returnflag = 'R'"}


def _flows() -> dict[str, str]:
    out = {}
    for band, hit in _BANDS.items():
        for side, own in _SIDES.items():
            out[f"{side}_{band}_vol"] = f"sum(CASE WHEN {hit} AND {own} THEN l_quantity ELSE 0 END)"
            out[f"{side}_{band}_amount"] = _money(
                f"sum(CASE WHEN {hit} AND {own} THEN {_cents('l_extendedprice')} ELSE 0 END)"
            )
    net = "CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END"
    out["net_mf_vol"] = f"sum(l_quantity * {net})"
    out["net_mf_amount"] = _money(f"sum({_cents('l_extendedprice')} * {net})")
    return out


_flow_sums = ", ".join(f"{expr} AS {name}" for name, expr in _flows().items())

VIEWS: dict[str, str] = {
    "v_daily": fill(
        "daily", f"({_changes(_bars('events', 'user_id', 'ts', 'event_id', 'value'))})",
        **_BAR_COLUMNS,
    ),
    "v_adjfactor": f"""
        SELECT CAST(user_id AS VARCHAR) AS ts_code, {_ymd('CAST(ts AS DATE)')} AS trade_date,
               1 + CAST(count(*) AS DOUBLE) / 100 AS adj_factor
        FROM events GROUP BY 1, 2""",
    "v_stock_basic": fill(
        "stock_basic", "customer LEFT JOIN nation ON c_nationkey = n_nationkey",
        ts_code="c_custkey", symbol="lpad(CAST(c_custkey AS VARCHAR), 6, '0')", name="c_name",
        area="n_name", industry="c_mktsegment", fullname="c_name || ' ' || n_name",
        cnspell="'cst' || c_custkey", market="'M' || n_regionkey",
        exchange="CASE WHEN n_regionkey IN (0, 1) THEN 'SSE' "
                 "WHEN n_regionkey IN (2, 3) THEN 'SZSE' ELSE 'BSE' END",
        curr_type="'CNY'", list_status="CASE WHEN c_acctbal < 0 THEN 'D' ELSE 'L' END",
        is_hs="CASE WHEN c_acctbal > 5000 THEN 'H' ELSE 'N' END",
    ),
    "v_securities": """
        SELECT CAST(p_partkey AS VARCHAR) AS ts_code,
               lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS symbol,
               CASE WHEN p_size > 40 THEN '*' ELSE '' END || p_type || ' ' || p_name AS name,
               CASE WHEN p_brand <> 'Brand#1' THEN p_brand END AS industry,
               CAST(NULL AS VARCHAR) AS list_date
        FROM part""",
    "v_st_stocks": """
        SELECT ts_code, symbol, name,
               CASE WHEN starts_with(name, '*ST') THEN '*ST' ELSE 'ST' END AS st_type,
               industry, list_date
        FROM v_securities WHERE contains(name, 'ST')""",
    "v_index_basic": fill(
        "index_basic",
        "supplier LEFT JOIN nation ON s_nationkey = n_nationkey "
        "LEFT JOIN region ON n_regionkey = r_regionkey",
        ts_code="'S' || s_suppkey", name="s_name", fullname="r_name || ' ' || s_name",
        market="CASE n_regionkey WHEN 0 THEN 'CSI' WHEN 1 THEN 'SSE' WHEN 2 THEN 'SZSE' "
               "WHEN 3 THEN 'MSCI' END",
        publisher="r_name", category="n_name", base_point="s_acctbal",
    ),
    "v_calendar_days": """
        SELECT exchange, d,
               CASE WHEN isodow(d) <= 5 AND NOT (day(d) = 1 AND exchange = 'SZSE')
                    THEN 1 ELSE 0 END AS is_open
        FROM (SELECT CAST(unnest(generate_series(lo - INTERVAL 31 DAY, hi + INTERVAL 31 DAY,
                                                 INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT CAST(min(t) AS DATE) AS lo, CAST(max(t) AS DATE) AS hi
                    FROM (SELECT ts AS t FROM events
                          UNION ALL SELECT o_orderdate FROM orders)))
        CROSS JOIN (VALUES ('SSE'), ('SZSE')) AS x(exchange)""",
    "v_trade_calendar": f"""
        SELECT exchange, {_ymd('d')} AS cal_date, CAST(is_open AS INTEGER) AS is_open,
               {_ymd("max(CASE WHEN is_open = 1 THEN d END) OVER (PARTITION BY exchange "
                     "ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")}
               AS pretrade_date
        FROM v_calendar_days""",
    "v_income": _statement(
        "income",
        basic_eps=f"{_money(_part())} / count(*)",
        total_revenue=_money(_part()),
        revenue=_money(_part("o_orderstatus <> 'P'")),
        total_cogs=_money(_part("o_orderstatus = 'P'")),
        operate_profit=_money(_part("o_orderstatus IN ('F', 'O')")),
        total_profit=_money(_part("o_orderstatus = 'O'")),
        n_income_attr_p=_money(_part("o_orderstatus = 'F'")),
    ),
    "v_cashflow": _statement(
        "cashflow",
        net_profit=_money(_part("o_orderstatus = 'F'")),
        n_cashflow_act=_money(_part("o_orderpriority = '1-URGENT'")),
        n_cashflow_inv_act=_money("-" + _part("o_orderpriority = '3-MEDIUM'")),
        n_cash_flows_fnc_act=_money(_part("o_orderpriority = '5-LOW'")),
        free_cashflow=_money(f"({_or_zero('1-URGENT')} - {_or_zero('3-MEDIUM')})"),
        c_cash_equ_beg_period=_money(_part("o_orderstatus = 'O'")),
        c_cash_equ_end_period=_money(_part("o_orderstatus IN ('F', 'O')")),
        n_incr_cash_cash_equ=_money(
            f"({_or_zero('1-URGENT')} - {_or_zero('3-MEDIUM')} + {_or_zero('5-LOW')})"
        ),
    ),
    "v_balancesheet": _statement(
        "balancesheet",
        total_assets=_money(_part()),
        total_cur_assets=_money(_part(_CURRENT)),
        total_nca=_money(_part(f"NOT ({_CURRENT})")),
        total_liab=_money(_part("o_orderstatus IN ('O', 'P')")),
        total_cur_liab=_money(f"coalesce({_part(_OPEN)}, 0)"),
        total_ncl=_money(_part("o_orderstatus = 'P'")),
        total_hldr_eqy_inc_min_int=_money(_part("o_orderstatus = 'F'")),
        money_cap=_money(_part("o_orderpriority = '1-URGENT'")),
        accounts_receiv=_money(_part("o_orderpriority = '2-HIGH'")),
        inventories=_money(_part("o_orderpriority = '3-MEDIUM'")),
        fix_assets=_money(_part("o_orderpriority = '4-NOT SPECIFIED'")),
        intang_assets=_money(_part("o_orderpriority = '5-LOW'")),
        st_borrow=_money(_part(f"o_orderstatus = 'O' AND {_CURRENT}")),
        lt_borrow=_money(_part(f"o_orderstatus = 'P' AND NOT ({_CURRENT})")),
    ),
    "v_revisions": fill(
        "income", "orders",
        ts_code="o_custkey", ann_date=_ymd("o_orderdate"), f_ann_date=_ymd("o_orderdate"),
        end_date=quarter_end("o_orderdate"), report_type="1", comp_type="o_orderpriority",
        update_flag="o_orderstatus", total_revenue="o_totalprice",
        n_income_attr_p="CASE WHEN o_orderstatus = 'F' THEN o_totalprice END",
    ),
    "v_moneyflow": fill(
        "moneyflow",
        f"""(SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, {_flow_sums}
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)""",
        ts_code="o_custkey", trade_date=_ymd("d"), **{name: name for name in _flows()},
    ),
    "v_segments": """
        SELECT c_custkey, c_mktsegment FROM customer
        WHERE c_mktsegment IN
            ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')""",
    "v_weights": f"""
        SELECT c_mktsegment AS seg, o_custkey AS cust, last_day(CAST(o_orderdate AS DATE)) AS m,
               sum({_cents('o_totalprice')}) AS own
        FROM orders JOIN v_segments ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
    "v_index_weight": f"""
        SELECT seg AS index_code, CAST(cust AS VARCHAR) AS con_code, {_ymd('m')} AS trade_date,
               CAST(100 AS DOUBLE) * CAST(own AS DOUBLE)
               / CAST(sum(own) OVER (PARTITION BY seg, m) AS DOUBLE) AS weight
        FROM v_weights""",
    "v_index_daily": fill(
        "index_daily",
        "(" + _changes(_bars(
            "orders JOIN v_segments ON o_custkey = c_custkey", "c_mktsegment", "o_orderdate",
            "o_orderkey", "o_totalprice")) + ")",
        **_BAR_COLUMNS,
    ),
}


def with_views(text: str) -> str:
    """Prefix ``text`` with the views it uses, directly or through other views."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\bv_\w+\b", sql):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(text)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    return f"WITH {ctes}\n{text}" if ctes else text
