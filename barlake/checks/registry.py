"""One registered query per operator, with the SQL text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.catalog import CATALOG, spec_of
from barlake.checks.bound import SEGMENTS, Before, BoundTables
from barlake.checks.oracle import quarter_end as q_quarter_end
from barlake.checks.oracle import with_views
from barlake.functions import (
    history_start, month_end, months_ago, next_day, previous_quarter_end, quarter_end, ymd,
)
from barlake.operators import coverage, days, merge, profile
from barlake.operators.export import export, export_slice
from barlake.plans import updates
from barlake.plans.market import Market
from barlake.plans.statements import BALANCE_COLUMNS, CASHFLOW_COLUMNS, latest_period
from barlake.session import scratch_folder
from barlake.sources.landing import (
    classify_st, concat_parts, income_of_code, landed_slice, listed_securities, normalise,
    read_landed,
)
from barlake.sources.store import Store
from barlake.streaming.bars import bars, start_bar_stream, utc_instant, with_changes
from barlake.streaming.landing import stream_upsert

# Parameters of the checks.
DAY, START, END = "20240115", "20240110", "20240120"
MONTH, CODE, PERIOD, QUARTER = "19981231", "7", "19991231", "19980630"
INDEX, MEMBER = "BUILDING", "82"
AS_OF = "20240215"
ORDERS_AS_OF = "20010720"


@dataclass(frozen=True)
class Check:
    run: Callable[[Market], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(Market(BoundTables(spark, folder)))


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None):
    """Register the decorated function of a :class:`Market` under ``name``."""
    def register(run):
        CHECKS[name] = Check(run, with_views(sql) if sql else None)
        return run

    return register


def _keep_last(source: str, key: tuple[str, ...], columns: list[str], newest=()) -> str:
    rest = [c for c in columns if c not in newest and c not in key]
    order = ", ".join(f'"{c}" DESC NULLS LAST' for c in [*newest, *rest])
    picked = ", ".join(f'"{c}"' for c in columns)
    return (
        f"SELECT {picked} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} "
        f"ORDER BY {order}) AS rn FROM ({source}) AS s) AS r WHERE rn = 1"
    )


def _merged(stored: str, fresh: str, key: tuple[str, ...]) -> str:
    same = " AND ".join(f"f.{c} IS NOT DISTINCT FROM s.{c}" for c in key)
    return (
        f"SELECT s.* FROM ({stored}) AS s WHERE NOT EXISTS "
        f"(SELECT 1 FROM ({fresh}) AS f WHERE {same}) UNION ALL ({fresh})"
    )


def _merged_table(stored: str, incoming: str, table: str) -> str:
    spec = spec_of(table)
    fresh = _keep_last(incoming, spec.key, spec.columns, spec.newest_first)
    return _merged(stored, fresh, spec.key)


# -- scans and reads -------------------------------------------------------------------------


@check("scan_daily", "SELECT * FROM v_daily")
def _(m):
    return m.tables.scan("daily")


_UNION = " UNION ALL ".join(
    f"SELECT * FROM {{0}} WHERE {{1}} = '{segment}'" for segment in SEGMENTS
)


@check("index_union", _UNION.format("v_index_daily", "ts_code"))
def _(m):
    return m.tables.index_union("index_daily")


@check("index_weight_union", _UNION.format("v_index_weight", "index_code"))
def _(m):
    return m.tables.index_union("index_weight")


@check("index_view", f"SELECT * FROM v_index_weight WHERE index_code = '{INDEX}'")
def _(m):
    return m.tables.index_view("index_weight", INDEX.lower())


@check("read_date_range",
       f"SELECT * FROM v_daily WHERE trade_date BETWEEN '{START}' AND '{END}'")
def _(m):
    return m.tables.read_daily(None, START, END)


@check("read_adjfactor",
       f"SELECT * FROM v_adjfactor WHERE trade_date BETWEEN '{START}' AND '{END}'")
def _(m):
    return m.tables.read_adjfactor(None, START, END)


@check("read_index_basic", "SELECT * FROM v_index_basic WHERE market = 'SSE'")
def _(m):
    return m.tables.read_index_basic("SSE")


@check("read_index_weight", f"""
    SELECT * FROM v_index_weight
    WHERE index_code = '{INDEX}' AND trade_date BETWEEN '19980101' AND '{MONTH}'""")
def _(m):
    return m.tables.read_index_weight(INDEX, "19980101", MONTH)


@check("read_index_daily", f"""
    SELECT * FROM v_index_daily
    WHERE ts_code = '{INDEX}' AND trade_date BETWEEN '19980101' AND '{MONTH}'""")
def _(m):
    return m.tables.read_index_daily(INDEX, "19980101", MONTH)


# -- landed rows -----------------------------------------------------------------------------


@check("ingest_normalise", f"""
    SELECT CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS index_code,
           CAST(l_partkey AS VARCHAR) AS con_code,
           strftime(l_shipdate, '%Y%m%d') AS trade_date,
           CASE WHEN l_discount <> 0 AND l_tax <> 0 THEN l_extendedprice END AS weight
    FROM lineitem""")
def _(m):
    # Texts that stand for null, and numbers that are none, in otherwise typed rows.
    flag = F.col("l_returnflag")
    raw = m.tables.raw("lineitem").select(
        F.when(flag == "N", "None").otherwise(flag).alias("index_code"),
        F.col("l_partkey").cast("string").alias("con_code"),
        ymd(F.col("l_shipdate")).alias("trade_date"),
        F.when(F.col("l_discount") == 0, "nan").when(F.col("l_tax") == 0, "n/a")
        .otherwise(F.col("l_extendedprice").cast("string")).alias("weight"),
    )
    return normalise(raw, "index_weight")


@check("listed_securities",
       "SELECT * FROM v_stock_basic WHERE list_status = 'L' AND exchange = 'SSE'")
def _(m):
    return listed_securities(m.tables.scan("stock_basic"), "SSE")


@check("concat_parts", "SELECT * FROM v_index_basic WHERE market IN ('CSI', 'SSE', 'SZSE')")
def _(m):
    master = m.tables.scan("index_basic")
    return concat_parts([
        landed_slice(master, "index_basic", AS_OF, market=market)
        for market in ("CSI", "SSE", "SZSE")
    ])


@check("st_classify", "SELECT * FROM v_st_stocks")
def _(m):
    return classify_st(m.tables.securities())


def _slice(name: str, table: str, where: str, as_of: str, **filters) -> None:
    @check(name, f"SELECT * FROM v_{table} WHERE {where}")
    def _(m):
        return landed_slice(m.tables.scan(table), table, as_of, **filters)


_HISTORY = "trade_date BETWEEN '20090218' AND '20240215'"  # 15 * 365 days back
_slice("slice_daily", "daily", f"ts_code = '{CODE}' AND {_HISTORY}", AS_OF, code=CODE)
_slice("slice_daily_date", "daily", f"trade_date = '{DAY}'", AS_OF, trade_date=DAY)
_slice("slice_stock_basic", "stock_basic", "list_status = 'L'", AS_OF)
_slice("slice_income", "income", "end_date = '20010930'", ORDERS_AS_OF)
_slice("slice_balancesheet", "balancesheet", f"end_date = '{PERIOD}'", AS_OF, period=PERIOD)
_slice("slice_cashflow", "cashflow", f"end_date = '{QUARTER}' AND ts_code = '{CODE}'", AS_OF,
       code=CODE, period=QUARTER)
_slice("slice_trade_calendar", "trade_calendar",
       "exchange = 'SZSE' AND cal_date BETWEEN '20090218' AND '20240215'", AS_OF, exchange="SZSE")
_slice("slice_adjfactor", "adjfactor", f"trade_date = '{DAY}'", AS_OF, trade_date=DAY)
_slice("slice_index_basic", "index_basic", "market = 'CSI'", AS_OF, market="CSI")
_slice("slice_index_weight", "index_weight",
       f"index_code = '{INDEX}' AND trade_date = '{MONTH}'", AS_OF, code=INDEX, trade_date=MONTH)
_slice("slice_index_daily", "index_daily",
       f"ts_code = '{INDEX}' AND trade_date BETWEEN '19860724' AND '{ORDERS_AS_OF}'",
       ORDERS_AS_OF, code=INDEX)
_slice("slice_moneyflow", "moneyflow", "trade_date BETWEEN '19980101' AND '19980131'", AS_OF,
       start="19980101", end="19980131")


@check("slice_income_code",
       f"SELECT * FROM v_income WHERE ts_code = '{CODE}' AND end_date = '{QUARTER}'")
def _(m):
    return income_of_code(m.tables.scan("income"), AS_OF, CODE, QUARTER)


# -- upsert, profile, export -----------------------------------------------------------------

_LINE_KEY = ("l_orderkey", "l_linenumber")
_LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _lines(status: str) -> str:
    source = f"SELECT * FROM lineitem WHERE l_linestatus = '{status}'"
    return _keep_last(source, _LINE_KEY, _LINE_COLUMNS, ("l_shipdate",))


@check("upsert_keep_last", _merged(_lines("F"), _lines("O"), _LINE_KEY))
def _(m):
    lines = m.tables.raw("lineitem")
    return merge.merge_keep_last(
        lines.where("l_linestatus = 'F'"), lines.where("l_linestatus = 'O'"),
        _LINE_KEY, ("l_shipdate",),
    )


@check("upsert_partitions", _merged_table(
    _keep_last("SELECT * FROM v_revisions WHERE update_flag <> 'O'", ("ts_code", "end_date"),
               spec_of("income").columns, spec_of("income").newest_first),
    "SELECT * FROM v_revisions WHERE update_flag = 'O'", "income"))
def _(m):
    # Two batches written to a stored table, the second over the first.
    store = _store(m, "upsert")
    revisions = m.tables.revisions()
    store.save_income(revisions.where("update_flag <> 'O'"))
    store.save_income(revisions.where("update_flag = 'O'"))
    return store.scan("income")


@check("stream_upsert", _keep_last(
    "SELECT * FROM v_revisions", ("ts_code", "end_date"), spec_of("income").columns,
    spec_of("income").newest_first))
def _(m):
    spark = m.tables.spark
    root = scratch_folder(spark, "stream")
    return stream_upsert(
        Store(spark, f"{root}/tables"), "income", m.tables.folder, f"{root}/checkpoint",
        read=lambda paths: spark.read.parquet(*paths), shape=m.tables.revisions,
        pathGlobFilter="orders.parquet",
    )


def _store(m: Market, name: str) -> Store:
    spark = m.tables.spark
    return Store(spark, scratch_folder(spark, name), m.tables.indices)


@check("upsert_daily",
       f"SELECT * FROM v_daily WHERE trade_date BETWEEN '{START}' AND '{END}'")
def _(m):
    # A first version of the later bars is stored, and then replaced by the whole table.
    store, rows = _store(m, "daily"), m.tables.scan("daily")
    store.save_daily(rows.where(F.col("trade_date") >= START).withColumn("vol", F.lit(0.0)))
    store.save_daily(rows)
    return store.read_daily(None, START, END)


@check("upsert_calendar", "SELECT * FROM v_trade_calendar WHERE cal_date >= '20000101'")
def _(m):
    store = _store(m, "calendar")
    store.save_trade_calendar(m.tables.scan("trade_calendar"))
    return store.read_trade_calendar(None, "20000101")


@check("upsert_master", """
    SELECT * REPLACE (CASE WHEN list_status = 'L' THEN name END AS act_name) FROM v_stock_basic""")
def _(m):
    store, master = _store(m, "master"), m.tables.scan("stock_basic")
    store.save_stock_basic(master)
    store.save_stock_basic(listed_securities(master).withColumn("act_name", F.col("name")))
    return store.read_stock_basic()


@check("upsert_index_weight", f"""
    SELECT * FROM v_index_weight
    WHERE index_code = '{INDEX}' AND trade_date BETWEEN '19980101' AND '{MONTH}'""")
def _(m):
    store = _store(m, "weights")
    store.save_index_weight(m.tables.scan("index_weight"), INDEX)
    return store.read_index_weight(INDEX, "19980101", MONTH)


def _exported(fmt: str) -> None:
    @check(f"export_{fmt}", "SELECT * FROM v_moneyflow")
    def _(m):
        # Written, read back as landed files and typed again.
        spark = m.tables.spark
        path = f"{scratch_folder(spark, 'export')}/{fmt}"
        export(m.tables.scan("moneyflow"), path, fmt)
        return normalise(read_landed(spark, path, fmt, "moneyflow"), "moneyflow")


for _fmt in ("csv", "json", "parquet"):
    _exported(_fmt)


_OHLCV = ("ts_code", "trade_date", "open", "high", "low", "close", "vol", "amount")


@check("stream_bars", "SELECT * FROM v_daily")
def _(m):
    spark = m.tables.spark
    root = scratch_folder(spark, "bars")
    store = Store(spark, f"{root}/tables")
    events = (
        spark.readStream.schema(m.tables.raw("events").schema)
        .option("pathGlobFilter", "events.parquet").parquet(m.tables.folder)
    )
    ticks = events.select(
        F.col("user_id").alias("code"), utc_instant(F.col("ts")).alias("ts"),
        F.col("event_id").alias("seq"), F.col("value").alias("price"),
        F.round(F.col("value") * 100, 0).cast("long").alias("cents"),
    )
    # The store holds earlier and same-day bars, from half of the ticks.
    store.save_daily(with_changes(bars(m.tables.ticks().where("seq % 2 = 0"))))
    start_bar_stream(ticks, store, f"{root}/checkpoint").awaitTermination()
    return store.scan("daily")


@check("bars_from_events", """
    SELECT ts_code, trade_date, open, high, low, close, vol, amount FROM v_daily""")
def _(m):
    rows = bars(m.tables.ticks())
    return rows.select(
        F.col("code").cast("string").alias("ts_code"), ymd(F.col("day")).alias("trade_date"),
        *_OHLCV[2:],
    )


@check("union_missing_columns", """
    SELECT ts_code, trade_date, adj_factor, CAST(NULL AS DOUBLE) AS close FROM v_adjfactor
    UNION ALL SELECT ts_code, trade_date, NULL, close FROM v_daily""")
def _(m):
    return concat_parts([
        m.tables.scan("adjfactor"),
        m.tables.scan("daily").select("ts_code", "trade_date", "close"),
    ])


@check("partition_profile", """
    SELECT 'index_daily' AS "table", trade_date AS partition, count(*) AS row_count
    FROM v_index_daily GROUP BY 2
    UNION ALL
    SELECT 'trade_calendar', substr(cal_date, 1, 4), count(*) FROM v_trade_calendar GROUP BY 2""")
def _(m):
    parts = [
        profile.partition_counts(m.tables.scan(t), profile.partition_label(t)).select(
            F.lit(t).alias("table"), "partition", "row_count")
        for t in ("index_daily", "trade_calendar")
    ]
    return profile.union_all(parts)


@check("export_slice",
       f"SELECT * FROM v_balancesheet WHERE end_date = '{PERIOD}'")
def _(m):
    return export_slice(m.tables, "balancesheet", period=PERIOD)


@check("record_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS row_count FROM v_{t}" for t in CATALOG))
def _(m):
    return m.record_counts()


def _described(table: str) -> str:
    fields = spec_of(table).schema.fields
    counts = ", ".join(f'count("{f.name}") AS "{f.name}"' for f in fields)
    kinds = ", ".join(
        f"({i}, '{f.name}', '{f.dataType.simpleString()}')" for i, f in enumerate(fields, 1)
    )
    return (
        f"SELECT '{table}' AS \"table\", CAST(position AS INTEGER) AS position, k.name AS "
        f"\"column\", k.kind AS \"type\", CAST(non_null AS BIGINT) AS non_null "
        f"FROM (VALUES {kinds}) AS k(position, name, kind) JOIN (UNPIVOT (SELECT {counts} "
        f"FROM v_{table}) ON COLUMNS(*) INTO NAME name VALUE non_null) AS u ON k.name = u.name"
    )


@check("table_schemas", " UNION ALL ".join(_described(t) for t in CATALOG))
def _(m):
    # The schemas next to the number of values each column really holds.
    filled = profile.union_all([
        profile.profile(m.tables.scan(t)).select(F.lit(t).alias("table"), "column", "non_null")
        for t in CATALOG
    ])
    schemas = m.get_schemas().drop("nullable")
    return filled.join(schemas, ["table", "column"]).select(
        "table", "position", "column", "type", "non_null"
    )


def _manifest_of(table: str) -> str:
    kind, spec = profile.PARTITION_KINDS[table], spec_of(table)
    label = {
        "by_date": spec.date_col, "by_index": spec.date_col,
        "by_year": f"substr({spec.date_col}, 1, 4)", "by_market": "market", "single": "1",
    }[kind]
    index = f"{spec.code_col}, " if kind == "by_index" else ""
    bounds = "NULL, NULL" if kind == "single" else "min(p), max(p)"
    return (
        f"SELECT '{table}', CAST(coalesce(sum(n), 0) AS BIGINT), count(*), '{kind}', {bounds} "
        f"FROM (SELECT {index}{label} AS p, count(*) AS n FROM v_{table} GROUP BY ALL) AS c"
    )


@check("manifest", """
    SELECT t AS "table", r AS "rows", c AS partitions, k AS kind,
           CAST(f AS VARCHAR) AS "first", CAST(l AS VARCHAR) AS "last"
    FROM (""" + " UNION ALL ".join(_manifest_of(t) for t in CATALOG) + ") AS x(t, r, c, k, f, l)")
def _(m):
    return m.manifest()


@check("profile_columns", """
    SELECT u.name AS "column", CAST(non_null AS BIGINT) AS non_null, d AS distinct_count
    FROM (UNPIVOT (SELECT count(ts_code) AS ts_code, count(name) AS name,
                          count(industry) AS industry, count(list_status) AS list_status,
                          count(list_date) AS list_date FROM v_stock_basic)
          ON COLUMNS(*) INTO NAME name VALUE non_null) AS u
    LEFT JOIN (SELECT 'ts_code' AS name, count(DISTINCT ts_code) AS d FROM v_stock_basic
               UNION ALL SELECT 'industry', count(DISTINCT industry) FROM v_stock_basic) AS x
    ON u.name = x.name""")
def _(m):
    rows = m.tables.scan("stock_basic").select(
        "ts_code", "name", "industry", "list_status", "list_date"
    )
    return profile.profile(rows, ["ts_code", "industry"])


# -- daily bars ------------------------------------------------------------------------------


@check("get_daily", f"""
    SELECT * FROM v_daily
    WHERE ts_code = '{CODE}' AND trade_date BETWEEN '{START}' AND '{END}'""")
def _(m):
    return m.get_daily(CODE, START, END)


@check("daily_latest",
       f"SELECT * FROM v_daily WHERE ts_code = '{CODE}' ORDER BY trade_date DESC LIMIT 1")
def _(m):
    return m.get_daily_latest(CODE)


@check("daily_latest_all", """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY ts_code ORDER BY trade_date DESC) AS rn FROM v_daily) WHERE rn = 1""")
def _(m):
    return m.daily_latest_all()


@check("top_volume", f"""
    SELECT d.ts_code, s.name, d.close, d.pct_chg, d.vol, d.amount
    FROM v_daily d LEFT JOIN v_stock_basic s ON d.ts_code = s.ts_code
    WHERE d.trade_date = '{DAY}' ORDER BY d.amount DESC NULLS LAST, d.ts_code LIMIT 10""")
def _(m):
    return m.top_volume(DAY, 10)


def _price_change(direction: str) -> str:
    return f"""
    SELECT f.ts_code, s.name, f.close AS close_first, l.close AS close_last,
           round((l.close - f.close) / nullif(f.close, 0) * 100, 2) AS cum_return_pct
    FROM v_daily f JOIN v_daily l ON f.ts_code = l.ts_code
    LEFT JOIN v_stock_basic s ON f.ts_code = s.ts_code
    WHERE f.trade_date = '{START}' AND l.trade_date = '{END}'
    ORDER BY cum_return_pct {direction} NULLS LAST, f.ts_code LIMIT 20"""


@check("price_change_rank", _price_change("DESC"))
def _(m):
    return m.price_change_rank(START, END)


@check("price_change_rank_asc", _price_change("ASC"))
def _(m):
    return m.price_change_rank(START, END, ascending=True)


@check("sector_performance", f"""
    SELECT s.industry, count(*) AS stock_count, round(avg(d.pct_chg), 2) AS avg_pct_chg,
           round(avg(d.amount), 0) AS avg_amount
    FROM v_daily d JOIN v_stock_basic s ON d.ts_code = s.ts_code
    WHERE d.trade_date = '{DAY}' AND s.industry IS NOT NULL GROUP BY s.industry""")
def _(m):
    return m.sector_performance(DAY)


@check("trading_dates",
       "SELECT DISTINCT trade_date FROM v_daily ORDER BY trade_date DESC LIMIT 10")
def _(m):
    return m.trading_dates(10)


@check("stored_months", "SELECT DISTINCT substr(trade_date, 1, 6) AS ym FROM v_moneyflow")
def _(m):
    return m.stored_months("moneyflow")


@check("raw_latest_top", """
    SELECT ts_code, trade_date, close, pct_chg, amount FROM v_daily
    WHERE trade_date = (SELECT max(trade_date) FROM v_daily)
    ORDER BY amount DESC, ts_code LIMIT 10""")
def _(m):
    return m.raw_sql("""
        SELECT ts_code, trade_date, close, pct_chg, amount FROM daily_view
        WHERE trade_date = (SELECT max(trade_date) FROM daily_view)
        ORDER BY amount DESC, ts_code LIMIT 10""")


@check("raw_latest_join", """
    SELECT d.ts_code, s.name, s.industry, d.trade_date, d.close, d.pct_chg, d.amount
    FROM v_daily d LEFT JOIN v_stock_basic s ON d.ts_code = s.ts_code
    WHERE d.trade_date = (SELECT max(trade_date) FROM v_daily) AND s.industry IS NOT NULL
    ORDER BY d.amount DESC, d.ts_code LIMIT 20""")
def _(m):
    return m.raw_sql("""
        SELECT d.ts_code, s.name, s.industry, d.trade_date, d.close, d.pct_chg, d.amount
        FROM daily_view d LEFT JOIN stock_basic_view s ON d.ts_code = s.ts_code
        WHERE d.trade_date = (SELECT max(trade_date) FROM daily_view)
          AND s.industry IS NOT NULL
        ORDER BY d.amount DESC, d.ts_code LIMIT 20""")


# -- security master and special treatment -----------------------------------------------------


@check("get_stock_info", "SELECT * FROM v_stock_basic")
def _(m):
    return m.get_stock_info()


@check("search_stock", """
    SELECT ts_code, symbol, name, area, industry, list_date, is_hs FROM v_stock_basic
    WHERE name LIKE '%T_1%' OR symbol LIKE '%T_1%' OR upper(cnspell) LIKE '%T_1%'""")
def _(m):
    return m.search_stock("t_1")


@check("industry_stocks", """
    SELECT ts_code, symbol, name, area, list_date FROM v_stock_basic
    WHERE industry = 'BUILDING'""")
def _(m):
    return m.industry_stocks("BUILDING")


@check("stocks_by_market", """
    SELECT ts_code, symbol, name, area, industry, list_date FROM v_stock_basic
    WHERE market = 'M2'""")
def _(m):
    return m.filter_stocks_by_market("M2")


@check("stocks_by_industry", """
    SELECT industry, count(*) AS stock_count FROM v_stock_basic
    WHERE industry = 'BUILDING' GROUP BY industry""")
def _(m):
    return m.stocks_by_industry("BUILDING")


@check("reconcile_codes", """
    SELECT CAST(o_custkey AS VARCHAR) AS code FROM orders
    WHERE o_custkey NOT IN (SELECT user_id FROM events)""")
def _(m):
    probe = m.tables.raw("orders").select(F.col("o_custkey").cast("string").alias("code"))
    return coverage.codes_not_in(probe, m.tables.scan("daily"), "code", "ts_code")


@check("get_st_stocks", "SELECT * FROM v_st_stocks")
def _(m):
    return m.get_st_stocks()


@check("st_by_type", """
    SELECT ts_code, symbol, name, industry, list_date FROM v_st_stocks WHERE st_type = '*ST'""")
def _(m):
    return m.get_st_stocks_by_type("*ST")


@check("st_by_industry", """
    SELECT industry, count(*) AS st_count FROM v_st_stocks
    WHERE industry IS NOT NULL GROUP BY industry""")
def _(m):
    return m.st_stocks_by_industry()


# -- statements and money flow -----------------------------------------------------------------


@check("get_income", f"""
    SELECT * FROM v_income
    WHERE ts_code = '{CODE}' AND end_date BETWEEN '19970331' AND '{PERIOD}'""")
def _(m):
    return m.get_income(CODE, "19970331", PERIOD)


@check("get_balancesheet", f"SELECT * FROM v_balancesheet WHERE ts_code = '{CODE}'")
def _(m):
    return m.get_balancesheet(CODE)


@check("get_cashflow",
       f"SELECT * FROM v_cashflow WHERE ts_code = '{CODE}' AND end_date >= '19970331'")
def _(m):
    return m.get_cashflow(CODE, "19970331")


_LATEST = """
    SELECT t.* FROM {0} t JOIN (
        SELECT ts_code, max(end_date) AS max_end_date FROM {0}
        WHERE end_date <= '{1}' GROUP BY ts_code) l
    ON t.ts_code = l.ts_code AND t.end_date = l.max_end_date"""


def _net_profit(m: Market) -> DataFrame:
    return m.roe_rank(PERIOD)


_NET_PROFIT = f"""
    SELECT f.ts_code, s.name, f.end_date,
           round(f.n_income_attr_p / 10000.0, 2) AS net_profit_yi, f.basic_eps,
           f.total_revenue, f.operate_profit, f.total_profit
    FROM ({_LATEST.format('v_income', PERIOD)}) f
    LEFT JOIN v_stock_basic s ON f.ts_code = s.ts_code
    WHERE f.n_income_attr_p IS NOT NULL
    ORDER BY f.n_income_attr_p DESC, f.ts_code, f.end_date LIMIT 20"""
check("net_profit_rank", _NET_PROFIT)(_net_profit)
check("roe_rank", _NET_PROFIT)(_net_profit)


@check("asset_rank", f"""
    SELECT b.ts_code, s.name, b.end_date,
           round(b.total_assets / 100000000.0, 2) AS total_assets_yi,
           round(b.total_liab / 100000000.0, 2) AS total_liab_yi,
           round(b.total_hldr_eqy_inc_min_int / 100000000.0, 2) AS total_equity_yi,
           round(b.total_liab / nullif(b.total_assets, 0) * 100, 2) AS debt_ratio_pct
    FROM ({_LATEST.format('v_balancesheet', PERIOD)}) b
    LEFT JOIN v_stock_basic s ON b.ts_code = s.ts_code
    WHERE b.total_assets IS NOT NULL
    ORDER BY b.total_assets DESC, b.ts_code, b.end_date LIMIT 20""")
def _(m):
    return m.asset_rank(PERIOD)


@check("latest_period", f"""
    SELECT ts_code, max(end_date) AS max_end_date FROM v_income
    WHERE end_date <= '{PERIOD}' GROUP BY ts_code""")
def _(m):
    return m.latest_periods("income", PERIOD)


@check("latest_period_rows", _LATEST.format("v_cashflow", PERIOD))
def _(m):
    return latest_period(m.tables.scan("cashflow"), PERIOD)


@check("income_summary",
       f"SELECT * FROM v_income WHERE ts_code = '{CODE}' ORDER BY end_date DESC LIMIT 8")
def _(m):
    return m.income_summary(CODE)


_BALANCE = ", ".join(BALANCE_COLUMNS) + """,
    round(total_cur_assets / nullif(total_cur_liab, 0), 2) AS current_ratio,
    round(total_liab / nullif(total_assets, 0) * 100, 2) AS debt_ratio_pct"""


@check("balancesheet_summary", f"""
    SELECT {_BALANCE} FROM v_balancesheet WHERE ts_code = '{CODE}'
    ORDER BY end_date DESC LIMIT 8""")
def _(m):
    return m.balancesheet_summary(CODE)


@check("balance_ratios", f"""
    SELECT {_BALANCE} FROM (SELECT *, row_number() OVER (
        PARTITION BY ts_code ORDER BY end_date DESC) AS rn FROM v_balancesheet) WHERE rn <= 8""")
def _(m):
    return m.balance_ratios()


@check("cashflow_summary", f"""
    SELECT {', '.join(CASHFLOW_COLUMNS)} FROM v_cashflow WHERE ts_code = '{CODE}'
    ORDER BY end_date DESC LIMIT 8""")
def _(m):
    return m.cashflow_summary(CODE)


@check("get_moneyflow", f"""
    SELECT * FROM v_moneyflow
    WHERE ts_code = '{CODE}' AND trade_date BETWEEN '19960101' AND '{PERIOD}'""")
def _(m):
    return m.get_moneyflow(CODE, "19960101", PERIOD)


@check("moneyflow_rank", """
    SELECT m.ts_code, s.name, m.net_mf_amount, m.net_mf_vol, m.buy_lg_amount, m.sell_lg_amount,
           m.buy_elg_amount, m.sell_elg_amount
    FROM v_moneyflow m LEFT JOIN v_stock_basic s ON m.ts_code = s.ts_code
    WHERE m.trade_date = '19980115'
    ORDER BY m.net_mf_amount DESC NULLS LAST, m.ts_code LIMIT 20""")
def _(m):
    return m.moneyflow_rank("19980115")


@check("moneyflow_summary", f"""
    SELECT * FROM v_moneyflow WHERE ts_code = '{CODE}' ORDER BY trade_date DESC LIMIT 20""")
def _(m):
    return m.moneyflow_summary(CODE)


# -- indices -----------------------------------------------------------------------------------


@check("get_index_basic", "SELECT * FROM v_index_basic")
def _(m):
    return m.get_index_basic()


@check("search_index", """
    SELECT ts_code, name, fullname, market, publisher, index_type, category, base_date,
           base_point, list_date, weight_rule
    FROM v_index_basic
    WHERE upper(name) LIKE '%ASIA%' OR upper(fullname) LIKE '%ASIA%'
       OR upper(ts_code) LIKE '%ASIA%'""")
def _(m):
    return m.search_index("asia")


@check("index_count_by_market",
       "SELECT market, count(*) AS index_count FROM v_index_basic GROUP BY market")
def _(m):
    return m.index_count_by_market()


@check("index_count_by_category", """
    SELECT market, category, count(*) AS index_count FROM v_index_basic
    GROUP BY market, category""")
def _(m):
    return m.index_count_by_category()


@check("index_count_by_category_in_market", """
    SELECT market, category, count(*) AS index_count FROM v_index_basic
    WHERE market = 'SSE' GROUP BY market, category""")
def _(m):
    return m.index_count_by_category("SSE")


@check("get_index_weight", f"""
    SELECT * FROM v_index_weight WHERE index_code = '{INDEX}' AND trade_date = '{MONTH}'""")
def _(m):
    return m.get_index_weight(INDEX, MONTH)


@check("index_weight_latest", f"""
    SELECT * FROM v_index_weight WHERE index_code = '{INDEX}' AND trade_date = (
        SELECT max(trade_date) FROM v_index_weight WHERE index_code = '{INDEX}')""")
def _(m):
    return m.index_weight_latest(INDEX)


@check("index_top_weights", f"""
    SELECT * FROM v_index_weight WHERE index_code = '{INDEX}' AND trade_date = '{MONTH}'
    ORDER BY weight DESC NULLS LAST, con_code LIMIT 10""")
def _(m):
    return m.index_top_weights(INDEX, MONTH)


@check("index_weight_summary", """
    SELECT index_code, trade_date, count(*) AS constituent_count,
           round(sum(weight), 4) AS total_weight, round(avg(weight), 6) AS avg_weight,
           round(max(weight), 4) AS max_weight, round(min(weight), 6) AS min_weight
    FROM v_index_weight GROUP BY index_code, trade_date""")
def _(m):
    return m.index_weight_summary()


@check("search_constituent", f"""
    SELECT DISTINCT index_code, trade_date, weight FROM v_index_weight
    WHERE con_code = '{MEMBER}'""")
def _(m):
    return m.search_constituent(MEMBER)


@check("search_constituent_in_index", f"""
    SELECT DISTINCT index_code, trade_date, weight FROM v_index_weight
    WHERE con_code = '{MEMBER}' AND index_code = '{INDEX}'
    ORDER BY trade_date DESC, index_code LIMIT 5""")
def _(m):
    return m.search_constituent_in_index(MEMBER, INDEX, 5)


@check("constituent_history", f"""
    SELECT index_code, trade_date, weight FROM v_index_weight
    WHERE con_code = '{MEMBER}' AND index_code = '{INDEX}'""")
def _(m):
    return m.constituent_history(MEMBER, INDEX)


_CONSTITUENTS = """
    SELECT index_code, max(n) AS constituents FROM (
        SELECT index_code, trade_date, count(con_code) AS n FROM v_index_weight
        GROUP BY index_code, trade_date) GROUP BY index_code"""


@check("max_constituents", _CONSTITUENTS)
def _(m):
    return m.max_constituents()


@check("get_index_daily", "SELECT * FROM v_index_daily WHERE trade_date >= '20000101'")
def _(m):
    return m.get_index_daily(None, "20000101")


@check("index_daily_latest", f"""
    SELECT * FROM v_index_daily WHERE ts_code = '{INDEX}' ORDER BY trade_date DESC LIMIT 1""")
def _(m):
    return m.get_index_daily_latest(INDEX)


@check("index_daily_latest_all", """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY ts_code ORDER BY trade_date DESC) AS rn FROM v_index_daily) WHERE rn = 1""")
def _(m):
    return m.index_daily_latest_all()


@check("index_performance_rank", """
    SELECT ts_code, trade_date, close, open, high, low, pct_chg, vol, amount
    FROM v_index_daily WHERE trade_date = '19980115'
    ORDER BY pct_chg DESC NULLS LAST, ts_code LIMIT 10""")
def _(m):
    return m.index_performance_rank("19980115")


@check("index_cumulative_return", f"""
    SELECT s.ts_code, s.trade_date AS start_date, s.close AS start_close,
           e.trade_date AS end_date, e.close AS end_close,
           round((e.close - s.close) / nullif(s.close, 0) * 100, 2) AS cum_return_pct
    FROM v_index_daily s JOIN v_index_daily e ON s.ts_code = e.ts_code
    WHERE s.ts_code = '{INDEX}' AND s.trade_date = '19980115' AND e.trade_date = '19980625'""")
def _(m):
    return m.index_cumulative_return(INDEX, "19980115", "19980625")


# -- calendar ------------------------------------------------------------------------------------


@check("get_trade_calendar", """
    SELECT * FROM v_trade_calendar
    WHERE exchange = 'SZSE' AND cal_date BETWEEN '19990101' AND '19991231'""")
def _(m):
    return m.get_trade_calendar("19990101", "19991231", "SZSE")


def _order_dates(m: Market) -> DataFrame:
    return m.tables.raw("orders").select(ymd(F.col("o_orderdate")).alias("date")).distinct()


_ORDER_DATES = "(SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS date, o_orderdate AS d FROM orders)"


@check("is_trading_day", f"""
    SELECT o.date, coalesce(c.is_open, 0) = 1 AS is_trading_day
    FROM {_ORDER_DATES} o LEFT JOIN v_trade_calendar c
    ON o.date = c.cal_date AND c.exchange = 'SZSE'""")
def _(m):
    return days.trading_day_flags(_order_dates(m), m.tables.scan("trade_calendar"), "SZSE")


@check("next_trading_day", f"""
    SELECT o.date, (SELECT min(cal_date) FROM v_trade_calendar c
                    WHERE c.exchange = 'SSE' AND c.is_open = 1 AND c.cal_date >= o.date)
           AS next_trading_day
    FROM {_ORDER_DATES} o""")
def _(m):
    return days.next_open_days(_order_dates(m), m.tables.scan("trade_calendar"))


@check("trading_days_count", f"""
    SELECT r.start_date, r.end_date, count(c.cal_date) AS trading_days
    FROM (SELECT date AS start_date, {q_quarter_end('d')} AS end_date FROM {_ORDER_DATES}) r
    LEFT JOIN v_trade_calendar c ON c.exchange = 'SSE' AND c.is_open = 1
         AND c.cal_date BETWEEN r.start_date AND r.end_date
    GROUP BY 1, 2""")
def _(m):
    ranges = _order_dates(m).select(
        F.col("date").alias("start_date"), quarter_end(F.col("date")).alias("end_date")
    )
    return days.open_day_counts(ranges, m.tables.scan("trade_calendar"))


@check("last_n_trading_days", f"""
    SELECT DISTINCT cal_date FROM v_trade_calendar
    WHERE exchange = 'SSE' AND is_open = 1 AND cal_date <= '{AS_OF}'
    ORDER BY cal_date DESC LIMIT 10""")
def _(m):
    return m.last_n_trading_days(AS_OF, 10)


@check("quarter_end", f"""
    SELECT date, {q_quarter_end('d')} AS quarter_end,
           {q_quarter_end('(d - INTERVAL 3 MONTH)')} AS previous_quarter_end
    FROM {_ORDER_DATES}""")
def _(m):
    date = F.col("date")
    return _order_dates(m).select(
        date, quarter_end(date).alias("quarter_end"),
        previous_quarter_end(date).alias("previous_quarter_end"),
    )


@check("months_ago", f"""
    SELECT date, strftime(d - INTERVAL 1 MONTH, '%Y%m%d') AS one_month_ago,
           strftime(d - INTERVAL 3 MONTH, '%Y%m%d') AS three_months_ago,
           strftime(d + INTERVAL 1 DAY, '%Y%m%d') AS next_day
    FROM {_ORDER_DATES}""")
def _(m):
    date = F.col("date")
    return _order_dates(m).select(
        date, months_ago(date, 1).alias("one_month_ago"),
        months_ago(date, 3).alias("three_months_ago"), next_day(date).alias("next_day"),
    )


@check("history_start", f"""
    SELECT date, strftime(d - INTERVAL 5475 DAY, '%Y%m%d') AS history_start FROM {_ORDER_DATES}""")
def _(m):
    date = F.col("date")
    return _order_dates(m).select(date, history_start(date, 15).alias("history_start"))


def _order_years(m: Market) -> DataFrame:
    year = F.year("o_orderdate")
    return m.tables.raw("orders").agg(
        F.min(year).alias("start_year"), F.max(year).alias("end_year")
    )


@check("quarter_series", f"""
    SELECT end_date FROM (
        SELECT strftime(last_day(unnest(generate_series(make_date(lo, 3, 31),
               make_date(hi, 12, 31), INTERVAL 3 MONTH))), '%Y%m%d') AS end_date
        FROM (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders))
    WHERE end_date <= '{ORDERS_AS_OF}'""")
def _(m):
    return days.quarter_series(_order_years(m), ORDERS_AS_OF)


@check("month_ends", f"""
    SELECT DISTINCT month_end FROM (
        SELECT strftime(last_day(CAST(unnest(generate_series(make_date(lo, 1, 1),
               make_date(hi, 12, 1), INTERVAL 1 MONTH)) AS DATE)), '%Y%m%d') AS month_end
        FROM (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders))
    WHERE month_end <= '{ORDERS_AS_OF}'""")
def _(m):
    return days.month_ends(_order_years(m), ORDERS_AS_OF)


_BATCH_AS_OF = "19991115"
_BATCHES = f"""
    SELECT index_code, k AS months, strftime(s, '%Y%m%d') AS batch_start,
           least(strftime(last_day(CAST(s + to_months(k - 1) AS DATE)), '%Y%m%d'),
                 '{_BATCH_AS_OF}') AS batch_end
    FROM (SELECT index_code, k, unnest(generate_series(DATE '1994-01-01', DATE '1999-11-15',
                                                       to_months(k))) AS s
          FROM (SELECT index_code, CAST(greatest(1, least(12, 6000 // constituents)) AS INTEGER)
                       AS k FROM ({_CONSTITUENTS})))"""


def _batches(m: Market) -> DataFrame:
    return days.month_batches(m.max_constituents(), _BATCH_AS_OF, 5, max_rows=6000)


check("month_batches", _BATCHES)(_batches)


@check("months_in_range", """
    SELECT priority, start_date, end_date,
           strftime(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)),
                    '%Y%m') AS ym
    FROM (SELECT o_orderpriority AS priority, min(o_orderdate) AS lo, max(o_orderdate) AS hi,
                 strftime(min(o_orderdate), '%Y%m%d') AS start_date,
                 strftime(max(o_orderdate), '%Y%m%d') AS end_date
          FROM orders GROUP BY 1)""")
def _(m):
    ranges = m.tables.raw("orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(
        ymd(F.min("o_orderdate")).alias("start_date"), ymd(F.max("o_orderdate")).alias("end_date")
    )
    return days.months_in_range(ranges, "start_date", "end_date")


# -- coverage and updates ------------------------------------------------------------------------

_OPEN = "SELECT DISTINCT cal_date FROM v_trade_calendar WHERE exchange = 'SSE' AND is_open = 1"


def _gap(wanted: str, table: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", cal_date AS trade_date FROM ({wanted}) AS w "
        f"WHERE cal_date NOT IN (SELECT trade_date FROM v_{table})"
    )


def _gaps(wanted: str) -> str:
    return " UNION ALL ".join(_gap(wanted, t) for t in ("daily", "adjfactor", "moneyflow"))


def _stored(m: Market) -> dict[str, DataFrame]:
    return {t: m.tables.scan(t) for t in ("daily", "adjfactor", "moneyflow")}


@check("missing_dates", f"""
    SELECT cal_date AS trade_date FROM ({_OPEN}) AS w
    WHERE cal_date NOT IN (SELECT trade_date FROM v_moneyflow)""")
def _(m):
    wanted = days.open_days(m.tables.scan("trade_calendar"))
    return coverage.missing_dates(wanted, m.tables.scan("moneyflow"))


@check("gap_plan_months", _gaps(f"{_OPEN} AND cal_date BETWEEN '20231115' AND '{AS_OF}'"))
def _(m):
    wanted = coverage.wanted_by_months(m.tables.scan("trade_calendar"), AS_OF, 3)
    return coverage.gaps_by_table(wanted, _stored(m))


@check("gap_plan_days", _gaps(
    f"SELECT * FROM ({_OPEN} AND cal_date <= '{AS_OF}' ORDER BY cal_date DESC LIMIT 20)"))
def _(m):
    wanted = coverage.wanted_by_days(m.tables.scan("trade_calendar"), AS_OF, 20)
    return coverage.gaps_by_table(wanted, _stored(m))


@check("gap_plan_full", _gaps(_OPEN))
def _(m):
    wanted = days.open_days(m.tables.scan("trade_calendar"))
    return coverage.gaps_by_table(wanted, _stored(m))


@check("gap_plan_no_calendar", _gaps(f"""
    SELECT strftime(unnest(generate_series(DATE '2024-02-15' - INTERVAL 61 DAY,
           DATE '2024-02-15', INTERVAL 1 DAY)), '%Y%m%d') AS cal_date"""))
def _(m):
    # BSE has no calendar rows, so every calendar day of the window is wanted.
    wanted = coverage.wanted_by_months(m.tables.scan("trade_calendar"), AS_OF, 2, "BSE")
    return coverage.gaps_by_table(wanted, _stored(m))


@check("new_rows_only", f"""
    SELECT * FROM v_index_weight w WHERE NOT EXISTS (
        SELECT 1 FROM v_index_weight s WHERE s.trade_date < '{MONTH}'
        AND s.index_code = w.index_code AND s.trade_date = w.trade_date)""")
def _(m):
    rows = m.tables.scan("index_weight")
    stored = Before(m.tables, MONTH).scan("index_weight")
    return coverage.new_index_rows(rows, stored, "index_code")


def _batch_months(source: str) -> str:
    return f"""
        SELECT b.*, strftime(unnest(generate_series(
            date_trunc('month', strptime(batch_start, '%Y%m%d')),
            strptime(batch_end, '%Y%m%d'), INTERVAL 1 MONTH)), '%Y%m') AS ym
        FROM ({source}) AS b"""


def _uncovered(stored: str) -> str:
    return f"""
        SELECT DISTINCT index_code, months, batch_start, batch_end
        FROM ({_batch_months(_BATCHES)}) AS b WHERE NOT EXISTS (
            SELECT 1 FROM ({stored}) AS s
            WHERE s.index_code = b.index_code AND s.ym = b.ym)"""


@check("uncovered_batches", _uncovered("""
    SELECT DISTINCT index_code, substr(trade_date, 1, 6) AS ym FROM v_index_weight
    WHERE trade_date NOT BETWEEN '19970301' AND '19970430'"""))
def _(m):
    date = F.col("trade_date")
    stored = m.tables.scan("index_weight").where(~date.between("19970301", "19970430"))
    months = stored.select("index_code", F.substring(date, 1, 6).alias("ym")).distinct()
    return coverage.uncovered_batches(_batches(m), months)


_CUT = "19961215"


@check("index_weight_full", f"""
    SELECT w.* FROM v_index_weight w JOIN ({_batch_months(_uncovered(
        "SELECT DISTINCT index_code, substr(trade_date, 1, 6) AS ym FROM v_index_weight "
        f"WHERE trade_date < '{_CUT}'"))}) AS b
    ON w.index_code = b.index_code AND substr(w.trade_date, 1, 6) = b.ym
       AND w.trade_date <= b.batch_end""")
def _(m):
    return updates.index_weight_full_rows(
        m.tables.scan("index_weight"), Before(m.tables, _CUT).scan("index_weight"), _batches(m)
    )


@check("index_weight_incremental", f"""
    SELECT * FROM v_index_weight
    WHERE trade_date BETWEEN '19980930' AND '{MONTH}' AND trade_date >= '19981115'""")
def _(m):
    return updates.index_incremental_rows(
        m.tables.scan("index_weight"), Before(m.tables, "19981115").scan("index_weight"),
        "index_code", MONTH,
    )


@check("index_daily_incremental", f"""
    SELECT * FROM v_index_daily
    WHERE trade_date BETWEEN '19980930' AND '{MONTH}' AND trade_date >= '19981115'""")
def _(m):
    return updates.index_incremental_rows(
        m.tables.scan("index_daily"), Before(m.tables, "19981115").scan("index_daily"),
        "ts_code", MONTH,
    )


@check("index_daily_full", f"""
    SELECT * FROM v_index_daily
    WHERE trade_date BETWEEN '19860101' AND '{ORDERS_AS_OF}' AND trade_date >= '{MONTH}'""")
def _(m):
    return updates.index_daily_full_rows(
        m.tables.scan("index_daily"), Before(m.tables, MONTH).scan("index_daily"), ORDERS_AS_OF
    )


@check("statement_refresh", _merged_table(
    "SELECT * FROM v_income",
    "SELECT * FROM v_revisions WHERE end_date IN ('20010930', '20010630')", "income"))
def _(m):
    incoming = updates.statement_refresh_rows(m.tables.revisions(), ORDERS_AS_OF)
    return merge.merge_table(m.tables.scan("income"), incoming, "income", stored_is_unique=True)


@check("statement_full", _merged_table(
    "SELECT * FROM v_income WHERE end_date < '19970101'",
    "SELECT * FROM v_revisions WHERE end_date BETWEEN '19850331' AND '20000815'", "income"))
def _(m):
    stored = Before(m.tables, "19970101").scan("income")
    incoming = updates.statement_full_rows(m.tables.revisions(), "20000815")
    return merge.merge_table(stored, incoming, "income", stored_is_unique=True)


@check("master_refresh", _merged(
    "SELECT * FROM v_stock_basic",
    "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS is_hs, name AS act_name) FROM v_stock_basic "
    "WHERE list_status = 'L'", ("ts_code",)))
def _(m):
    master = m.tables.scan("stock_basic")
    # The landed master lost a value: the whole row is replaced, null included.
    landed = master.withColumn("is_hs", F.lit(None).cast("string")).withColumn(
        "act_name", F.col("name"))
    incoming = updates.master_refresh_rows(landed)
    return merge.merge_table(master, incoming, "stock_basic", stored_is_unique=True)


@check("calendar_refresh", f"""
    SELECT * FROM v_trade_calendar WHERE cal_date < '20231201'
       OR cal_date BETWEEN '20231115' AND '{AS_OF}'""")
def _(m):
    stored = Before(m.tables, "20231201").scan("trade_calendar")
    incoming = updates.calendar_refresh_rows(m.tables.scan("trade_calendar"), AS_OF, 3)
    return merge.merge_table(stored, incoming, "trade_calendar", stored_is_unique=True)


_FLOW_CUT = "20010601"


class _Stored(Before):
    """Data up to a cut-off, with the whole calendar."""

    def scan(self, table, code=None, start=None, end=None, dates=None) -> DataFrame:
        source = self.tables if table == "trade_calendar" else super()
        return source.scan(table, code, start, end, dates)

    def given(self, table, start=None, end=None) -> DataFrame:
        source = self.tables if table == "trade_calendar" else super()
        return source.given(table, start, end)


def _summary() -> str:
    """Rows that an update of three months takes where all is stored up to the cut-off."""
    window = f"BETWEEN '20010420' AND '{ORDERS_AS_OF}'"
    texts = {
        "trade_calendar": f"FROM v_trade_calendar WHERE cal_date {window}",
        "stock_basic": "FROM v_stock_basic WHERE list_status = 'L'",
        "st_stocks": "FROM v_st_stocks",
        "index_basic": "FROM v_index_basic WHERE market IN ('CSI', 'SSE', 'SZSE')",
    }
    for t in ("daily", "adjfactor", "moneyflow"):
        texts[t] = (
            f"FROM v_{t} WHERE trade_date IN ({_OPEN} AND cal_date {window}) AND trade_date "
            f"NOT IN (SELECT trade_date FROM v_{t} WHERE trade_date < '{_FLOW_CUT}')"
        )
    for t in ("income", "cashflow", "balancesheet"):
        texts[t] = f"FROM v_{t} WHERE end_date IN ('20010930', '20010630')"
    for t in ("index_weight", "index_daily"):
        texts[t] = f"FROM v_{t} WHERE trade_date {window} AND trade_date >= '{_FLOW_CUT}'"
    return " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS \"rows\" {text}" for t, text in texts.items()
    )


@check("update_summary", _summary())
def _(m):
    stored = _Stored(m.tables, _FLOW_CUT)
    return updates.update_summary(updates.incremental_steps(m.tables, stored, ORDERS_AS_OF, 3))


@check("month_end", f"""
    SELECT date, strftime(last_day(CAST(d AS DATE)), '%Y%m%d') AS month_end
    FROM {_ORDER_DATES}""")
def _(m):
    date = F.col("date")
    return _order_dates(m).select(date, month_end(date).alias("month_end"))
