"""The twelve market tables as views over the given tables.

customer is the security master, events are ticks, orders are statement revisions and index
trades, lineitem is money flow, supplier is the index master and part the special-treatment
list. Amounts are summed in cents, which makes every sum exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.catalog import spec_of
from barlake.functions import cents, quarter_end, ymd
from barlake.operators.merge import conform
from barlake.sources.landing import classify_st
from barlake.sources.tables import Tables
from barlake.streaming.bars import bars, with_changes

# Market segments stand for the tracked indices.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
# The given tables. Reading them with a schema saves a pass over file footers.
RAW_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}
URGENT, HIGH, MEDIUM, UNSPECIFIED, LOW = (
    "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"
)


def _midnight(text: str) -> Column:
    """``yyyyMMdd`` as a zone-free timestamp literal, which Parquet can compare with."""
    return F.lit(f"{text[:4]}-{text[4:6]}-{text[6:]} 00:00:00").cast("timestamp_ntz")


def _within(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    if start:
        df = df.where(F.col(column) >= _midnight(start))
    if end:
        one_day = F.make_dt_interval(F.lit(1))
        df = df.where(F.col(column) < _midnight(end) + one_day)
    return df


def _number_code(df: DataFrame, column: str, code: str | None) -> DataFrame:
    """Codes are numbers as text: compare the number, which the Parquet scan can filter on."""
    if code is None:
        return df
    return df.where(F.col(column) == int(code)) if code.isdigit() else df.where(F.lit(False))


_PRICE_CENTS = "CAST(round(o_totalprice * 100, 0) AS BIGINT)"
_CURRENT = f"o_orderpriority IN ('{URGENT}', '{HIGH}')"


def _part(condition: str = "true") -> str:
    """Sum of the order values, in cents, for which the condition holds; null if none does."""
    return f"sum(CASE WHEN {condition} THEN {_PRICE_CENTS} END)"


def _money(cents_text: str) -> str:
    return f"CAST({cents_text} AS DOUBLE) / 100D"


def _status(*values: str) -> str:
    return _money(_part(f"o_orderstatus IN ({', '.join(map(repr, values))})"))


def _priority(value: str) -> str:
    return _part(f"o_orderpriority = '{value}'")


class BoundTables(Tables):
    indices = {s: s.lower() for s in SEGMENTS}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            reader = self.spark.read.schema(RAW_SCHEMAS[name])
            self._raw[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    def scan(self, table, code=None, start=None, end=None, dates=None) -> DataFrame:
        if dates:
            start, end = min(dates), max(dates)
        build = getattr(self, f"_{table}")
        return conform(build(code, start, end), table)

    def given(self, table, start=None, end=None) -> DataFrame:
        rows = getattr(self, f"_{table}")(None, start, end)
        return conform(rows, table).select(*[c for c in spec_of(table).columns if c in rows.columns])

    # -- daily bars ----------------------------------------------------------------------------

    def ticks(self, code=None, end=None) -> DataFrame:
        events = _within(_number_code(self.raw("events"), "user_id", code), "ts", None, end)
        return events.select(
            F.col("user_id").alias("code"), "ts", F.col("event_id").alias("seq"),
            F.col("value").alias("price"), cents(F.col("value")).alias("cents"),
        )

    def _daily(self, code, start, end) -> DataFrame:
        # Earlier days stay in: they give the first bar its previous close.
        return with_changes(bars(self.ticks(code, end)))

    def _adjfactor(self, code, start, end) -> DataFrame:
        rows = bars(_within(self.ticks(code, end), "ts", start, None))
        return rows.select(
            F.col("code").cast("string").alias("ts_code"),
            ymd(F.col("day")).alias("trade_date"),
            (1 + F.col("vol") / 100).alias("adj_factor"),
        )

    # -- masters -------------------------------------------------------------------------------

    def _stock_basic(self, code, start, end) -> DataFrame:
        customer = _number_code(self.raw("customer"), "c_custkey", code)
        region = F.col("n_regionkey")
        key = F.col("c_custkey").cast("string")
        # A declared-unique key lets Spark leave the join out where no nation column is asked for.
        nation = self.raw("nation").dropDuplicates(["n_nationkey"])
        return customer.join(
            nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
        ).select(
            key.alias("ts_code"),
            F.lpad(key, 6, "0").alias("symbol"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("area"),
            F.col("c_mktsegment").alias("industry"),
            F.concat(F.col("c_name"), F.lit(" "), F.col("n_name")).alias("fullname"),
            F.concat(F.lit("cst"), key).alias("cnspell"),
            F.concat(F.lit("M"), region.cast("string")).alias("market"),
            F.when(region.isin(0, 1), "SSE").when(region.isin(2, 3), "SZSE").otherwise("BSE")
            .alias("exchange"),
            F.lit("CNY").alias("curr_type"),
            F.when(F.col("c_acctbal") < 0, "D").otherwise("L").alias("list_status"),
            F.when(F.col("c_acctbal") > 5000, "H").otherwise("N").alias("is_hs"),
        )

    def securities(self) -> DataFrame:
        """Parts as a security master whose names carry special-treatment marks."""
        mark = F.when(F.col("p_size") > 40, "*").otherwise("")
        key = F.col("p_partkey").cast("string")
        return self.raw("part").select(
            key.alias("ts_code"), F.lpad(key, 7, "0").alias("symbol"),
            F.concat(mark, F.col("p_type"), F.lit(" "), F.col("p_name")).alias("name"),
            F.when(F.col("p_brand") != "Brand#1", F.col("p_brand")).alias("industry"),
            F.lit(None).cast("string").alias("list_date"),
        )

    def _st_stocks(self, code, start, end) -> DataFrame:
        return classify_st(self.securities())

    def _index_basic(self, code, start, end) -> DataFrame:
        region = F.col("n_regionkey")
        nation = self.raw("nation").join(
            self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        return self.raw("supplier").join(
            nation, F.col("s_nationkey") == F.col("n_nationkey"), "left"
        ).select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ts_code"),
            F.col("s_name").alias("name"),
            F.concat(F.col("r_name"), F.lit(" "), F.col("s_name")).alias("fullname"),
            F.when(region == 0, "CSI").when(region == 1, "SSE").when(region == 2, "SZSE")
            .when(region == 3, "MSCI").alias("market"),
            F.col("r_name").alias("publisher"),
            F.col("n_name").alias("category"),
            F.col("s_acctbal").alias("base_point"),
        )

    # -- calendar ------------------------------------------------------------------------------

    def _trade_calendar(self, code, start, end) -> DataFrame:
        """Every day from a month before the first to a month after the last order or event.

        SSE is open on weekdays, SZSE on weekdays but the first of a month.
        """
        def bounds(name: str, column: str) -> DataFrame:
            return self.raw(name).agg(
                F.to_date(F.min(column)).alias("lo"), F.to_date(F.max(column)).alias("hi")
            )

        both = bounds("events", "ts").unionByName(bounds("orders", "o_orderdate"))
        span = both.agg(F.date_sub(F.min("lo"), 31).alias("lo"), F.date_add(F.max("hi"), 31).alias("hi"))
        days = span.select(F.explode(F.sequence("lo", "hi")).alias("d")).select(
            "d", F.explode(F.array(F.lit("SSE"), F.lit("SZSE"))).alias("exchange")
        )
        weekday = F.weekday("d") < 5
        first = (F.dayofmonth("d") == 1) & (F.col("exchange") == "SZSE")
        days = days.withColumn("is_open", F.when(weekday & ~first, 1).otherwise(0))
        before = Window.partitionBy("exchange").orderBy("d").rowsBetween(
            Window.unboundedPreceding, -1
        )
        previous = F.max(F.when(F.col("is_open") == 1, F.col("d"))).over(before)
        return days.select(
            "exchange", ymd(F.col("d")).alias("cal_date"), "is_open",
            ymd(previous).alias("pretrade_date"),
        )

    # -- statements ----------------------------------------------------------------------------

    def _orders(self, code, start, end) -> DataFrame:
        orders = _number_code(self.raw("orders"), "o_custkey", code)
        if start:
            # A period holds the orders of its whole quarter.
            month = (int(start[4:6]) - 1) // 3 * 3 + 1
            start = f"{start[:4]}{month:02d}01"
        orders = _within(orders, "o_orderdate", start, end)
        return orders.withColumn("day", F.to_date("o_orderdate"))

    def _by_quarter(self, code, start, end, **columns: str) -> DataFrame:
        quarter = F.expr("last_day(add_months(trunc(day, 'QUARTER'), 2))").alias("q")
        announced = F.expr("date_format(max(day), 'yyyyMMdd') AS ann_date")
        totals = self._orders(code, start, end).groupBy("o_custkey", quarter).agg(
            announced, *[F.expr(f"{text} AS {name}") for name, text in columns.items()]
        )
        return totals.selectExpr(
            "CAST(o_custkey AS STRING) AS ts_code", "date_format(q, 'yyyyMMdd') AS end_date",
            "ann_date", "ann_date AS f_ann_date", "'1' AS report_type", "'1' AS comp_type",
            "CAST(quarter(q) AS STRING) AS end_type", "'0' AS update_flag", *columns,
        )

    def _income(self, code, start, end) -> DataFrame:
        return self._by_quarter(
            code, start, end,
            basic_eps=f"{_money(_part())} / count(*)",
            total_revenue=_money(_part()),
            revenue=_status("F", "O"),
            total_cogs=_status("P"),
            operate_profit=_status("F", "O"),
            total_profit=_status("O"),
            n_income_attr_p=_status("F"),
        )

    def _cashflow(self, code, start, end) -> DataFrame:
        urgent, medium, low = (
            f"coalesce({_priority(p)}, 0)" for p in (URGENT, MEDIUM, LOW)
        )
        return self._by_quarter(
            code, start, end,
            net_profit=_status("F"),
            n_cashflow_act=_money(_priority(URGENT)),
            n_cashflow_inv_act=_money(f"-{_priority(MEDIUM)}"),
            n_cash_flows_fnc_act=_money(_priority(LOW)),
            free_cashflow=_money(f"({urgent} - {medium})"),
            c_cash_equ_beg_period=_status("O"),
            c_cash_equ_end_period=_status("F", "O"),
            n_incr_cash_cash_equ=_money(f"({urgent} - {medium} + {low})"),
        )

    def _balancesheet(self, code, start, end) -> DataFrame:
        current_debt = _part("o_orderstatus = 'O'")
        return self._by_quarter(
            code, start, end,
            total_assets=_money(_part()),
            total_cur_assets=_money(_part(_CURRENT)),
            total_nca=_money(_part(f"NOT {_CURRENT}")),
            total_liab=_status("O", "P"),
            total_cur_liab=_money(f"coalesce({current_debt}, 0)"),
            total_ncl=_status("P"),
            total_hldr_eqy_inc_min_int=_status("F"),
            money_cap=_money(_priority(URGENT)),
            accounts_receiv=_money(_priority(HIGH)),
            inventories=_money(_priority(MEDIUM)),
            fix_assets=_money(_priority(UNSPECIFIED)),
            intang_assets=_money(_priority(LOW)),
            st_borrow=_money(_part(f"o_orderstatus = 'O' AND {_CURRENT}")),
            lt_borrow=_money(_part(f"o_orderstatus = 'P' AND NOT {_CURRENT}")),
        )

    def revisions(self, orders: DataFrame | None = None) -> DataFrame:
        """Every order as one revision of its customer's income statement of the quarter."""
        orders = self.raw("orders") if orders is None else orders
        day, status = ymd(F.col("o_orderdate")), F.col("o_orderstatus")
        end = quarter_end(day)
        price = F.col("o_totalprice")
        return conform(
            orders.select(
                F.col("o_custkey").cast("string").alias("ts_code"), day.alias("ann_date"),
                day.alias("f_ann_date"), end.alias("end_date"), F.lit("1").alias("report_type"),
                F.col("o_orderpriority").alias("comp_type"), status.alias("update_flag"),
                price.alias("total_revenue"),
                F.when(status == "F", price).alias("n_income_attr_p"),
            ),
            "income",
        )

    # -- money flow ----------------------------------------------------------------------------

    def _moneyflow(self, code, start, end) -> DataFrame:
        orders = _within(
            _number_code(self.raw("orders"), "o_custkey", code), "o_orderdate", start, end
        ).select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
        lines = self.raw("lineitem").select(
            "l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag"
        )
        price = "l_extendedprice"
        bands = {
            "sm": f"{price} < 25000",
            "md": f"{price} >= 25000 AND {price} < 50000",
            "lg": f"{price} >= 50000 AND {price} < 75000",
            "elg": f"{price} >= 75000",
        }
        sides = {"buy": "l_returnflag <> 'R'", "sell": "l_returnflag = 'R'"}
        amount = f"CAST(round({price} * 100, 0) AS BIGINT)"
        sums = []
        for band, hit in bands.items():
            for side, own in sides.items():
                when = f"CASE WHEN {hit} AND {own} THEN"
                sums += [
                    f"sum({when} l_quantity ELSE 0D END) AS {side}_{band}_vol",
                    _money(f"sum({when} {amount} ELSE 0 END)") + f" AS {side}_{band}_amount",
                ]
        net = "CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END"
        sums += [
            f"sum(l_quantity * {net}) AS net_mf_vol",
            _money(f"sum({amount} * {net})") + " AS net_mf_amount",
        ]
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        rows = joined.groupBy("o_custkey", "day").agg(*map(F.expr, sums))
        return rows.selectExpr(
            "CAST(o_custkey AS STRING) AS ts_code", "date_format(day, 'yyyyMMdd') AS trade_date",
            *spec_of("moneyflow").columns[2:],
        )

    # -- indices -------------------------------------------------------------------------------

    def _segments(self, code) -> DataFrame:
        """Customers of the tracked segments: index tables hold no other index."""
        customer = self.raw("customer").select("c_custkey", "c_mktsegment")
        customer = customer.where(F.col("c_mktsegment").isin(*self.indices))
        return customer.where(F.col("c_mktsegment") == code) if code else customer

    def _index_weight(self, code, start, end) -> DataFrame:
        """Share of each customer in its segment's order value of a month, in percent.

        The month totals come from an aggregate that is joined back, not from a window: a
        segment's month has as many rows as it has customers. The totals are at most one row
        per tracked segment and month, whatever the size of the tables, so they are broadcast;
        a shuffle on (segment, month) would gather each segment's month in one task.
        """
        month_start = f"{start[:6]}01" if start else None
        orders = _within(self.raw("orders"), "o_orderdate", month_start, end)
        per_customer = orders.groupBy(
            "o_custkey", F.last_day("o_orderdate").alias("month")
        ).agg(F.sum(cents(F.col("o_totalprice"))).alias("own"))
        rows = per_customer.join(
            self._segments(code), F.col("o_custkey") == F.col("c_custkey")
        ).select("c_mktsegment", "o_custkey", "month", "own")
        totals = rows.groupBy(
            F.col("c_mktsegment").alias("_segment"), F.col("month").alias("_month")
        ).agg(F.sum("own").alias("total"))
        same = (F.col("c_mktsegment") == F.col("_segment")) & (F.col("month") == F.col("_month"))
        weight = F.lit(100.0) * F.col("own").cast("double") / F.col("total").cast("double")
        return rows.join(F.broadcast(totals), same).select(
            F.col("c_mktsegment").alias("index_code"),
            F.col("o_custkey").cast("string").alias("con_code"),
            ymd(F.col("month")).alias("trade_date"), weight.alias("weight"),
        )

    def _index_daily(self, code, start, end) -> DataFrame:
        orders = _within(self.raw("orders"), "o_orderdate", None, end)
        trades = orders.join(
            self._segments(code), F.col("o_custkey") == F.col("c_custkey")
        ).select(
            F.col("c_mktsegment").alias("code"), F.col("o_orderdate").alias("ts"),
            F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("price"),
            cents(F.col("o_totalprice")).alias("cents"),
        )
        return with_changes(bars(trades))


class Before(Tables):
    """Another source as it was stored before a date; undated tables as they are."""

    def __init__(self, tables: Tables, cutoff: str):
        self.spark, self.tables, self.cutoff = tables.spark, tables, cutoff
        self.indices = tables.indices

    def scan(self, table, code=None, start=None, end=None, dates=None) -> DataFrame:
        return self._before(self.tables.scan(table, code, start, end, dates), table)

    def given(self, table, start=None, end=None) -> DataFrame:
        return self._before(self.tables.given(table, start, end), table)

    def _before(self, df: DataFrame, table: str) -> DataFrame:
        date = spec_of(table).date_col
        return df.where(F.col(date) < self.cutoff) if date else df
