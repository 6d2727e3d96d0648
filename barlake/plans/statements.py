"""Income, balance sheet, cash flow and money flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions import ratio, round_half_up
from barlake.operators.merge import first_per_key
from barlake.plans.equities import top_with_name

# The columns that the two summaries show.
BALANCE_COLUMNS = (
    "ts_code", "end_date", "total_assets", "total_cur_assets", "total_nca", "total_liab",
    "total_cur_liab", "total_ncl", "total_hldr_eqy_inc_min_int", "money_cap",
    "accounts_receiv", "inventories", "fix_assets", "intang_assets", "goodwill",
    "st_borrow", "lt_borrow", "bonds_payable",
)
CASHFLOW_COLUMNS = (
    "ts_code", "end_date", "net_profit", "n_cashflow_act", "n_cashflow_inv_act",
    "n_cash_flows_fnc_act", "free_cashflow", "c_cash_equ_beg_period",
    "c_cash_equ_end_period", "n_incr_cash_cash_equ",
)


def latest_period(rows: DataFrame, end_date: str) -> DataFrame:
    """Rows of each security's latest period up to ``end_date``, ties included.

    rank() = 1 lets Spark drop earlier periods before the shuffle, which a join back to the
    per-security maximum, or a window maximum, cannot.
    """
    newest = Window.partitionBy("ts_code").orderBy(F.col("end_date").desc())
    upto = rows.where(F.col("end_date") <= end_date)
    return upto.withColumn("_rank", F.rank().over(newest)).where("_rank = 1").drop("_rank")


def debt_ratio():
    return round_half_up(ratio(F.col("total_liab"), F.col("total_assets")) * 100, 2)


class StatementQueries:
    def get_income(self, ts_code: str, start_date=None, end_date=None) -> DataFrame:
        return self.tables.read_income(ts_code, start_date, end_date)

    def get_balancesheet(self, ts_code: str, start_date=None, end_date=None) -> DataFrame:
        return self.tables.read_balancesheet(ts_code, start_date, end_date)

    def get_cashflow(self, ts_code: str, start_date=None, end_date=None) -> DataFrame:
        return self.tables.read_cashflow(ts_code, start_date, end_date)

    def roe_rank(self, end_date: str, n: int = 20) -> DataFrame:
        """Largest net profits of the latest periods up to ``end_date``. A security whose
        latest period has no net profit is left out; there is no step back to an earlier one.
        """
        rows = self.tables.scan("income", end=end_date).select(
            "ts_code", "end_date", "n_income_attr_p", "basic_eps", "total_revenue",
            "operate_profit", "total_profit",
        )
        latest = latest_period(rows, end_date).where(F.col("n_income_attr_p").isNotNull())
        order = [F.col("n_income_attr_p").desc(), F.col("ts_code"), F.col("end_date")]
        return top_with_name(latest, self.tables.scan("stock_basic"), order, n).select(
            "ts_code", "name", "end_date",
            round_half_up(F.col("n_income_attr_p") / F.lit(10000.0), 2).alias("net_profit_yi"),
            "basic_eps", "total_revenue", "operate_profit", "total_profit",
        )

    def asset_rank(self, end_date: str, n: int = 20) -> DataFrame:
        """Largest total assets of the latest periods up to ``end_date``."""
        rows = self.tables.scan("balancesheet", end=end_date).select(
            "ts_code", "end_date", "total_assets", "total_liab", "total_hldr_eqy_inc_min_int"
        )
        latest = latest_period(rows, end_date).where(F.col("total_assets").isNotNull())
        order = [F.col("total_assets").desc(), F.col("ts_code"), F.col("end_date")]

        def yi(name: str):
            return round_half_up(F.col(name) / F.lit(100000000.0), 2)

        return top_with_name(latest, self.tables.scan("stock_basic"), order, n).select(
            "ts_code", "name", "end_date",
            yi("total_assets").alias("total_assets_yi"),
            yi("total_liab").alias("total_liab_yi"),
            yi("total_hldr_eqy_inc_min_int").alias("total_equity_yi"),
            debt_ratio().alias("debt_ratio_pct"),
        )

    def latest_periods(self, table: str, end_date: str) -> DataFrame:
        """(ts_code, max_end_date): the latest period up to ``end_date`` per security."""
        rows = self.tables.slice(table, end=end_date)
        return rows.groupBy("ts_code").agg(F.max("end_date").alias("max_end_date"))

    def income_summary(self, ts_code: str, n_periods: int = 8) -> DataFrame:
        return _recent(self.tables.slice("income", ts_code), "end_date", n_periods)

    def balancesheet_summary(self, ts_code: str, n_periods: int = 8) -> DataFrame:
        recent = _recent(
            self.tables.slice("balancesheet", ts_code).select(*BALANCE_COLUMNS),
            "end_date", n_periods,
        )
        return _with_ratios(recent)

    def cashflow_summary(self, ts_code: str, n_periods: int = 8) -> DataFrame:
        rows = self.tables.slice("cashflow", ts_code).select(*CASHFLOW_COLUMNS)
        return _recent(rows, "end_date", n_periods)

    def balance_ratios(self, n_periods: int = 8) -> DataFrame:
        """The balance-sheet summary of every security at once."""
        rows = self.tables.scan("balancesheet").select(*BALANCE_COLUMNS)
        recent = first_per_key(rows, ["ts_code"], ["end_date DESC"], n_periods)
        return _with_ratios(recent)

    # -- money flow --------------------------------------------------------------------------

    def get_moneyflow(self, ts_code=None, start_date=None, end_date=None) -> DataFrame:
        return self.tables.read_moneyflow(ts_code, start_date, end_date)

    def moneyflow_rank(self, trade_date: str, n: int = 20) -> DataFrame:
        """Largest net inflows of a day."""
        columns = ("net_mf_amount", "net_mf_vol", "buy_lg_amount", "sell_lg_amount",
                   "buy_elg_amount", "sell_elg_amount")
        rows = self.tables.on_dates("moneyflow", trade_date).select("ts_code", *columns)
        order = [F.col("net_mf_amount").desc_nulls_last(), F.col("ts_code")]
        return top_with_name(rows, self.tables.scan("stock_basic"), order, n).select(
            "ts_code", "name", *columns
        )

    def moneyflow_summary(self, ts_code: str, n_days: int = 20) -> DataFrame:
        return _recent(self.tables.slice("moneyflow", ts_code), "trade_date", n_days)


def _recent(rows: DataFrame, date_col: str, n: int) -> DataFrame:
    return rows.orderBy(F.col(date_col).desc()).limit(n)


def _with_ratios(rows: DataFrame) -> DataFrame:
    current = ratio(F.col("total_cur_assets"), F.col("total_cur_liab"))
    return rows.select(
        "*", round_half_up(current, 2).alias("current_ratio"),
        debt_ratio().alias("debt_ratio_pct"),
    )
