"""Daily bars and the security master."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions import contains_like, ratio, round_half_up
from barlake.operators.merge import first_per_key


def top_with_name(df: DataFrame, master: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows by ``order`` with the security's name.

    The cut comes before the join: every row has at least one match in a left join, so rows
    beyond the first ``n`` cannot come back, and only ``n`` rows meet the master.
    """
    names = master.select(F.col("ts_code").alias("_code"), "name")
    top = df.orderBy(*order).limit(n)
    named = top.join(names, F.col("ts_code") == F.col("_code"), "left").drop("_code")
    return named.orderBy(*order).limit(n)


class EquityQueries:
    def get_daily(self, ts_code: str, start_date=None, end_date=None) -> DataFrame:
        return self.tables.read_daily(ts_code, start_date, end_date)

    def get_daily_latest(self, ts_code: str) -> DataFrame:
        newest = self._newest("daily", lambda df: not df.where(
            F.col("ts_code") == ts_code).isEmpty())
        df = newest.where(F.col("ts_code") == ts_code)
        return df.orderBy(F.col("trade_date").desc()).limit(1)

    def daily_latest_all(self) -> DataFrame:
        """Most recent bar of every security."""
        return first_per_key(
            self.tables.scan("daily"), ["ts_code"], ["trade_date DESC"]
        )

    def top_volume(self, trade_date: str, n: int = 20) -> DataFrame:
        """Largest traded amounts of a day."""
        bars = self.tables.on_dates("daily", trade_date).select(
            "ts_code", "close", "pct_chg", "vol", "amount"
        )
        order = [F.col("amount").desc_nulls_last(), F.col("ts_code").asc()]
        return top_with_name(bars, self.tables.scan("stock_basic"), order, n).select(
            "ts_code", "name", "close", "pct_chg", "vol", "amount"
        )

    def price_change_rank(
        self, start_date: str, end_date: str, n: int = 20, ascending: bool = False
    ) -> DataFrame:
        """Returns between the closes of two exact dates.

        One scan of the two dates replaces a self join: the presence counts keep a security
        whose close is null, and drop one that lacks a bar on either date.
        """
        date, close = F.col("trade_date"), F.col("close")
        ends = (
            self.tables.on_dates("daily", start_date, end_date)
            .groupBy("ts_code")
            .agg(
                F.max(F.when(date == start_date, close)).alias("close_first"),
                F.max(F.when(date == end_date, close)).alias("close_last"),
                F.count_if(date == start_date).alias("_first"),
                F.count_if(date == end_date).alias("_last"),
            )
            .where("_first > 0 AND _last > 0")
        )
        change = ratio(F.col("close_last") - F.col("close_first"), F.col("close_first")) * 100
        ranked = ends.select(
            "ts_code", "close_first", "close_last",
            round_half_up(change, 2).alias("cum_return_pct"),
        )
        key = F.col("cum_return_pct")
        order = [key.asc_nulls_last() if ascending else key.desc_nulls_last(), F.col("ts_code")]
        return top_with_name(ranked, self.tables.scan("stock_basic"), order, n).select(
            "ts_code", "name", "close_first", "close_last", "cum_return_pct"
        )

    def sector_performance(self, trade_date: str) -> DataFrame:
        """Average change and traded amount per industry on a day."""
        bars = self.tables.on_dates("daily", trade_date).select("ts_code", "pct_chg", "amount")
        industry = self.tables.scan("stock_basic").where(F.col("industry").isNotNull()).select(
            "ts_code", "industry"
        )
        return (
            bars.join(industry, "ts_code")
            .groupBy("industry")
            .agg(
                F.count("*").alias("stock_count"),
                round_half_up(F.avg("pct_chg"), 2).alias("avg_pct_chg"),
                round_half_up(F.avg("amount"), 0).alias("avg_amount"),
            )
            .orderBy(F.col("avg_pct_chg").desc_nulls_last(), "industry")
        )

    def trading_dates(self, n: int = 10) -> DataFrame:
        """Most recent dates that have bars."""
        known = self.tables.known_days("daily")
        if known is not None:
            newest = [(d,) for d in known[::-1][:n]]
            return self.tables.spark.createDataFrame(newest, "trade_date string").orderBy(
                F.col("trade_date").desc())

        def enough(df: DataFrame) -> bool:
            return df.where("trade_date IS NOT NULL").select(
                "trade_date").distinct().limit(n).count() >= n

        dates = self._newest("daily", enough).select("trade_date").distinct()
        return dates.orderBy(F.col("trade_date").desc()).limit(n)

    def _newest(self, table: str, enough: Callable[[DataFrame], bool]) -> DataFrame:
        """The newest months of a table that satisfy ``enough``, twice as many each time, or all
        rows. Without known months all rows are returned at once."""
        months = self.tables.partition_values(table, "ym") or []
        n = 1
        while n < len(months):
            newest = self.tables.scan(table, start=months[-n])
            if enough(newest):
                return newest
            n *= 2
        return self.tables.scan(table)

    def stored_months(self, table: str = "daily") -> DataFrame:
        """Months that have rows; null stands for rows without a date. Where the months are
        known as partitions, no row is read for them."""
        months = self.tables.partition_values(table, "ym")
        ym = F.substring(F.col("trade_date"), 1, 6).alias("ym")
        if months is None:
            return self.tables.scan(table).select(ym).distinct()
        known = self.tables.spark.createDataFrame([(m,) for m in months], "ym string")
        # The partition without a date is the only one left to look into.
        undated = self.tables.scan(table).where("trade_date IS NULL").select(ym).limit(1)
        return known.union(undated)

    # -- security master ---------------------------------------------------------------------

    def get_stock_info(self, ts_code: str | None = None) -> DataFrame:
        return self.tables.read_stock_basic(ts_code)

    def search_stock(self, keyword: str) -> DataFrame:
        """The keyword is uppercased; name and symbol are compared as they are, so lowercase
        letters in a name never match, and only the abbreviation ignores case."""
        word = keyword.upper()
        hit = (
            contains_like(F.col("name"), word)
            | contains_like(F.col("symbol"), word)
            | contains_like(F.upper("cnspell"), word)
        )
        return self._master(hit, "ts_code", "symbol", "name", "area", "industry",
                            "list_date", "is_hs")

    def industry_stocks(self, industry: str) -> DataFrame:
        return self._master(F.col("industry") == industry,
                            "ts_code", "symbol", "name", "area", "list_date")

    def filter_stocks_by_market(self, market: str) -> DataFrame:
        return self._master(F.col("market") == market,
                            "ts_code", "symbol", "name", "area", "industry", "list_date")

    def stocks_by_industry(self, industry: str) -> DataFrame:
        rows = self.tables.scan("stock_basic").where(F.col("industry") == industry)
        return rows.groupBy("industry").agg(F.count("*").alias("stock_count"))

    def _master(self, condition: Column, *columns: str) -> DataFrame:
        rows = self.tables.scan("stock_basic").where(condition)
        return rows.select(*columns).orderBy("ts_code")

    # -- special treatment -------------------------------------------------------------------

    def get_st_stocks(self) -> DataFrame:
        return self.tables.read_st_stocks()

    def get_st_stocks_by_type(self, st_type: str) -> DataFrame:
        rows = self.tables.scan("st_stocks").where(F.col("st_type") == st_type)
        return rows.select("ts_code", "symbol", "name", "industry", "list_date").orderBy("ts_code")

    def st_stocks_by_industry(self) -> DataFrame:
        rows = self.tables.scan("st_stocks").where(F.col("industry").isNotNull())
        counts = rows.groupBy("industry").agg(F.count("*").alias("st_count"))
        return counts.orderBy(F.col("st_count").desc(), "industry")
