"""Index master, constituent weights and index bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions import contains_like, ratio, round_half_up
from barlake.operators.merge import first_per_key
from barlake.sources.tables import where_code


class IndexQueries:
    def get_index_basic(self, market: str | None = None) -> DataFrame:
        return self.tables.read_index_basic(market)

    def search_index(self, keyword: str) -> DataFrame:
        word = keyword.upper()
        hit = (
            contains_like(F.upper("name"), word)
            | contains_like(F.upper("fullname"), word)
            | contains_like(F.upper("ts_code"), word)
        )
        return self.tables.scan("index_basic").where(hit).select(
            "ts_code", "name", "fullname", "market", "publisher", "index_type", "category",
            "base_date", "base_point", "list_date", "weight_rule",
        ).orderBy("ts_code")

    def index_count_by_market(self) -> DataFrame:
        counts = self.tables.scan("index_basic").groupBy("market").agg(
            F.count("*").alias("index_count")
        )
        return counts.orderBy(F.col("index_count").desc(), F.col("market").asc_nulls_last())

    def index_count_by_category(self, market: str | None = None) -> DataFrame:
        rows = where_code(self.tables.scan("index_basic"), "market", market)
        counts = rows.groupBy("market", "category").agg(F.count("*").alias("index_count"))
        size, name = F.col("index_count").desc(), F.col("category").asc_nulls_last()
        if market:
            return counts.orderBy(size, name)
        return counts.orderBy(F.col("market").asc_nulls_last(), size, name)

    # -- weights -----------------------------------------------------------------------------

    def get_index_weight(self, index_code=None, trade_date=None, con_code=None) -> DataFrame:
        return self.tables.read_index_weight(index_code, trade_date, trade_date, con_code)

    def index_weight_latest(self, index_code: str) -> DataFrame:
        """Weights on the index's most recent date, largest first.

        The date is a scalar subquery of the same plan. A window over the index would bring a
        whole index into one task.
        """
        rows = self.tables.slice("index_weight", index_code)
        newest = rows.agg(F.max("trade_date").alias("d")).scalar()
        latest = rows.where(F.col("trade_date") == newest)
        return latest.orderBy(F.col("weight").desc_nulls_last(), "con_code")

    def index_top_weights(
        self, index_code: str, trade_date: str | None = None, n: int = 10
    ) -> DataFrame:
        """Largest ``n`` weights on a date, or on the most recent one."""
        if trade_date:
            rows = self.tables.slice("index_weight", index_code, trade_date, trade_date)
        else:
            rows = self.index_weight_latest(index_code)
        return rows.orderBy(F.col("weight").desc_nulls_last(), "con_code").limit(n)

    def search_constituent(self, con_code: str) -> DataFrame:
        """Every index membership of a security, newest first."""
        rows = self.tables.scan("index_weight").where(F.col("con_code") == con_code)
        found = rows.select("index_code", "trade_date", "weight").distinct()
        return found.orderBy(F.col("trade_date").desc(), "index_code")

    def search_constituent_in_index(
        self, con_code: str, index_code: str | None = None, n: int | None = None
    ) -> DataFrame:
        rows = where_code(self.search_constituent(con_code), "index_code", index_code)
        ranked = rows.orderBy(F.col("trade_date").desc(), "index_code")
        return ranked.limit(n) if n else ranked

    def constituent_history(self, con_code: str, index_code: str | None = None) -> DataFrame:
        rows = self.tables.slice("index_weight", index_code)
        rows = rows.where(F.col("con_code") == con_code)
        return rows.select("index_code", "trade_date", "weight").orderBy(
            "index_code", "trade_date"
        )

    def index_weight_summary(self, index_code=None, trade_date=None) -> DataFrame:
        """Statistics per index and date; without a date, of every stored date."""
        weight = F.col("weight")
        stats = (
            self.tables.slice("index_weight", index_code, trade_date, trade_date)
            .groupBy("index_code", "trade_date")
            .agg(
                F.count("*").alias("constituent_count"),
                round_half_up(F.sum(weight), 4).alias("total_weight"),
                round_half_up(F.avg(weight), 6).alias("avg_weight"),
                round_half_up(F.max(weight), 4).alias("max_weight"),
                round_half_up(F.min(weight), 6).alias("min_weight"),
            )
        )
        return stats.orderBy("index_code", F.col("trade_date").desc())

    def max_constituents(self) -> DataFrame:
        """(index_code, constituents): the largest number of constituents on one date."""
        per_date = self.tables.scan("index_weight").groupBy("index_code", "trade_date").agg(
            F.count("con_code").alias("n")
        )
        return per_date.groupBy("index_code").agg(F.max("n").alias("constituents"))

    # -- bars --------------------------------------------------------------------------------

    def get_index_daily(self, index_code=None, start_date=None, end_date=None) -> DataFrame:
        return self.tables.read_index_daily(index_code, start_date, end_date)

    def get_index_daily_latest(self, index_code: str) -> DataFrame:
        rows = self.tables.slice("index_daily", index_code)
        return rows.orderBy(F.col("trade_date").desc()).limit(1)

    def index_daily_latest_all(self) -> DataFrame:
        return first_per_key(
            self.tables.scan("index_daily"), ["ts_code"], ["trade_date DESC"]
        )

    def index_performance_rank(self, trade_date: str, n: int = 10) -> DataFrame:
        rows = self.tables.on_dates("index_daily", trade_date).select(
            "ts_code", "trade_date", "close", "open", "high", "low", "pct_chg", "vol", "amount"
        )
        return rows.orderBy(F.col("pct_chg").desc_nulls_last(), "ts_code").limit(n)

    def index_cumulative_return(
        self, index_code: str, start_date: str, end_date: str
    ) -> DataFrame:
        """Return between two exact dates; no row if the index lacks a bar on either."""
        bars = self.tables.on_dates("index_daily", start_date, end_date)
        bars = bars.where(F.col("ts_code") == index_code)

        def close_on(date: str, name: str) -> DataFrame:
            rows = bars.where(F.col("trade_date") == date)
            return rows.select("ts_code", F.col("close").alias(name))

        first, last = close_on(start_date, "start_close"), close_on(end_date, "end_close")
        change = ratio(F.col("end_close") - F.col("start_close"), F.col("start_close")) * 100
        return first.join(last, "ts_code").select(
            "ts_code", F.lit(start_date).alias("start_date"), "start_close",
            F.lit(end_date).alias("end_date"), "end_close",
            round_half_up(change, 2).alias("cum_return_pct"),
        )
