"""Trading-calendar queries; the set forms are in :mod:`barlake.operators.days`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators import days


class CalendarQueries:
    def get_trade_calendar(self, start_date=None, end_date=None, exchange=None) -> DataFrame:
        return self.tables.read_trade_calendar(exchange, start_date, end_date)

    def is_trading_day(self, date: str, exchange: str = "SSE") -> bool:
        row = self.tables.slice("trade_calendar", exchange, date, date).first()
        return row is not None and row["is_open"] == 1

    def next_trading_day(self, date: str, exchange: str = "SSE") -> str | None:
        """First open day on or after ``date``."""
        open_days = self.tables.slice("trade_calendar", exchange, start=date).where("is_open = 1")
        return open_days.agg(F.min("cal_date").alias("d")).first()["d"]

    def trading_days_count(self, start_date: str, end_date: str, exchange: str = "SSE") -> int:
        rows = self.tables.slice("trade_calendar", exchange, start_date, end_date)
        return rows.where("is_open = 1").count()

    def last_n_trading_days(self, as_of: str, n: int, exchange: str = "SSE") -> DataFrame:
        return days.last_open_days(self.tables.scan("trade_calendar"), as_of, n, exchange)
