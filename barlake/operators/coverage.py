"""What is missing: anti joins between wanted and stored dates, months and codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions import months_ago
from barlake.operators.days import (
    calendar_days_back, last_open_days, months_in_range, open_days,
)


def missing_dates(wanted: DataFrame, stored: DataFrame, date_col: str = "trade_date") -> DataFrame:
    """Wanted days (first column) that no stored row carries, as (trade_date).

    A date counts as stored as soon as one row has it.
    """
    want = wanted.select(F.col(wanted.columns[0]).alias("trade_date"))
    have = stored.select(F.col(date_col).alias("trade_date")).distinct()
    return want.join(have, "trade_date", "left_anti")


def new_rows(incoming: DataFrame, stored: DataFrame, on: Sequence[str]) -> DataFrame:
    """Incoming rows whose combination of ``on`` is not stored yet. The stored side shrinks to
    its distinct combinations, on the map side first."""
    return incoming.join(stored.select(*on).distinct(), list(on), "left_anti")


def new_index_rows(incoming: DataFrame, stored: DataFrame, code_col: str) -> DataFrame:
    """Incoming index rows on dates their index does not have yet.

    What is stored shrinks to one row per index and day, which Spark broadcasts if it is small.
    """
    return new_rows(incoming, stored, [code_col, "trade_date"])


def codes_not_in(probe: DataFrame, known: DataFrame, probe_col: str, known_col: str) -> DataFrame:
    """Probe codes that the known list lacks; repeated probe codes stay repeated."""
    codes = known.select(F.col(known_col).alias("_code")).distinct()
    return probe.join(codes, F.col(probe_col) == F.col("_code"), "left_anti")


def uncovered_batches(batches: DataFrame, stored_months: DataFrame) -> DataFrame:
    """Batches (index_code, batch_start, batch_end, ...) of which at least one month is not in
    (index_code, ym)."""
    months = months_in_range(batches, "batch_start", "batch_end")
    gaps = new_rows(months, stored_months, ["index_code", "ym"])
    return gaps.drop("ym").distinct()


def wanted_by_months(
    calendar: DataFrame, as_of: str, months: int, exchange: str = "SSE"
) -> DataFrame:
    """Open days of the last ``months`` months; every calendar day of ``31 * months`` days if
    the calendar has no open day there."""
    spark = calendar.sparkSession
    start = months_ago(as_of, months)
    days = open_days(calendar, exchange).where(
        (F.col("cal_date") >= start) & (F.col("cal_date") <= as_of)
    )
    return _or_calendar_days(days, calendar_days_back(spark, as_of, 31 * months))


def wanted_by_days(calendar: DataFrame, as_of: str, days: int, exchange: str = "SSE") -> DataFrame:
    """The last ``days`` open days; the last ``days`` calendar days if there is none."""
    spark = calendar.sparkSession
    found = last_open_days(calendar, as_of, days, exchange)
    return _or_calendar_days(found, calendar_days_back(spark, as_of, days))


def _or_calendar_days(days: DataFrame, fallback: DataFrame) -> DataFrame:
    found = days.agg(F.count("*").alias("n")).scalar()
    return days.unionByName(fallback.where(found == 0))


def gaps_by_table(wanted: DataFrame, stored: dict[str, DataFrame]) -> DataFrame:
    """Missing dates of several dated tables as (table, trade_date)."""
    out = None
    for name, rows in stored.items():
        part = missing_dates(wanted, rows).select(F.lit(name).alias("table"), "trade_date")
        out = part if out is None else out.unionByName(part)
    return out
