"""Calendar arithmetic on ``yyyyMMdd`` strings; every function maps columns to columns."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(text: Column | str) -> Column:
    """``yyyyMMdd`` text (a Python string is taken as a literal) to a date."""
    return F.to_date(F.lit(text) if isinstance(text, str) else text, "yyyyMMdd")


def ymd(day: Column) -> Column:
    """A date as ``yyyyMMdd`` text."""
    return F.date_format(day.cast("date"), "yyyyMMdd")


def next_day(text: Column | str) -> Column:
    return ymd(F.date_add(to_day(text), 1))


def months_ago(text: Column | str, months: int) -> Column:
    """Same day ``months`` earlier, moved to the month's last day where that is shorter."""
    return ymd(F.add_months(to_day(text), -months))


def day_months_ago(text: str, months: int) -> str:
    """:func:`months_ago` of a Python string, for bounds that prune partitions."""
    day = datetime.strptime(text, "%Y%m%d").date()
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    after = date(year + (month + 1) // 12, (month + 1) % 12 + 1, 1)
    return min(date(year, month + 1, min(day.day, 28)) + timedelta(max(day.day - 28, 0)),
               after - timedelta(1)).strftime("%Y%m%d")


def day_history_start(text: str, years: int) -> str:
    """:func:`history_start` of a Python string."""
    day = datetime.strptime(text, "%Y%m%d").date()
    return (day - timedelta(365 * years)).strftime("%Y%m%d")


def day_quarter_ends(text: str) -> tuple[str, str]:
    """:func:`previous_quarter_end` and :func:`quarter_end` of a Python string."""
    day = datetime.strptime(text, "%Y%m%d").date()
    first = date(day.year, (day.month - 1) // 3 * 3 + 1, 1)
    after = date(day.year + first.month // 10, (first.month + 2) % 12 + 1, 1)
    return tuple((d - timedelta(1)).strftime("%Y%m%d") for d in (first, after))


def month_end(text: Column | str) -> Column:
    return ymd(F.last_day(to_day(text)))


def quarter_end(text: Column | str) -> Column:
    """Last day of the quarter that contains the date."""
    return ymd(F.last_day(F.add_months(F.trunc(to_day(text), "QUARTER"), 2)))


def previous_quarter_end(text: Column | str) -> Column:
    return ymd(F.date_sub(F.trunc(to_day(text), "QUARTER"), 1))


def history_start(text: Column | str, years: int) -> Column:
    """Default start of a history: ``years`` times 365 days back, leap days not counted."""
    return ymd(F.date_sub(to_day(text), 365 * years))
