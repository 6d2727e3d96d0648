"""Trading-calendar operators over whole sets of dates.

The windows below run over the days from a calendar's first to its last, however many rows or
dates the callers' tables have. Look-ups are joined by equality, and Spark chooses how.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.functions import to_day, ymd
from barlake.sources.tables import where_dates


def of_exchange(calendar: DataFrame, exchange: str) -> DataFrame:
    return calendar.where(F.col("exchange") == exchange)


def open_days(
    calendar: DataFrame, exchange: str = "SSE", start: str | None = None, end: str | None = None
) -> DataFrame:
    """Distinct open days of an exchange as (cal_date)."""
    df = of_exchange(calendar, exchange).where(F.col("is_open") == 1)
    return where_dates(df, "cal_date", start, end).select("cal_date").distinct()


def last_open_days(
    calendar: DataFrame, as_of: str, n: int, exchange: str = "SSE"
) -> DataFrame:
    """The ``n`` most recent open days up to ``as_of``, newest first."""
    days = open_days(calendar, exchange, end=as_of)
    return days.orderBy(F.col("cal_date").desc()).limit(n)


def trading_day_flags(
    dates: DataFrame, calendar: DataFrame, exchange: str = "SSE", date_col: str = "date"
) -> DataFrame:
    """Adds ``is_trading_day``; a date the calendar does not list is no trading day."""
    days = of_exchange(calendar, exchange).select(
        F.col("cal_date").alias("_day"), F.col("is_open").alias("_open")
    )
    return dates.join(days, F.col(date_col) == F.col("_day"), "left").select(
        *dates.columns, (F.coalesce(F.col("_open"), F.lit(0)) == 1).alias("is_trading_day")
    )


def _open_line(calendar: DataFrame, exchange: str) -> DataFrame:
    """Every day from an exchange's first open day to its last, as (_day, _open: 1 or 0)."""
    days = open_days(calendar, exchange).select(to_day(F.col("cal_date")).alias("_d"))
    bounds = days.agg(F.min("_d").alias("low"), F.max("_d").alias("high")).where("low IS NOT NULL")
    every = bounds.select(F.explode(F.sequence("low", "high")).alias("_d"))
    marked = days.withColumn("_open", F.lit(1))
    return every.join(marked, "_d", "left").select(
        ymd(F.col("_d")).alias("_day"), F.coalesce("_open", F.lit(0)).alias("_open"))


def _as_day(column: str) -> Column:
    """``yyyyMMdd`` text if it names a day, else null."""
    return ymd(F.try_to_date(F.col(column), "yyyyMMdd"))


def next_open_days(
    dates: DataFrame, calendar: DataFrame, exchange: str = "SSE", date_col: str = "date"
) -> DataFrame:
    """Adds ``next_trading_day``: the first open day on or after the date, or null.

    Before the calendar's first open day that is the first one; after its last, and for text that
    names no day, there is none.
    """
    line = _open_line(calendar, exchange)
    # Read backwards, the frame only grows, so each day adds one value to a running minimum.
    ahead = Window.partitionBy(F.lit(1)).orderBy(F.col("_day").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    found = line.select(
        "_day", F.min(F.when(F.col("_open") == 1, F.col("_day"))).over(ahead).alias("_next"))
    first = line.agg(F.min("_day")).scalar()
    asked = F.greatest(_as_day(date_col), first)
    asked = F.when(_as_day(date_col).isNotNull(), asked)
    return (
        dates.withColumn("_asked", asked)
        .join(found, F.col("_asked") == F.col("_day"), "left")
        .select(*dates.columns, F.col("_next").alias("next_trading_day"))
    )


def open_day_counts(
    ranges: DataFrame, calendar: DataFrame, exchange: str = "SSE",
    start_col: str = "start_date", end_col: str = "end_date",
) -> DataFrame:
    """Adds ``trading_days``: the open days within each inclusive range.

    Prefix sums over the calendar's days give the count as a difference of two look-ups, instead of
    a range join. Bounds outside the calendar are moved to its first or last day; a bound that names
    no day makes the count 0.
    """
    line = _open_line(calendar, exchange)
    upto = Window.partitionBy(F.lit(1)).orderBy("_day").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    prefix = line.withColumn("_upto", F.sum("_open").over(upto))
    low = prefix.select(
        F.col("_day").alias("_low"), (F.col("_upto") - F.col("_open")).alias("_before")
    )
    high = prefix.select(F.col("_day").alias("_high"), F.col("_upto").alias("_through"))
    first, last = (line.agg(f("_day")).scalar() for f in (F.min, F.max))
    start, end = _as_day(start_col), _as_day(end_col)
    # A range that misses the calendar finds no day on one side.
    asked_low = F.when(start.isNotNull() & (start <= last), F.greatest(start, first))
    asked_high = F.when(end.isNotNull() & (end >= first), F.least(end, last))
    span = F.when(F.col(end_col) >= F.col(start_col), F.col("_through") - F.col("_before"))
    return (
        ranges.withColumn("_from", asked_low).withColumn("_to", asked_high)
        .join(low, F.col("_from") == F.col("_low"), "left")
        .join(high, F.col("_to") == F.col("_high"), "left")
        .select(*ranges.columns, F.coalesce(span, F.lit(0)).alias("trading_days"))
    )


def calendar_days_back(spark: SparkSession, as_of: str, days: int) -> DataFrame:
    """Every calendar day of the last ``days`` days up to ``as_of`` as (cal_date)."""
    last = to_day(as_of)
    span = F.sequence(F.date_sub(last, days - 1), last)
    return spark.range(1).select(F.explode(span).alias("d")).select(
        ymd(F.col("d")).alias("cal_date")
    )


def quarter_series(years: DataFrame, as_of: str) -> DataFrame:
    """Quarter ends of the years in (start_year, end_year), none after ``as_of``."""
    first = F.make_date(F.col("start_year"), F.lit(3), F.lit(31))
    last = F.make_date(F.col("end_year"), F.lit(12), F.lit(31))
    step = F.make_ym_interval(F.lit(0), F.lit(3))
    ends = years.select(F.explode(F.sequence(first, last, step)).alias("d"))
    ends = ends.select(ymd(F.last_day("d")).alias("end_date"))
    return ends.where(F.col("end_date") <= as_of)


def months_in_range(ranges: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """One row per range and ``yyyyMM`` month that it touches."""
    first = F.trunc(to_day(F.col(start_col)), "MM")
    last = F.trunc(to_day(F.col(end_col)), "MM")
    step = F.make_ym_interval(F.lit(0), F.lit(1))
    months = F.explode(F.sequence(first, last, step)).alias("_m")
    kept = ranges.where(F.col(start_col) <= F.col(end_col))
    return kept.select("*", months).withColumn("ym", F.date_format("_m", "yyyyMM")).drop("_m")


def month_ends(years: DataFrame, as_of: str) -> DataFrame:
    """Month ends of the years in (start_year, end_year), none after ``as_of``."""
    first = F.make_date(F.col("start_year"), F.lit(1), F.lit(1))
    last = F.make_date(F.col("end_year"), F.lit(12), F.lit(1))
    step = F.make_ym_interval(F.lit(0), F.lit(1))
    ends = years.select(F.explode(F.sequence(first, last, step)).alias("d"))
    ends = ends.select(ymd(F.last_day("d")).alias("month_end"))
    return ends.where(F.col("month_end") <= as_of)


def month_batches(
    indices: DataFrame, as_of: str, years: int, max_rows: int
) -> DataFrame:
    """Date ranges that cover the history of each index in (index_code, constituents).

    A batch spans as many whole months (1 to 12) as keep it below ``max_rows`` rows, 12 for an
    index without constituents; the last one ends at ``as_of``.
    """
    fitting = F.floor(F.try_divide(F.lit(max_rows), F.col("constituents")))
    span = F.greatest(F.lit(1), F.least(F.lit(12), fitting)).cast("int")
    first = F.make_date(F.year(to_day(as_of)) - years, F.lit(1), F.lit(1))
    starts = F.sequence(first, to_day(as_of), F.make_ym_interval(F.lit(0), F.col("months")))
    batches = indices.withColumn("months", span).select(
        "index_code", "months", F.explode(starts).alias("_start")
    )
    # months is a column: add_months takes it through an expression.
    end = F.last_day(F.expr("add_months(_start, months - 1)"))
    return batches.select(
        "index_code", "months", ymd(F.col("_start")).alias("batch_start"),
        F.least(ymd(end), F.lit(as_of)).alias("batch_end"),
    )


def single_months(indices: DataFrame, as_of: str, years: int) -> DataFrame:
    """The months of the history of each index in (index_code), as :func:`month_batches`."""
    one = indices.select("index_code", F.lit(1).alias("constituents"))
    return month_batches(one, as_of, years, max_rows=1)
