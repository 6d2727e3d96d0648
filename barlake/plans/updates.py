"""Incremental and full refreshes: which landed rows an update takes, and the tables after it.

``as_of`` stands for today everywhere. Each ``*_rows`` function selects incoming rows; merging
them is :func:`barlake.operators.merge.merge_table`, or ``Store.upsert`` for stored tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.catalog import HISTORY_YEARS, INDEX_MARKETS, INDEX_TABLES, STATEMENTS, spec_of
from barlake.functions import history_start, months_ago, previous_quarter_end, quarter_end, to_day
from barlake.functions.dates import day_history_start, day_months_ago, day_quarter_ends
from barlake.operators.coverage import (
    missing_dates, new_index_rows, uncovered_batches, wanted_by_days, wanted_by_months,
)
from barlake.operators.days import months_in_range, open_days, quarter_series, single_months
from barlake.operators.profile import row_count, union_all
from barlake.sources.landing import listed_securities
from barlake.sources.store import Store
from barlake.sources.tables import Tables


def statement_refresh_rows(landed: DataFrame, as_of: str) -> DataFrame:
    """Landed rows of the current and the previous quarter, always taken again."""
    end = F.col("end_date")
    return landed.where((end == quarter_end(as_of)) | (end == previous_quarter_end(as_of)))


def statement_full_rows(landed: DataFrame, as_of: str, years: int = HISTORY_YEARS) -> DataFrame:
    """Landed rows of every quarter of the history window."""
    this_year = F.year(to_day(as_of))
    window = landed.sparkSession.range(1).select(
        (this_year - years).alias("start_year"), this_year.alias("end_year")
    )
    return landed.join(quarter_series(window, as_of), "end_date", "left_semi")


def master_refresh_rows(landed: DataFrame) -> DataFrame:
    return listed_securities(landed)


def calendar_refresh_rows(
    landed: DataFrame, as_of: str, months: int | None = None, years: int = HISTORY_YEARS
) -> DataFrame:
    """Landed calendar days of the last ``months`` months, or of the whole history."""
    start = months_ago(as_of, months) if months else history_start(as_of, years)
    day = F.col("cal_date")
    return landed.where((day >= start) & (day <= as_of))


def rows_of_missing_dates(landed: DataFrame, gaps: DataFrame) -> DataFrame:
    """Landed rows of the dates a gap list names. With a list as short as a calendar, Spark
    broadcasts it and does not shuffle the landed rows by date."""
    return landed.join(gaps.select("trade_date").distinct(), "trade_date", "left_semi")


def _in_window(df: DataFrame, start, as_of: str) -> DataFrame:
    return df.where((F.col("trade_date") >= start) & (F.col("trade_date") <= as_of))


def index_incremental_rows(
    landed: DataFrame, stored: DataFrame, code_col: str, as_of: str, months: int = 3
) -> DataFrame:
    """Landed rows of the last months on dates the index does not have yet."""
    start = months_ago(as_of, months)
    return new_index_rows(
        _in_window(landed, start, as_of), _in_window(stored, start, as_of), code_col
    )


def index_daily_full_rows(
    landed: DataFrame, stored: DataFrame, as_of: str, years: int = HISTORY_YEARS
) -> DataFrame:
    """Landed bars since January of ``years`` years ago on dates the index does not have."""
    start = F.concat((F.year(to_day(as_of)) - years).cast("string"), F.lit("0101"))
    return new_index_rows(_in_window(landed, start, as_of), stored, "ts_code")


def index_weight_full_rows(
    landed: DataFrame, stored: DataFrame, batches: DataFrame
) -> DataFrame:
    """Landed weights of every month batch that is not fully stored.

    The batches are turned into their months first, so that the match is an equality on
    (index, month) and not a range.
    """
    ym = F.substring(F.col("trade_date"), 1, 6)
    stored_months = stored.select("index_code", ym.alias("ym")).distinct()
    open_batches = uncovered_batches(batches, stored_months)
    months = months_in_range(open_batches, "batch_start", "batch_end").select(
        "index_code", F.col("ym").alias("_ym"), F.col("batch_end").alias("_end")
    )
    rows = landed.withColumn("_ym", ym).join(months, ["index_code", "_ym"])
    return rows.where(F.col("trade_date") <= F.col("_end")).select(*landed.columns)


# An update step is a function that selects the incoming rows of one table. It is called right
# before these are merged, so that it sees what the steps before it have written: the calendar
# comes first because the gaps of the dated tables are read off it.
Steps = dict[str, Callable[[], DataFrame]]


def _dated_steps(landed: Tables, stored: Tables, wanted: Callable[[], DataFrame]) -> Steps:
    def step(table: str):
        # The first and last wanted day bound both sides, so that only their partitions are read.
        days = wanted()
        day = F.col(days.columns[0])
        low, high = days.agg(F.min(day), F.max(day)).first()
        window = {"start": low, "end": high}
        gaps = missing_dates(days, stored.days(table, **window))
        return rows_of_missing_dates(landed.slice(table, **window), gaps)

    return {t: partial(step, t) for t in ("daily", "adjfactor", "moneyflow")}


def _master_steps(landed: Tables) -> Steps:
    def markets() -> DataFrame:
        return landed.scan("index_basic").where(F.col("market").isin(*INDEX_MARKETS))

    return {
        "stock_basic": lambda: master_refresh_rows(landed.scan("stock_basic")),
        "st_stocks": lambda: landed.scan("st_stocks"),
        "index_basic": markets,
    }


def incremental_steps(
    landed: Tables, stored: Tables, as_of: str, months: int = 3, days: int | None = None
) -> Steps:
    """Incremental update of every table; ``days`` replaces the months for the dated tables."""
    window = {"start": day_months_ago(as_of, months), "end": as_of}

    def calendar() -> DataFrame:
        return calendar_refresh_rows(landed.slice("trade_calendar", **window), as_of, months)

    def wanted() -> DataFrame:
        if days:
            return wanted_by_days(stored.scan("trade_calendar"), as_of, days)
        return wanted_by_months(stored.slice("trade_calendar", **window), as_of, months)

    def statement(table: str) -> DataFrame:
        # The two quarter ends bound the source, which need not add up the others.
        low, high = day_quarter_ends(as_of)
        return statement_refresh_rows(landed.given(table, start=low, end=high), as_of)

    def index(table: str) -> DataFrame:
        code = spec_of(table).code_col
        return index_incremental_rows(
            landed.slice(table, **window), stored.index_days(table, **window), code, as_of, months
        )

    return {
        "trade_calendar": calendar,
        **_master_steps(landed),
        **_dated_steps(landed, stored, wanted),
        **{t: partial(statement, t) for t in STATEMENTS},
        **{t: partial(index, t) for t in INDEX_TABLES},
    }


def full_steps(
    landed: Tables, stored: Tables, as_of: str, indices: DataFrame, years: int = HISTORY_YEARS
) -> Steps:
    """Full update: history that is not stored yet. The weights of the ``indices`` (index_code)
    are taken for every month of which nothing is stored."""
    window = {"start": f"{int(as_of[:4]) - years}0101", "end": as_of}

    def calendar() -> DataFrame:
        days = landed.slice("trade_calendar", start=day_history_start(as_of, years), end=as_of)
        return calendar_refresh_rows(days, as_of, None, years)

    def statement(table: str) -> DataFrame:
        return statement_full_rows(landed.given(table), as_of, years)

    def weights() -> DataFrame:
        return index_weight_full_rows(
            landed.slice("index_weight", **window), stored.index_days("index_weight", **window),
            single_months(indices, as_of, years),
        )

    def index_bars() -> DataFrame:
        return index_daily_full_rows(
            landed.slice("index_daily", **window), stored.index_days("index_daily", **window),
            as_of, years,
        )

    return {
        "trade_calendar": calendar,
        **_master_steps(landed),
        **_dated_steps(landed, stored, lambda: open_days(stored.scan("trade_calendar"))),
        **{t: partial(statement, t) for t in STATEMENTS},
        "index_weight": weights,
        "index_daily": index_bars,
    }


def update_summary(steps: Steps) -> DataFrame:
    """(table, rows): what an update would bring in now."""
    counts = union_all([row_count(rows(), table) for table, rows in steps.items()])
    return counts.withColumnRenamed("row_count", "rows")


def apply_update(store: Store, steps: Steps) -> dict[str, int]:
    """Merge the steps into the store one by one and return the rows taken per table.

    The rows of a step come out of joins, so they are staged and computed once. Readers of
    ``store.snapshot()`` see the whole update at its end, and nothing of one that breaks off, which
    may simply be run again.
    """
    taken = {table: store.upsert(rows(), table, staged=True) for table, rows in steps.items()}
    store.publish_snapshot()
    return taken
