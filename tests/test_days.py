import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barlake.operators import coverage, days
from conftest import make, rows_of

EDGE = {"20251229": 1, "20251230": 1, "20251231": 1, "20260101": 0, "20260102": 0,
        "20260103": 0, "20260104": 0, "20260105": 1}


def calendar(spark, open_by_day, exchange="SSE"):
    rows = [{"exchange": exchange, "cal_date": d, "is_open": o} for d, o in open_by_day.items()]
    return make(spark, "trade_calendar", rows)


def dates(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "date string")


def test_flags_and_next_days_over_the_year_edge(spark):
    cal = calendar(spark, EDGE).unionByName(calendar(spark, {"20260101": 1}, "SZSE"))
    some = dates(spark, "20251231", "20260101", "20260105", "20200101", "20300101", "20260101")
    flags = sorted(rows_of(days.trading_day_flags(some, cal)))
    assert flags == [("20200101", False), ("20251231", True), ("20260101", False),
                     ("20260101", False), ("20260105", True), ("20300101", False)]
    ahead = sorted(rows_of(days.next_open_days(some, cal)), key=str)
    assert ahead == [("20200101", "20251229"), ("20251231", "20251231"),
                     ("20260101", "20260105"), ("20260101", "20260105"),
                     ("20260105", "20260105"), ("20300101", None)]
    assert dict(rows_of(days.next_open_days(some, cal, "SZSE")))["20200101"] == "20260101"


_DAYS = st.dates(dt.date(2024, 1, 1), dt.date(2024, 3, 1)).map(lambda d: d.strftime("%Y%m%d"))


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(_DAYS, st.integers(0, 1), max_size=20),
       st.lists(st.tuples(_DAYS, _DAYS), min_size=1, max_size=8))
def test_counts_against_brute_force(spark, open_by_day, ranges):
    cal = calendar(spark, open_by_day)
    df = spark.createDataFrame(ranges, "start_date string, end_date string")
    got = sorted(rows_of(days.open_day_counts(df, cal)))
    expected = sorted(
        (a, b, sum(o for d, o in open_by_day.items() if a <= d <= b)) for a, b in ranges
    )
    assert got == expected


def test_series(spark):
    years = spark.createDataFrame([(2023, 2024)], "start_year int, end_year int")
    assert [r[0] for r in rows_of(days.quarter_series(years, "20240701"))] == [
        "20230331", "20230630", "20230930", "20231231", "20240331", "20240630"]
    ends = [r[0] for r in rows_of(days.month_ends(years, "20240228"))]
    assert ends[0] == "20230131" and ends[-1] == "20240131" and len(ends) == 13
    span = spark.createDataFrame([("20231115", "20240201"), ("20240201", "20240101")],
                                 "a string, b string")
    assert [r["ym"] for r in days.months_in_range(span, "a", "b").collect()] == [
        "202311", "202312", "202401", "202402"]


def _batches(as_of, years, k):
    """The batches as a loop over months."""
    import calendar as c

    out, month = [], (as_of.year - years) * 12
    while True:
        y, m = divmod(month, 12)
        ey, em = divmod(month + k - 1, 12)
        start = f"{y}{m + 1:02d}01"
        end = f"{ey}{em + 1:02d}{c.monthrange(ey, em + 1)[1]:02d}"
        today = as_of.strftime("%Y%m%d")
        out.append((start, min(end, today)))
        if end >= today:
            return out
        month += k


@pytest.mark.parametrize("as_of", [dt.date(2024, 2, 29), dt.date(2024, 3, 15), dt.date(2023, 12, 31)])
def test_month_batches(spark, as_of):
    sizes = {"a": 300, "b": 1000, "c": 2000, "d": 90000, "e": 5999, "f": 0}
    months = {"a": 12, "b": 6, "c": 3, "d": 1, "e": 1, "f": 12}
    df = spark.createDataFrame(list(sizes.items()), "index_code string, constituents long")
    got = {}
    for r in days.month_batches(df, as_of.strftime("%Y%m%d"), 3, max_rows=6000).collect():
        assert r["months"] == months[r["index_code"]]
        got.setdefault(r["index_code"], []).append((r["batch_start"], r["batch_end"]))
    for code, k in months.items():
        assert sorted(got[code]) == _batches(as_of, 3, k)


def test_gaps(spark):
    cal = calendar(spark, EDGE)
    stored = make(spark, "daily", [{"ts_code": "A", "trade_date": d}
                                   for d in ("20251230", "20251231", "20260103")])
    wanted = days.open_days(cal)
    gaps = coverage.missing_dates(wanted, stored)
    assert sorted(rows_of(gaps)) == [("20251229",), ("20260105",)]
    covered = gaps.union(stored.select("trade_date")).distinct()
    assert coverage.missing_dates(wanted, covered).count() == 0
    recent = coverage.wanted_by_days(cal, "20260104", 2)
    assert [r[0] for r in rows_of(recent)] == ["20251231", "20251230"]
    months = coverage.wanted_by_months(cal, "20260131", 1)
    assert sorted(rows_of(months)) == [("20251231",), ("20260105",)]


def test_without_calendar_every_day_is_wanted(spark):
    cal = calendar(spark, {})
    by_months = sorted(r[0] for r in rows_of(coverage.wanted_by_months(cal, "20240301", 1)))
    assert len(by_months) == 31 and by_months[0] == "20240131" and by_months[-1] == "20240301"
    by_days = sorted(r[0] for r in rows_of(coverage.wanted_by_days(cal, "20240301", 3)))
    assert by_days == ["20240228", "20240229", "20240301"]


def test_reconciliation_keeps_duplicates(spark):
    probe = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "code string")
    known = spark.createDataFrame([("a",), ("a",), ("c",)], "known string")
    assert rows_of(coverage.codes_not_in(probe, known, "code", "known")) == [("b",), ("b",)]


def test_uncovered_batches(spark):
    batches = spark.createDataFrame(
        [("I", "20240101", "20240331"), ("I", "20240401", "20240610"), ("J", "20240101", "20240131")],
        "index_code string, batch_start string, batch_end string")
    stored = spark.createDataFrame(
        [("I", f"2024{m:02d}") for m in (1, 2, 3, 4, 6)], "index_code string, ym string")
    got = sorted(rows_of(coverage.uncovered_batches(batches, stored)))
    assert got == [("I", "20240401", "20240610"), ("J", "20240101", "20240131")]
