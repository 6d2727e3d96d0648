import datetime as dt
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake import functions as fn
from barlake.session import shared_folder
from conftest import rows_of


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("value, digits, expected", [
    (1.005, 2, 1.0), (2.675, 2, 2.68), (-2.5, 0, -3.0), (0.1234565, 6, 0.123457), (None, 2, None),
])
def test_rounding_scales_first(spark, value, digits, expected):
    assert one(spark, fn.round_half_up(F.lit(value).cast("double"), digits)) == expected


def test_ratio_of_zero_is_null(spark):
    assert one(spark, fn.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, fn.ratio(F.lit(1.0), F.lit(4.0))) == 0.25


@pytest.mark.parametrize("day, months, expected", [
    ("20260331", 1, "20260228"), ("20260228", 1, "20260128"), ("20260115", 3, "20251015"),
    ("20240331", 1, "20240229"),
])
def test_months_ago_clamps_to_month_end(spark, day, months, expected):
    assert one(spark, fn.months_ago(day, months)) == expected


def test_quarter_ends_of_each_month(spark):
    months = [f"2025{m:02d}15" for m in range(1, 13)]
    df = spark.createDataFrame([(m,) for m in months], "d string")
    got = rows_of(df.select("d", fn.quarter_end(F.col("d")), fn.previous_quarter_end(F.col("d"))))
    ends = ["20241231", "20250331", "20250630", "20250930", "20251231"]
    assert got == [(m, ends[i // 3 + 1], ends[i // 3]) for i, m in enumerate(months)]


def test_quarter_ends_of_a_string(spark):
    from barlake.functions.dates import day_quarter_ends

    for day in [f"{y}{m:02d}{d}" for y in (2024, 2025) for m in range(1, 13) for d in ("01", "28")]:
        assert day_quarter_ends(day) == (
            one(spark, fn.previous_quarter_end(day)), one(spark, fn.quarter_end(day)))


def test_day_helpers(spark):
    assert one(spark, fn.next_day("20241231")) == "20250101"
    assert one(spark, fn.month_end("20240210")) == "20240229"
    assert one(spark, fn.history_start("20240215", 15)) == "20090218"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.dates(dt.date(1995, 1, 1), dt.date(2030, 12, 31)), min_size=1, max_size=20))
def test_months_ago_matches_calendar_arithmetic(spark, days):
    import calendar

    def back(d, n):
        y, m = divmod(d.year * 12 + d.month - 1 - n, 12)
        last = calendar.monthrange(y, m + 1)[1]
        return f"{y}{m + 1:02d}{min(d.day, last):02d}"

    df = spark.createDataFrame([(d.strftime("%Y%m%d"),) for d in days], "d string")
    got = rows_of(df.select(fn.months_ago(F.col("d"), 1), fn.months_ago(F.col("d"), 14)))
    assert got == [(back(d, 1), back(d, 14)) for d in days]


def test_shared_folder_comes_from_the_session(spark):
    named = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs:///work/"})
    first, second = shared_folder(named, "x"), shared_folder(named, "x")
    assert first.startswith("hdfs:///work/barlake-x-") and first != second
    unnamed = SimpleNamespace(conf={"spark.sql.warehouse.dir": "hdfs:///tables"})
    assert shared_folder(unnamed, "x").startswith("hdfs:///tables/barlake-work/barlake-x-")


def test_like_keeps_wildcards_and_plain_backslash(spark):
    names = ["a%b", "axb", "a_b", "a\\b", "ab", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")

    def hits(word):
        return [r["n"] for r in df.where(fn.contains_like(F.col("n"), word)).collect()]

    assert hits("a%b") == ["a%b", "axb", "a_b", "a\\b", "ab"]
    assert hits("a_b") == ["a%b", "axb", "a_b", "a\\b"]
    assert hits("\\") == ["a\\b"]


def test_cell_cleaning(spark):
    df = spark.createDataFrame(
        [("",), ("nan",), ("<NA>",), ("None",), ("1.5",), ("x",), (" 2 ",), ("3",), (None,)],
        "c string",
    )
    c = F.col("c")
    got = rows_of(df.select(fn.clean_text(c), fn.to_number(c), fn.to_integer(c)))
    assert got == [
        (None, None, None), (None, None, None), (None, None, None), (None, None, None),
        ("1.5", 1.5, None), ("x", None, None), (" 2 ", 2.0, 2), ("3", 3.0, 3),
        (None, None, None),
    ]
