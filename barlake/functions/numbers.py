"""Arithmetic with the rounding and zero rules of the canned queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round the scaled binary value half away from zero.

    ``F.round`` rounds the decimal text of a double instead, which gives 1.01 for 1.005.
    """
    if digits == 0:
        return F.round(value, 0)
    scale = F.lit(10.0 ** digits)
    return F.round(value * scale, 0) / scale


def ratio(part: Column, whole: Column) -> Column:
    """Quotient that is null where the divisor is zero."""
    return F.try_divide(part, whole)


def cents(value: Column) -> Column:
    """An amount with two decimals as a whole number, so that its sums are exact and do not
    depend on the order in which partitions are merged."""
    return F.round(value * 100, 0).cast("long")


def from_cents(value: Column) -> Column:
    return value.cast("double") / F.lit(100.0)
