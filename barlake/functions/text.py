"""Text search and the cleaning rules for landed cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that stand for "no value" in landed files.
NULL_TEXTS = ("", "nan", "<NA>", "None")


def contains_like(col: Column, keyword: str) -> Column:
    """``col LIKE '%keyword%'`` in which ``%`` and ``_`` of the keyword are wildcards and a
    backslash is an ordinary character."""
    escape = next(chr(c) for c in range(1, 32) if chr(c) not in keyword)
    return F.like(col, F.lit(f"%{keyword}%"), F.lit(escape))


def clean_text(col: Column) -> Column:
    text = col.cast("string")
    return F.when(~text.isin(*NULL_TEXTS), text)


def to_number(col: Column) -> Column:
    """Double, or null for text that is no number and for NaN."""
    number = F.trim(col.cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_integer(col: Column) -> Column:
    number = to_number(col)
    return F.when(number == F.floor(number), number).try_cast("int")
