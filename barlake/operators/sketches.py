"""Distinct counts from sketches that are kept per partition and add up.

A HyperLogLog sketch of each column of each partition is stored beside the table. After a write,
only the partitions that it changed are sketched again; the sketches of all partitions, a few
kilobytes each, then give the distinct counts of the whole table, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.catalog import TableSpec, spec_of
from barlake.sources.store import Store

LOG_REGISTERS = 12
# Relative standard error with 2^12 registers; three of it hold an estimate almost surely.
ERROR = 1.04 / (1 << LOG_REGISTERS) ** 0.5
BOUND = 3 * ERROR


def sketch_table(table: str) -> TableSpec:
    """The table that holds the sketches of another one; its token is the number of the commit
    that they were drawn from."""
    text = [T.StructField(n, T.StringType()) for n in ("part", "column")]
    return TableSpec(
        f"sketches_{table}", T.StructType([
            *text, T.StructField("non_null", T.LongType()),
            T.StructField("sketch", T.BinaryType())]),
        ("part", "column"), "part", None, (), (), (), ("part", "column"))


def sketched(rows: DataFrame, columns: list[str], part) -> DataFrame:
    """(part, column, non_null, sketch) of some columns of each part; one pass, in which sketches
    are added up before the shuffle."""
    counts = [F.count(c).alias(f"n{k}") for k, c in enumerate(columns)]
    # Equal numbers may have two bit patterns (0.0 and -0.0), and text stands for any type.
    values = [F.col(c).cast("string") if t not in ("double", "float")
              else F.when(F.col(c) == 0, 0.0).otherwise(F.col(c)).cast("string")
              for c, t in rows.select(*columns).dtypes]
    sketches = [F.hll_sketch_agg(v, LOG_REGISTERS).alias(f"s{k}") for k, v in enumerate(values)]
    wide = rows.groupBy(part.alias("part")).agg(*counts, *sketches)
    cells = ", ".join(f"'{c}', n{k}, s{k}" for k, c in enumerate(columns))
    return wide.selectExpr(
        "part", f"stack({len(columns)}, {cells}) AS (column, non_null, sketch)")


def refresh(store: Store, table: str) -> DataFrame:
    """The sketches of a stored table, brought up to date."""
    spec, kept = spec_of(table), sketch_table(table)
    number, changed = store.changes(spec, int(store.token(kept) or 0))
    if changed:
        names = [F.coalesce(F.concat(F.lit("="), F.col(p)), F.lit("~")) for p in spec.partitions]
        part = F.concat_ws("/", *names) if names else F.lit("all")
        rows = store.partitions(spec, changed)
        store.upsert(sketched(rows, spec.columns, part), kept, staged=True, token=str(number))
    return store.scan(kept)


def profile_sketched(store: Store, table: str) -> DataFrame:
    """(column, non_null, distinct_estimate, low, high) of all columns of a stored table. The
    estimate is within BOUND of the distinct count with a chance of 99.7 %, and exact or nearly
    so for some hundred values; ``low`` and ``high`` are the counts that it may stand for."""
    found = refresh(store, table).groupBy("column").agg(
        F.sum("non_null").alias("non_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
    about = F.col("distinct_estimate")
    return found.select(
        "column", "non_null", "distinct_estimate",
        F.floor(about / (1 + BOUND)).alias("low"), F.ceil(about / (1 - BOUND)).alias("high"))
