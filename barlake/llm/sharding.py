"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered 0 to n-1 in the order of (bucket of the content hash, order columns). A
Feistel network over the rectangle a x b >= n permutes the numbers; a number that leaves
[0, n) walks on along its cycle until it is back inside. The permuted number p gives
``shard = p mod shards`` and ``slot = p div shards``, so shard sizes differ by one row at
most, slots have no gap, and the place of a row number is computable without the data
(``permuted``), as is the row number of a place (``permuted(..., inverse=True)``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barlake.llm.common import n_bytes, text_crc, unwrapped, wrapped

BUCKETS = 4096
KEYS = (11, 23, 37, 53, 71, 97)
# A walk visits distinct numbers outside [0, n), of which there are fewer than 2 sqrt(n) + 1.
# Beyond 4096 rows each step stays outside with a chance below 3.2 %, so 128 steps always do;
# a walk that were longer would raise.
MAX_WALK = 128


def _sides(n: Column) -> tuple[Column, Column]:
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("long")
    return a, F.greatest(F.ceil(n / a), F.lit(1)).cast("long")


def _rounds(x: Column, a: Column, b: Column, seed: int, inverse: bool) -> Column:
    left, right = F.floor(x / b).cast("long"), F.pmod(x, b)
    order = list(enumerate(KEYS))
    for i, key in reversed(order) if inverse else order:
        other, side = (right, a) if i % 2 == 0 else (left, b)
        step = F.pmod(F.xxhash64(other, F.lit(seed * 1000 + key).cast("long")), side)
        step = -step if inverse else step
        if i % 2 == 0:
            left = F.pmod(left + step, side)
        else:
            right = F.pmod(right + step, side)
    return left * b + right


def permuted(x: Column, n: Column, seed: int = 0, inverse: bool = False) -> Column:
    """The place of row number ``x`` among ``n`` rows (or, inverse, the row at place ``x``)."""
    a, b = _sides(n)
    first = _rounds(x, a, b, seed, inverse)
    steps = F.sequence(F.lit(1), F.least(F.greatest(a * b - n, F.lit(1)), F.lit(MAX_WALK)))
    walked = F.aggregate(
        steps, first,
        lambda at, _: F.when(at < n, at).otherwise(_rounds(at, a, b, seed, inverse)),
    )
    walked = F.when(walked < n, walked).otherwise(F.raise_error("cycle walk did not end"))
    return F.when(first < n, first).otherwise(walked).cast("long")


def numbered(df: DataFrame, order: list[Column], number: str, total: str) -> DataFrame:
    """``df`` with global row numbers from 0, and the number of rows.

    The order columns are hashed into buckets; a bucket's first number is the sum of the counts
    of those before it, a table of at most BUCKETS rows. Only rows equal in all order
    columns share a bucket by force.
    """
    keyed = df.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)))
    counts = keyed.groupBy("__bucket").agg(F.count("*").alias("__n"))
    upto = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "__bucket",
        F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__start"),
        F.sum("__n").over(Window.partitionBy(F.lit(1))).alias(total),
    )
    within = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order))
    return (
        keyed.withColumn("__within", within)
        .join(F.broadcast(starts), "__bucket")
        .withColumn(number, (F.col("__start") + F.col("__within") - 1).cast("long"))
        .drop("__bucket", "__within", "__start")
    )


def placed(df: DataFrame, order: list[Column], shards: int = 16, seed: int = 0) -> DataFrame:
    """``df`` with ``shard`` and ``slot``. Rows equal in all order columns are interchangeable;
    nulls come first. An empty table stays empty."""
    out = numbered(df, order, "__row", "__total")
    place = permuted(F.col("__row"), F.col("__total"), seed)
    return (
        out.withColumn("__place", place)
        .withColumn("shard", F.pmod("__place", F.lit(shards)).cast("int"))
        .withColumn("slot", F.floor(F.col("__place") / shards).cast("long"))
        .drop("__row", "__total", "__place")
    )


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """Whole documents with ``shard`` and ``slot``; columns of these names are replaced.

    Order of the row numbers: hash bucket, then id, bytes, checksum and hash of the text. A
    null or empty text is a text of no bytes.
    """
    text = F.col("text")
    order = [F.col("doc_id"), n_bytes(text), text_crc(text), F.xxhash64(text)]
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = placed(wrapped(docs.select(*columns), "doc_id", "text"), order, shards, seed)
    return unwrapped(rows, columns, "shard", "slot")
