"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Sources in code-point order (null last) get the weights in turn. They share ``ratio`` times
all words by weight; none gets more than ``max_epochs`` times its own words. What a clamped
source leaves over goes to the others by weight, until none is above its cap. The level where
this ends is read off the sources sorted by cap / weight, with prefix sums.

A target of f times its source's words takes every document floor(f) times, and for the rest
once more the documents that come first in a seeded order, up to the one that brings the
words nearest to the target. A prefix sum over 4096 hash buckets per source, then within one
bucket, finds that place, so no source is ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barlake.llm.common import BLANKS, text_crc, unwrapped, words, wrapped

WEIGHTS = (5, 2, 1)


def n_words(text: Column) -> Column:
    return F.size(words(text, BLANKS)).cast("long")


def water_filled(sources: DataFrame, ratio: float, max_epochs: float) -> DataFrame:
    """``target`` words of each source (key, words, weight).

    One row per source, so the windows here are as small as the list of sources.
    """
    rest = Window.orderBy("__fill", "key")
    cap = F.col("words") * F.lit(max_epochs)
    filled = (
        sources.withColumn("__cap", cap)
        .withColumn("__fill", F.col("__cap") / F.col("weight"))
        .withColumn("__clamped", F.coalesce(
            F.sum("__cap").over(rest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("__open", F.sum("weight").over(rest.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("__goal", F.sum("words").over(Window.partitionBy(F.lit(1))) * F.lit(ratio))
        .withColumn("__level", (F.col("__goal") - F.col("__clamped")) / F.col("__open"))
        .withColumn("__free", F.col("__cap") > F.col("__level") * F.col("weight"))
        .withColumn("__place", F.row_number().over(rest))
    )
    first = F.min(F.when(F.col("__free"), F.struct("__place", "__level")))
    level = first.over(Window.partitionBy(F.lit(1)))["__level"]
    share = F.least("__cap", F.coalesce(level * F.col("weight"), F.col("__cap")))
    return filled.select("key", "words", share.alias("target"))


def mixed(
    df: DataFrame,
    source_col: str,
    order: list[Column],
    size: Column,
    weights: Sequence[int] = WEIGHTS,
    ratio: float = 1.5,
    max_epochs: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """``df`` with __size (words), __source_size, __target and __copies.

    Null is a source of its own. A source without words has target 0 and no copies. Documents
    without words get whole repetitions only. Repeated rows are mixed each for itself. Ties in
    the seeded order are broken by ``order``; rows equal in that are interchangeable.
    """
    source = F.col(source_col).cast("string")
    drawn = F.md5(F.concat_ws(":", F.lit(seed), *[
        F.coalesce(c.cast("string"), F.lit("~")) for c in order]))
    keyed = (
        df.withColumn("__size", size)
        .withColumn("__key", F.coalesce(F.concat(F.lit("="), source), F.lit("~")))
        .withColumn("__drawn", drawn)
        .withColumn("__bucket", F.substring("__drawn", 1, 3))
    )
    parts = keyed.groupBy("__key", "__bucket").agg(F.sum("__size").alias("__sum"))
    turn = F.pmod(F.row_number().over(Window.orderBy("key")) - 1, F.lit(len(weights)))
    sources = (
        parts.groupBy(F.col("__key").alias("key")).agg(F.sum("__sum").alias("words"))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    )
    targets = water_filled(sources, ratio, max_epochs)
    before = Window.partitionBy("__key").orderBy("__bucket")
    starts = (
        parts.withColumn("__start", F.coalesce(
            F.sum("__sum").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(targets.withColumnRenamed("key", "__key"), "__key")
        .select("__key", "__bucket", "__start",
                F.col("words").alias("__source_size"), F.col("target").alias("__target"))
    )
    upto = (
        Window.partitionBy("__key", "__bucket").orderBy("__drawn", *order, "__size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = F.when(F.col("__source_size") > 0,
                   F.floor(F.col("__target") / F.col("__source_size"))).otherwise(F.lit(0))
    reached = F.col("__start") + F.coalesce(F.sum("__size").over(upto), F.lit(0))
    quota = F.col("__target") - F.col("__whole") * F.col("__source_size")
    extra = (F.col("__size") > 0) & (2 * F.col("__reached") + F.col("__size") <= 2 * quota)
    return (
        keyed.join(starts, ["__key", "__bucket"])
        .withColumn("__whole", whole.cast("long"))
        .withColumn("__reached", reached)
        .withColumn("__copies", (F.col("__whole") + extra.cast("long")).cast("int"))
        .drop("__key", "__bucket", "__drawn", "__start", "__whole", "__reached")
    )


def mix_documents(df: DataFrame, seed: str = "mix") -> DataFrame:
    """Documents as often as the mix takes them, with the columns they came with."""
    order = [F.col("doc_id"), text_crc(F.col("text"))]
    rows = wrapped(df, "doc_id", "text", "source")
    out = mixed(rows, "source", order, n_words(F.col("text")), seed=seed)
    copies = F.explode(F.sequence(F.lit(1), F.col("__copies")))
    return unwrapped(out.where("__copies > 0").withColumn("__copy", copies), df.columns)
