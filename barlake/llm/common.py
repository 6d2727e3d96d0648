"""What several operators share: reading a table, cutting lineage, word patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.session import scratch_folder

# What parts words, in the two word definitions of the operators' contracts.
BLANKS = r"[\x20\x09-\x0D]+"
NO_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wrapped(docs: DataFrame, *used: str) -> DataFrame:
    """The used columns, and all others in one, so that no name of theirs can clash."""
    rest = [F.col(f"`{c}`").alias(c) for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(F.lit(0).alias("__"), *rest).alias("__rest"))


def unwrapped(df: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """The columns of a :func:`wrapped` table, and some new ones."""
    rest = df.schema["__rest"].dataType.names
    return df.select(*[
        F.col("__rest").getField(c).alias(c) if c in rest else F.col(c) for c in columns], *more)


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the shared checkpoint folder and read from there.

    The folder is the session's ``spark.checkpoint.dir``; only where none is set (tests) one
    below the warehouse folder is taken.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        root = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(root or scratch_folder(spark, "checkpoints"))
    return df.checkpoint()


def cut_clean(df: DataFrame) -> DataFrame:
    """:func:`cut`; the shuffle files that led to the rows go at once, not when the driver happens
    to collect its garbage. For rows whose ``df`` is not used again."""
    rows = cut(df)
    df._jdf.queryExecution().toRdd().cleanShuffleDependencies(True)
    return rows


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet to a new folder below the shared one and read from there."""
    spark = df.sparkSession
    folder = f"{scratch_folder(spark, name)}/rows"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column, between: str) -> Column:
    """The words of a text, of which null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), between), "")


def n_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def text_crc(text: Column) -> Column:
    return F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")
