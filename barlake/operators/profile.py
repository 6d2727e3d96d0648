"""Row counts, schemas, partition statistics and column profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.catalog import CATALOG, INDEX_TABLES, spec_of
from barlake.sources.tables import Tables

# How a table is cut into partitions, as the manifest names it.
PARTITION_KINDS = {
    "daily": "by_date", "income": "by_date", "cashflow": "by_date", "balancesheet": "by_date",
    "adjfactor": "by_date", "moneyflow": "by_date", "trade_calendar": "by_year",
    "index_basic": "by_market", "index_weight": "by_index", "index_daily": "by_index",
    "stock_basic": "single", "st_stocks": "single",
}


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table"), "row_count")


def record_counts(tables: Tables) -> DataFrame:
    """(table, row_count), one row per catalogue table, 0 where nothing is stored. No row is read
    where the files tell."""
    files = {t: tables.known_files(t) for t in CATALOG}
    known = [(t, sum(e["rows"] for _, e in own)) for t, own in files.items() if own is not None]
    parts = [row_count(tables.scan(t), t) for t, own in files.items() if own is None]
    if known:
        parts.append(tables.spark.createDataFrame(known, "table string, row_count long"))
    return union_all(parts)


def table_schemas(spark: SparkSession) -> DataFrame:
    """(table, position, column, type, nullable) of every catalogue table."""
    rows = [
        (name, i, f.name, f.dataType.simpleString(), f.nullable)
        for name, spec in CATALOG.items()
        for i, f in enumerate(spec.schema.fields, 1)
    ]
    return spark.createDataFrame(
        rows, "table string, position int, column string, type string, nullable boolean"
    )


def partition_label(table: str):
    """The value a table's rows are grouped by in the manifest."""
    spec = spec_of(table)
    kind = PARTITION_KINDS[table]
    if kind == "single":
        return F.lit(table)
    if kind == "by_market":
        return F.col("market")
    if kind == "by_year":
        return F.substring(F.col(spec.date_col), 1, 4)
    return F.col(spec.date_col)


def partition_counts(df: DataFrame, label) -> DataFrame:
    """(partition, row_count) for any partitioning expression."""
    return df.groupBy(label.alias("partition")).agg(F.count("*").alias("row_count"))


def table_manifest(df: DataFrame, table: str) -> DataFrame:
    """One row: rows, partitions, partition kind and the first and last partition.

    An index table has one partition per index and date; first and last are its true date
    bounds.
    """
    keys = [partition_label(table).alias("partition")]
    if table in INDEX_TABLES:
        keys.insert(0, F.col(spec_of(table).code_col).alias("_index"))
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    single = PARTITION_KINDS[table] == "single"
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("partitions"),
        F.min("partition").alias("first"),
        F.max("partition").alias("last"),
    ).select(
        F.lit(table).alias("table"), "rows", "partitions",
        F.lit(PARTITION_KINDS[table]).alias("kind"),
        (F.lit(None).cast("string") if single else F.col("first")).alias("first"),
        (F.lit(None).cast("string") if single else F.col("last")).alias("last"),
    )


def known_manifest(files: list[tuple[tuple, dict]], table: str) -> tuple:
    """The row of :func:`table_manifest` from what is known of a table's files."""
    kind, found = PARTITION_KINDS[table], set()
    for values, entry in files:
        index = values[0] if table in INDEX_TABLES else None
        if kind == "single":
            found.add((index, table))
        elif kind == "by_market":
            found.add((index, values[0]))
        else:
            width = 4 if kind == "by_year" else None
            found |= {(index, d[:width]) for d in entry["days"]}
            found |= {(index, None)} if entry["undated"] else set()
    named = sorted({v for _, v in found if v is not None}) if kind != "single" else []
    first, last = (named[0], named[-1]) if named else (None, None)
    return table, sum(e["rows"] for _, e in files), len(found), kind, first, last


def manifest(tables: Tables) -> DataFrame:
    files = {t: tables.known_files(t) for t in CATALOG}
    known = [known_manifest(own, t) for t, own in files.items() if own is not None]
    parts = [table_manifest(tables.scan(t), t) for t, own in files.items() if own is None]
    if known:
        parts.append(tables.spark.createDataFrame(
            known, "table string, rows long, partitions long, kind string, first string, "
                   "last string"))
    return union_all(parts)


def profile(df: DataFrame, distinct: list[str] = ()) -> DataFrame:
    """(column, non_null, distinct_count); the distinct count only for the named columns.

    The non-null counts take one pass without a shuffle of rows; each exact distinct count
    aggregates its own column, so no row is expanded once per counted column.
    """
    names = df.columns
    counted = df.agg(*[F.expr(f"count(`{c}`) AS `{c}`") for c in names])
    pairs = ", ".join(f"'{c}', `{c}`" for c in names)
    long = counted.selectExpr(f"stack({len(names)}, {pairs}) AS (column, non_null)")
    if not distinct:
        return long.withColumn("distinct_count", F.lit(None).cast("long"))
    sizes = union_all([
        df.select(F.col(c).alias("v")).where("v IS NOT NULL").distinct()
        .agg(F.count("*").alias("distinct_count")).withColumn("column", F.lit(c))
        for c in distinct
    ])
    return long.join(sizes, "column", "left").select("column", "non_null", "distinct_count")
