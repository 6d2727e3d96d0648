"""Landed files (CSV, JSON, Parquet) to typed catalogue rows.

The landing folder replaces the web API: each dataset keeps the filters its API call offers.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.catalog import CATALOG, HISTORY_YEARS, STATEMENTS, TableSpec, spec_of
from barlake.functions import clean_text, history_start, quarter_end, to_integer, to_number
from barlake.sources.quoted import clean, read_quoted
from barlake.sources.tables import where_code, where_dates


# -- reading ---------------------------------------------------------------------------------


ENCODINGS = ("UTF-8", "GBK", "ISO-8859-1")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw lines with the file they stand in and their place there.

    The text source hands over the bytes of each line, so large files are split over tasks.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("place"),
        F.col("value").cast("binary").alias("line"),
        clean(F.col("value")).alias("clean"),
        F.col("_metadata.file_size").alias("size"),
    )


def _decodes(line: Column, encoding: str) -> Column:
    """Whether a line is valid in an encoding. Line feeds never occur inside a character of the
    encodings here, so checking line by line is exact."""
    if encoding == "UTF-8":
        return F.is_valid_utf8(line.cast("string"))
    if encoding == "ISO-8859-1":
        return F.lit(True)

    @F.pandas_udf(T.BooleanType())
    def check(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lines in chunks:
            yield pd.Series([_is_valid(bytes(x), encoding) for x in lines], dtype=bool)

    return check(line)


def _is_valid(line: bytes, encoding: str) -> bool:
    try:
        line.decode(encoding)
    except UnicodeDecodeError:
        return False
    return True


def file_encodings(
    spark: SparkSession, path: str | list[str], encodings: Sequence[str] = ENCODINGS
) -> DataFrame:
    """(file, encoding, header, size, clean): the first of the encodings that decodes the whole
    file, the bytes of the file's first line, and whether each line surely is a record or more.

    UTF-8 is checked inside the JVM; only lines of files that fail it reach Python. A file that
    none of the encodings decodes has a null encoding.
    """
    lines = _lines(spark, path)
    # Spark sorts all lines by file for min_by, unless an aggregate beside it collects.
    files = lines.groupBy("file").agg(
        F.min_by("line", "place").alias("header"),
        F.min(_decodes(F.col("line"), "UTF-8").cast("int")).alias("utf8"),
        F.get(F.collect_set("size"), 0).alias("size"), F.min("clean").alias("clean"),
    )
    found = F.when(F.col("utf8") == 1, "UTF-8") if "UTF-8" in encodings else None
    for n, encoding in enumerate(e for e in encodings if e != "UTF-8"):
        left = files.where("utf8 = 0") if "UTF-8" in encodings else files
        raw = lines.join(left.select("file"), "file", "left_semi")
        valid = raw.select("file", _decodes(F.col("line"), encoding).cast("int").alias("ok"))
        files = files.join(
            valid.groupBy("file").agg(F.min("ok").alias(f"ok{n}")), "file", "left")
        hit = F.col(f"ok{n}") == 1
        found = F.when(hit, encoding) if found is None else found.when(hit, encoding)
    return files.select("file", found.alias("encoding"), "header", "size", "clean")


def _path_of(spark: SparkSession, file: str) -> str:
    """A file's URI, as the metadata column has it, as a path that the readers take literally."""
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(file)).toString()
    return re.sub(r"([\\{}\[\]*?^])", r"\\\1", path)


def _header(line: bytes, encoding: str) -> tuple[str, ...]:
    text = line.decode("gbk" if encoding.upper() == "GBK" else encoding).lstrip("\ufeff")
    return tuple(next(csv.reader([text]), []))


def read_csv(
    spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", multi_line: bool = True
) -> DataFrame:
    """CSV files with headers, every column as text, matched by header name: files may order their
    columns differently or lack some. A byte-order mark is skipped.

    ``multi_line`` allows line breaks inside quotes. Large files are split over tasks all the
    same: those in which no field goes beyond its line by Spark's reader, and the others by
    :mod:`barlake.sources.quoted`. Without it, a line break ends a row.
    """
    return _by_header(spark, file_encodings(spark, path, (encoding,)), path, multi_line)


def read_csv_any_encoding(
    spark: SparkSession, path: str | list[str], encodings: Sequence[str] = ENCODINGS,
    multi_line: bool = True,
) -> DataFrame:
    """As :func:`read_csv`, for files of mixed encodings. GBK needs a session with
    ``spark.sql.legacy.javaCharsets``, as :func:`barlake.session.build_session` makes."""
    return _by_header(spark, file_encodings(spark, path, encodings), path, multi_line)


def _by_header(spark: SparkSession, files: DataFrame, path, multi_line: bool) -> DataFrame:
    """One reader per (encoding, header, way of reading). The driver gets these and the file
    names, the size of the listing that it holds anyway."""
    # A file of one block is one task's work anyway.
    block = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes"))
    way = F.when(F.lit(not multi_line) | F.col("clean"), "lines").when(
        (F.col("size") <= block) | ~clean(F.col("header").cast("string"))
        | F.contains("header", F.lit(b"\r")), "file").otherwise("records")
    groups = files.groupBy("encoding", "header", way.alias("way")).agg(
        F.collect_list("file").alias("files"))
    parts = []
    for row in sorted(groups.collect(), key=str):
        if row["encoding"] is None:
            raise ValueError(f"no known encoding decodes {sorted(row['files'])[:3]}")
        names = _header(bytes(row["header"]), row["encoding"])
        paths = [_path_of(spark, f) for f in row["files"]]
        if row["way"] == "records":
            parts.append(read_quoted(spark, paths, names, row["encoding"]))
            continue
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        parts.append(spark.read.schema(schema).csv(
            paths, header=True, encoding=row["encoding"], escape='"',
            multiLine=row["way"] == "file"))
    if not parts:
        return spark.read.csv(path, header=True)
    return concat_parts(parts)


def text_schema(table: str | TableSpec) -> T.StructType:
    """Landing schema of a CSV or JSON dataset: every column as text."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in spec_of(table).columns])


def read_landed(
    spark: SparkSession, path: str | list[str], fmt: str, table: str | TableSpec,
    multi_line: bool = True,
) -> DataFrame:
    """Landed files of a dataset. JSON and Parquet are read with a schema: JSON would need a
    pass over the data to infer one, and Parquet files whose column is all null may carry
    another type for it than their neighbours."""
    if fmt == "csv":
        return read_csv(spark, path, multi_line=multi_line)
    if fmt == "csv_any":
        return read_csv_any_encoding(spark, path, multi_line=multi_line)
    if fmt == "json":
        return spark.read.schema(text_schema(table)).json(path)
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(spec_of(table).schema).parquet(*paths)


# -- shaping ---------------------------------------------------------------------------------


def normalise(df: DataFrame, table: str | TableSpec, allow_extra: bool = False) -> DataFrame:
    """Raw cells to catalogue types: null texts become null, numbers that do not parse and NaN
    become null, missing columns are null."""
    spec = spec_of(table)
    have = {f.name: f.dataType for f in df.schema.fields}

    def cell(field: T.StructField):
        if field.name not in have:
            value = F.lit(None).cast(field.dataType)
        elif have[field.name] == field.dataType == T.DoubleType():
            value = F.when(~F.isnan(field.name), F.col(field.name))
        elif isinstance(field.dataType, T.DoubleType):
            value = to_number(F.col(field.name))
        elif isinstance(field.dataType, T.IntegerType):
            value = to_integer(F.col(field.name))
        else:
            value = clean_text(F.col(field.name))
        return value.alias(field.name)

    extra = [F.col(c) for c in df.columns if c not in spec.columns] if allow_extra else []
    return df.select(*[cell(f) for f in spec.schema.fields], *extra)


def concat_parts(parts: list[DataFrame]) -> DataFrame:
    """Union by name; a column missing in one part is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def listed_securities(master: DataFrame, exchange: str | None = None) -> DataFrame:
    df = master.where(F.col("list_status") == "L")
    return where_code(df, "exchange", exchange).select(*spec_of("stock_basic").columns)


def classify_st(
    master: DataFrame, needle: str = "ST", starred: str = "*ST"
) -> DataFrame:
    """Securities whose name contains ``needle``; the type says whether it starts starred."""
    name = F.col("name")
    return master.where(F.coalesce(name.contains(needle), F.lit(False))).select(
        "ts_code", "symbol", "name",
        F.when(name.startswith(starred), starred).otherwise(needle).alias("st_type"),
        "industry", "list_date",
    )


# -- dataset slices --------------------------------------------------------------------------

_RANGED = ("daily", "trade_calendar", "adjfactor", "index_daily", "moneyflow")


def landed_slice(
    df: DataFrame,
    table: str,
    as_of: str,
    code: str | None = None,
    trade_date: str | None = None,
    start: str | None = None,
    end: str | None = None,
    period: str | None = None,
    market: str | None = None,
    exchange: str | None = None,
    years: int = HISTORY_YEARS,
) -> DataFrame:
    """Rows of a landed dataset that its API call with these arguments would return.

    A missing date range means the last ``years`` years up to ``as_of``, except where a single
    ``trade_date`` is asked for; a missing ``period`` means the quarter of ``as_of``. Index
    weights have no default range, and need an index code, as index bars do.
    """
    spec = CATALOG[table]
    if table in ("index_weight", "index_daily") and not code:
        raise ValueError(f"{table} needs an index code")
    if table == "stock_basic":
        return listed_securities(df, exchange)
    if table == "st_stocks":
        return classify_st(listed_securities(df))
    if table == "index_basic":
        return where_code(df, "market", market)
    if table == "trade_calendar":
        df = where_code(df, "exchange", exchange)
    else:
        df = where_code(df, spec.code_col, code)
    if table in STATEMENTS:
        wanted = F.lit(period) if period else quarter_end(as_of)
        return df.where(F.col("end_date") == wanted)
    date = F.col(spec.date_col)
    if trade_date:
        df = df.where(date == trade_date)
    elif table in _RANGED:
        df = df.where(date >= (F.lit(start) if start else history_start(as_of, years)))
        return df.where(date <= F.lit(end or as_of))
    return where_dates(df, spec.date_col, start, end)


def income_of_code(df: DataFrame, as_of: str, code: str, period: str | None = None) -> DataFrame:
    """Income statement of one security; unlike the all-codes slice the code is required."""
    if not code:
        raise ValueError("a code is required; use landed_slice for all codes")
    return landed_slice(df, "income", as_of, code=code, period=period)


def ingest(
    spark: SparkSession, table: str, path: str, fmt: str, as_of: str, multi_line: bool = True,
    **filters,
) -> DataFrame:
    """Typed rows of a landed dataset, restricted like :func:`landed_slice`."""
    source = "stock_basic" if table == "st_stocks" else table
    rows = normalise(read_landed(spark, path, fmt, source, multi_line), source)
    return landed_slice(rows, table, as_of, **filters)
