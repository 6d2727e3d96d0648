"""Readers over the market tables, whatever holds them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.catalog import CATALOG, INDEX_TABLES, TRACKED_INDICES, TableSpec, spec_of


def where_code(df: DataFrame, column: str, code: str | None) -> DataFrame:
    return df if not code else df.where(F.col(column) == F.lit(code))


def where_dates(
    df: DataFrame, column: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Inclusive range over ``yyyyMMdd`` text; either bound may be missing."""
    if start:
        df = df.where(F.col(column) >= F.lit(start))
    if end:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def ordered(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


class Tables:
    """The twelve tables as DataFrames. Subclasses say where the rows come from."""

    spark: SparkSession
    indices: dict[str, str] = TRACKED_INDICES

    def scan(
        self, table: str, code: str | None = None, start: str | None = None,
        end: str | None = None, dates: tuple[str, ...] | None = None,
    ) -> DataFrame:
        """All rows of a table in catalogue columns. The optional arguments are hints to skip
        storage; the exact predicates are applied by :meth:`slice` and :meth:`on_dates`."""
        raise NotImplementedError

    def given(
        self, table: str, start: str | None = None, end: str | None = None
    ) -> DataFrame:
        """:meth:`scan` in the columns that the source has, if it is known to lack some; these are
        null in a scan."""
        return self.scan(table, start=start, end=end)

    def slice(
        self, table: str, code: str | None = None, start: str | None = None,
        end: str | None = None,
    ) -> DataFrame:
        """Rows of one code (or all) within an inclusive date range, unordered."""
        spec = spec_of(table)
        df = self.scan(table, code=code, start=start, end=end)
        if spec.code_col:
            df = where_code(df, spec.code_col, code)
        if spec.date_col:
            df = where_dates(df, spec.date_col, start, end)
        return df

    def on_dates(self, table: str, *dates: str) -> DataFrame:
        """Rows of the given dates only."""
        spec = spec_of(table)
        return self.scan(table, dates=dates).where(F.col(spec.date_col).isin(*dates))

    def read(
        self, table: str, code: str | None = None, start: str | None = None,
        end: str | None = None,
    ) -> DataFrame:
        """:meth:`slice` in the table's reading order."""
        return ordered(self.slice(table, code, start, end), spec_of(table).sort_cols)

    def read_daily(self, ts_code=None, start_date=None, end_date=None) -> DataFrame:
        return self.read("daily", ts_code, start_date, end_date)

    def read_stock_basic(self, ts_code=None) -> DataFrame:
        return self.read("stock_basic", ts_code)

    def read_income(self, ts_code=None, start_date=None, end_date=None) -> DataFrame:
        return self.read("income", ts_code, start_date, end_date)

    def read_balancesheet(self, ts_code=None, start_date=None, end_date=None) -> DataFrame:
        return self.read("balancesheet", ts_code, start_date, end_date)

    def read_cashflow(self, ts_code=None, start_date=None, end_date=None) -> DataFrame:
        return self.read("cashflow", ts_code, start_date, end_date)

    def read_trade_calendar(self, exchange=None, start_date=None, end_date=None) -> DataFrame:
        return self.read("trade_calendar", exchange, start_date, end_date)

    def read_st_stocks(self, ts_code=None) -> DataFrame:
        return self.read("st_stocks", ts_code)

    def read_adjfactor(self, ts_code=None, start_date=None, end_date=None) -> DataFrame:
        return self.read("adjfactor", ts_code, start_date, end_date)

    def read_moneyflow(self, ts_code=None, start_date=None, end_date=None) -> DataFrame:
        return self.read("moneyflow", ts_code, start_date, end_date)

    def read_index_basic(self, market=None) -> DataFrame:
        df = where_code(self.scan("index_basic"), "market", market)
        return ordered(df, spec_of("index_basic").sort_cols)

    def read_index_weight(
        self, index_code=None, start_date=None, end_date=None, con_code=None
    ) -> DataFrame:
        df = self.slice("index_weight", index_code, start_date, end_date)
        return ordered(
            where_code(df, "con_code", con_code), spec_of("index_weight").sort_cols
        )

    def read_index_daily(self, index_code=None, start_date=None, end_date=None) -> DataFrame:
        return self.read("index_daily", index_code, start_date, end_date)

    def index_view(self, table: str, short: str) -> DataFrame:
        """Rows of one tracked index, addressed by its short name."""
        code = next(c for c, s in self.indices.items() if s == short)
        return self.slice(table, code)

    def index_union(self, table: str) -> DataFrame:
        """Union of the per-index views. The indices are disjoint, so one scan with a list
        predicate returns what a union of one scan per index would."""
        spec: TableSpec = spec_of(table)
        return self.scan(table).where(F.col(spec.code_col).isin(*self.indices))

    def _view_of(self, name: str) -> tuple[str, str | None]:
        """Table and index code behind a view name: ``<table>_view`` or
        ``<table>_<index>_view``."""
        base = name.removesuffix("_view")
        if base in CATALOG:
            return base, None
        table = next(t for t in INDEX_TABLES if base.startswith(f"{t}_"))
        short = base.removeprefix(f"{table}_")
        return table, next(c for c, s in self.indices.items() if s == short)

    def view(self, name: str) -> DataFrame:
        table, code = self._view_of(name)
        return self.slice(table, code)

    def partition_values(self, table: str, column: str) -> list[str] | None:
        """Values of a partition column if they are known without reading rows."""
        return None

    def known_files(self, table: str | TableSpec) -> list[tuple[tuple, dict]] | None:
        """(partition values, what is known of a file) of all files, where rows are in files of
        which something is known."""
        return None

    def known_days(self, table: str | TableSpec) -> list[str] | None:
        """The days that have rows, in order, if they are known without reading rows."""
        return None

    def days(self, table: str, start: str | None = None, end: str | None = None) -> DataFrame:
        """The days that have rows, as one column under its own name."""
        return self.slice(table, start=start, end=end).select(
            spec_of(table).date_col).distinct()

    def index_days(
        self, table: str, start: str | None = None, end: str | None = None
    ) -> DataFrame:
        """The index codes and the days that each has rows of, under their own names."""
        spec = spec_of(table)
        return self.slice(table, start=start, end=end).select(
            spec.code_col, spec.date_col).distinct()

    def view_names(self) -> list[str]:
        shorts = [f"{t}_{s}_view" for t in INDEX_TABLES for s in self.indices.values()]
        return sorted([f"{t}_view" for t in CATALOG] + shorts)

    def register_views(self, names: Iterable[str] | None = None) -> None:
        """Temp views for free SQL: one per table and one per tracked index, or the named."""
        for name in self.view_names() if names is None else names:
            self.view(name).createOrReplaceTempView(name)


def empty_table(spark: SparkSession, table: str | TableSpec) -> DataFrame:
    """Zero rows that the optimiser knows to be empty, so that joins with them vanish."""
    cols = [
        f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in spec_of(table).schema.fields
    ]
    return spark.range(1).selectExpr(*cols).where("false")
