"""The query interface: every canned query over one set of tables, next to free SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from barlake.operators import export, profile
from barlake.plans.calendar import CalendarQueries
from barlake.plans.equities import EquityQueries
from barlake.plans.indices import IndexQueries
from barlake.plans.statements import StatementQueries
from barlake.sources.tables import Tables


class Market(EquityQueries, StatementQueries, IndexQueries, CalendarQueries):
    def __init__(self, tables: Tables):
        self.tables = tables

    def raw_sql(self, text: str, **args) -> DataFrame:
        """Spark SQL over the table views; values go in as named parameters (``:name``).

        Every view the text mentions is registered anew, so it shows the latest writes.
        """
        words = set(re.findall(r"\w+", text.lower()))
        self.tables.register_views(v for v in self.tables.view_names() if v in words)
        return self.tables.spark.sql(text, args=args or None)

    def record_counts(self) -> DataFrame:
        return profile.record_counts(self.tables)

    def get_schemas(self) -> DataFrame:
        return profile.table_schemas(self.tables.spark)

    def manifest(self) -> DataFrame:
        return profile.manifest(self.tables)

    def export_table(self, table: str, path: str, fmt: str = "csv", **filters) -> bool:
        return export.export_table(self.tables, table, path, fmt, **filters)
