"""Market tables as Parquet below one root folder, changed by atomic commits.

An upsert finds the files that hold a key of its batch, writes their other rows and the batch to
a new data folder, and commits (:mod:`barlake.sources.commits`). All other files stay as they are.
Readers see the newest commit and nothing else, so a write that breaks off anywhere leaves the
table as it was, and its rerun starts from the same rows. Of two writers of one table, the later one
keeps its result if the other touched other partitions, and merges anew if not.

What a commit knows of its files answers questions about counts and days without reading them.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.catalog import (
    CATALOG, INDEX_TABLES, TRACKED_INDICES, TableSpec, index_short, spec_of,
)
from barlake.operators.merge import conform, keep_last, merge_keep_last
from barlake.session import remove_folder, shared_folder
from barlake.sources.commits import (
    EMPTY, NULL_PARTITION, CommitLog, Conflict, commit_name, literal_path, part_values,
)
from barlake.sources.tables import Tables, empty_table

# A partition with more small files than this has them rewritten with the next batch.
SMALL_BYTES, SMALL_FILES = 8 << 20, 64
MERGE_ATTEMPTS = 5
KEPT_SNAPSHOTS = 2
FILE_BYTES = 128 << 20
# A batch with more columns than this, most of which one source may leave null, is worth a look before
# its rows are shuffled and sorted.
WIDE = 40
# Stored days that a view lists: those of a hundred years, or of some indices.
DAYS_LISTED = 50_000


class Store(Tables):
    def __init__(self, spark: SparkSession, root: str, indices: dict[str, str] | None = None):
        """``indices`` maps the codes of the tracked indices to their short names."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.indices = indices or TRACKED_INDICES
        self._logs: dict[str, CommitLog] = {}
        # Per table the rows of the commit last read, whose files are listed once.
        self._frames: dict[str, tuple] = {}

    # -- commits ---------------------------------------------------------------------------

    def _log(self, spec: TableSpec) -> CommitLog:
        if spec.name not in self._logs:
            self._logs[spec.name] = CommitLog(self.spark, f"{self.root}/{spec.name}")
        return self._logs[spec.name]

    def _names(self, path: str) -> list[str]:
        return CommitLog(self.spark, path).names()

    def _commits(self, spec: TableSpec) -> list[str]:
        return self._log(spec).commits()

    def _commit(self, spec: TableSpec) -> dict:
        return self._log(spec).commit()

    # -- updates of several tables ---------------------------------------------------------

    def _snapshots(self) -> CommitLog:
        return CommitLog(self.spark, self.root)

    def publish_snapshot(self) -> int:
        """Make the newest commits of all tables what :meth:`snapshot` shows; its number."""
        log = self._snapshots()
        while True:
            number = int((log.names("_snapshots") or ["0"])[-1].removesuffix(".json")) + 1
            commits = {t: self._commit(spec_of(t))["number"] for t in CATALOG}
            if log.put(f"_snapshots/{commit_name(number)}", commits):
                for old in log.names("_snapshots")[:-KEPT_SNAPSHOTS]:
                    log.delete(f"_snapshots/{old}")
                return number

    def snapshot(self) -> Store:
        """A reader of the tables as the last whole update left them, or, without any, of the
        newest commits. It stays as it is while others write; the snapshot before the newest can be
        read until the next update ends."""
        log = self._snapshots()
        names = log.names("_snapshots")
        return Snapshot(self, log.json(f"_snapshots/{names[-1]}")) if names else self

    def _pinned(self, spec: TableSpec) -> set[int]:
        log = self._snapshots()
        return {log.json(f"_snapshots/{n}").get(spec.name, 0) for n in log.names("_snapshots")}

    def _publish(self, spec: TableSpec, *what) -> None:
        self._log(spec).publish(*what)

    def token(self, table: str | TableSpec) -> str | None:
        """What the last upsert of the table was marked with."""
        return self._commit(spec_of(table))["token"]

    def extra_columns(self, table: str | TableSpec) -> T.StructType:
        """The columns that batches brought beyond the catalogue's, in order of appearance."""
        return _columns(self._commit(spec_of(table)))

    # -- reading ---------------------------------------------------------------------------

    def _schema(self, spec: TableSpec, commit: dict) -> T.StructType:
        derived = spec.storage_schema().fields[len(spec.columns):]
        return T.StructType([*spec.schema.fields, *_columns(commit).fields, *derived,
                             T.StructField("version", T.StringType())])

    def _read(self, spec: TableSpec, commit: dict, files: dict[str, list[dict]]) -> DataFrame:
        log = self._log(spec)
        return self.spark.read.schema(self._schema(spec, commit)).option(
            "basePath", log.base).parquet(*log.paths(commit, files))

    def _stored(self, spec: TableSpec, code: str | None = None) -> DataFrame | None:
        """Stored rows including derived partition columns, or None if nothing is stored. Files
        whose codes lie all before or all after ``code`` are left out."""
        log, commit = self._log(spec), self._commit(spec)
        if not commit["parts"]:
            return None
        files = log.files(commit)
        if code is not None:
            chosen = {p: [e for e in own if _may_hold(e, code)] for p, own in files.items()}
            chosen = {p: own for p, own in chosen.items() if own}
            if sum(map(len, chosen.values())) < sum(map(len, files.values())):
                return self._read(spec, commit, chosen or files).where(
                    F.lit(bool(chosen))).drop("version")
        number, df = self._frames.get(spec.name, (None, None))
        if number != commit["number"]:
            # Listing files takes longer than planning a query, so one listing serves a commit.
            df = self._read(spec, commit, files).drop("version")
            self._frames[spec.name] = (commit["number"], df)
        # New names for the columns, so that a table can be joined with itself.
        return df.select(*[F.col(f"`{c}`").alias(c) for c in df.columns])

    def columns_held(self, table: str | TableSpec) -> list[str]:
        """The catalogue's columns that stored rows may have a value in, from the commit alone."""
        spec, commit = spec_of(table), self._commit(spec_of(table))
        return self._held(spec, commit, self._log(spec).files(commit))

    def _held(self, spec: TableSpec, commit: dict, files: dict[str, list[dict]]) -> list[str]:
        held = self._log(spec).held(files)
        return [c for c in spec.columns if held is None or c in held]

    def partition_values(self, table: str | TableSpec, column: str) -> list[str] | None:
        """Stored values of a partition column, from the commit alone, without null."""
        spec = spec_of(table)
        if column not in spec.partitions:
            return None
        at = spec.partitions.index(column)
        found = {part_values(p)[at] for p in self._commit(spec)["parts"]}
        return sorted(found - {None})

    def changes(self, table: str | TableSpec, since: int = 0) -> tuple[int, list[tuple]]:
        """The number of the newest commit, and the values of the partitions that changed after
        commit ``since``."""
        commit = self._commit(spec_of(table))
        return commit["number"], [part_values(p) for p, n in commit["changed"].items()
                                  if n > since]

    def partitions(self, table: str | TableSpec, values: list[tuple]) -> DataFrame:
        """The rows of some partitions, named by their values."""
        spec, wanted = spec_of(table), set(values)
        commit = self._commit(spec)
        files = self._log(spec).files(
            commit, [p for p in commit["parts"] if part_values(p) in wanted])
        if not files:
            return empty_table(self.spark, spec)
        return self._read(spec, commit, files).drop("version")

    def known_files(self, table: str | TableSpec) -> list[tuple[tuple, dict]]:
        """(partition values, file) of every stored file: rows, bytes, days, first and last
        code."""
        spec = spec_of(table)
        files = self._log(spec).files(self._commit(spec))
        return [(part_values(p), e) for p, own in files.items() for e in own]

    def known_days(self, table: str | TableSpec) -> list[str]:
        return sorted({d for _, e in self.known_files(table) for d in e["days"]})

    def _day_rows(self, rows: list[tuple], schema: str, start, end) -> DataFrame:
        within = [r for r in rows if (not start or r[-1] >= start) and (not end or r[-1] <= end)]
        return self.spark.createDataFrame(within, schema)

    def days(self, table, start=None, end=None) -> DataFrame:
        column = spec_of(table).date_col
        return self._day_rows([(d,) for d in self.known_days(table)], f"{column} string",
                              start, end)

    def index_days(self, table, start=None, end=None) -> DataFrame:
        spec, codes = spec_of(table), {short: code for code, short in self.indices.items()}
        found = {(codes[values[0]], d) for values, e in self.known_files(table)
                 for d in e["days"] if values[0] in codes}
        return self._day_rows(sorted(found), f"{spec.code_col} string, {spec.date_col} string",
                              start, end)

    def _scan_stored(self, table, code=None, start=None, end=None, dates=None):
        spec = spec_of(table)
        df = self._stored(spec, code)
        if df is None:
            return None
        for column, width in (("ym", 6), ("year", 4)):
            if column not in spec.derived:
                continue
            if start:
                df = df.where(F.col(column) >= start[:width])
            if end:
                df = df.where(F.col(column) <= end[:width])
            if dates:
                df = df.where(F.col(column).isin(*sorted({d[:width] for d in dates})))
        if code and "index_short" in spec.derived:
            df = df.where(F.col("index_short") == F.lit(self.indices.get(code, "")))
        return df

    def scan(self, table, code=None, start=None, end=None, dates=None) -> DataFrame:
        spec = spec_of(table)
        df = self._scan_stored(table, code, start, end, dates)
        return empty_table(self.spark, spec) if df is None else df.select(*spec.columns)

    def full(self, table: str | TableSpec) -> DataFrame:
        """All rows with all columns: the catalogue's, then those that batches brought beyond."""
        spec = spec_of(table)
        df = self._stored(spec)
        if df is None:
            return empty_table(self.spark, spec)
        return df.select(*spec.columns, *[f"`{n}`" for n in self.extra_columns(spec).names])

    def view(self, name: str) -> DataFrame:
        """As everywhere, with all stored columns, and at the end the partition columns that are
        no data columns.

        Free SQL that restricts the date, or the code of an index, in whatever way, by subqueries
        too, reads the partitions of the remaining days only: date and code come from the short
        list of stored days in the commit, which is joined to the rows, and Spark prunes partitions
        by what its filters leave of the list.
        """
        table, code = self._view_of(name)
        spec = spec_of(table)
        df = self._scan_stored(table, code)
        if df is None:
            return conform(empty_table(self.spark, spec), spec).withColumns(
                {c: F.lit(None).cast("string") for c in spec.derived})
        if code:
            df = df.where(F.col(spec.code_col) == code)
        extra = [f"`{n}`" for n in self.extra_columns(spec).names]
        rows = df.select(*spec.columns, *extra, *spec.derived)
        return rows if not spec.date_col or not spec.derived else self._by_days(rows, spec)

    def _by_days(self, rows: DataFrame, spec: TableSpec) -> DataFrame:
        """The rows, joined with the stored days of each partition; those without a date apart."""
        files, by = self.known_files(spec), list(spec.derived)
        known = sorted({(*values, d) for values, e in files for d in e["days"]}, key=str)
        if len(known) > DAYS_LISTED or not known:
            return rows
        names = [f"_{c}" for c in (*by, spec.date_col)]
        days = self.spark.createDataFrame(known, ", ".join(f"{n} string" for n in names))
        instead = {spec.date_col: names[-1]}
        if "index_short" in by:
            code = F.lit(None).cast("string")
            for index_code, short in self.indices.items():
                code = F.when(F.col("_index_short") == short, index_code).otherwise(code)
            days = days.withColumn("_code", code)
            instead[spec.code_col] = "_code"
        same = [F.col(c) == F.col(f"_{c}") for c in by]
        same += [F.col(c) == F.col(n) for c, n in instead.items()]
        # At most DAYS_LISTED short rows.
        dated = rows.join(F.broadcast(days), same).select(
            *[F.col(instead.get(c, f"`{c}`")).alias(c) for c in rows.columns])
        if not any(e["undated"] for _, e in files):
            return dated
        return dated.union(rows.where(F.col(by[-1]).isNull() & F.col(spec.date_col).isNull()))

    # -- writing ---------------------------------------------------------------------------

    def upsert(
        self, df: DataFrame, table: str | TableSpec, staged: bool = False,
        token: str | None = None,
    ) -> int:
        """Merge a batch into a table on its key and return the number of incoming rows.

        A batch without rows, or without the table's date column, changes nothing. Empty text in
        key and partition columns is null. Index tables take the rows of tracked indices only; the
        returned number tells how many were taken. Columns beyond the catalogue's are kept; rows
        of other batches are null there, and a column keeps the type that it came with first; one
        that is called like a partition column, or ``version``, is not kept. A batch over stored rows is read up to four times: for the partitions it touches, the files
        that hold its keys, its keys and its rows. A batch that is costly to compute is better
        ``staged``: written once to the shared folder, and read from there, without the columns
        that are null in all its rows. A first write reads its batch once anyway, so that only
        wide ones are staged.
        ``token`` marks the commit.
        """
        spec = spec_of(table)
        if spec.date_col and spec.date_col not in df.columns:
            return 0
        incoming = _without_empty(self._with_extra(df, spec), spec)
        if spec.name in INDEX_TABLES:
            incoming = incoming.where(F.col(spec.code_col).isin(*self.indices))
        if not staged or not (self._commit(spec)["parts"] or len(df.columns) > WIDE):
            return self._merge_in(incoming, spec, token)
        folder = shared_folder(self.spark, f"batch-{spec.name}")
        try:
            return self._merge_in(self._staged(incoming, spec, folder), spec, token)
        finally:
            remove_folder(self.spark, folder)

    def _staged(self, incoming: DataFrame, spec: TableSpec, folder: str) -> DataFrame:
        """A batch as written to a folder, without the catalogue's columns that are null in all of
        its rows; files without a column are read as having null there."""
        seen, own = Observation(), [c for c in spec.columns if c in incoming.columns]
        incoming.observe(seen, *[F.count(F.col(f"`{c}`")).alias(c) for c in own]).write.mode(
            "overwrite").parquet(folder)
        gone = {c for c in own if c not in _needed(spec) and not seen.get[c]}
        return self.spark.read.schema(T.StructType(
            [f for f in incoming.schema.fields if f.name not in gone])).parquet(folder)

    def _with_extra(self, df: DataFrame, spec: TableSpec) -> DataFrame:
        """The catalogue's columns that a batch has, and those that no file does without; then all
        others, in the type that they are stored in."""
        known = {n.lower(): (n, t) for n, t in self._commit(spec)["columns"]}
        own = {n.lower() for n in (*spec.columns, *spec.partitions, "version")}
        extra = []
        for f in df.schema.fields:
            if f.name.lower() not in own:
                name, kind = known.get(f.name.lower(), (f.name, f.dataType))
                extra.append(F.col(f"`{f.name}`").cast(kind).alias(name))
        given = [c for c in spec.columns if c in df.columns or c in _needed(spec)]
        return conform(df, spec, allow_extra=True).select(*given, *extra)

    def _with_partitions(self, df: DataFrame, spec: TableSpec) -> DataFrame:
        for name in spec.derived:
            value = spec.partition_column(name)
            if name == "index_short":
                value = index_short(F.col(spec.code_col), self.indices)
            df = df.withColumn(name, value)
        for name in spec.partitions:
            reserved = F.raise_error(F.lit(f"{NULL_PARTITION} is no value of {name}"))
            df = df.withColumn(name, F.when(F.col(name) == NULL_PARTITION, reserved)
                               .otherwise(F.col(name)))
        return df

    def _merge_in(self, incoming: DataFrame, spec: TableSpec, token: str | None) -> int:
        for attempt in range(MERGE_ATTEMPTS):
            try:
                return self._merge_once(incoming, spec, token)
            except Conflict:
                if attempt == MERGE_ATTEMPTS - 1:
                    raise

    def _merge_once(self, incoming: DataFrame, spec: TableSpec, token: str | None) -> int:
        log, before = self._log(spec), self._commit(spec)
        if not before["parts"]:
            seen = Observation()
            fresh = keep_last(incoming.observe(seen, F.count("*").alias("rows")), spec.key,
                              spec.newest_first)
            return seen.get["rows"] if self._write(fresh, spec, before, token) else 0
        # One small row per touched partition value: the batch's size and the list of stored
        # partitions that it may change. All others are neither read nor written.
        parts = list(spec.partitions)
        touched = self._with_partitions(incoming, spec).groupBy(*parts).count().collect()
        rows = sum(row["count"] for row in touched)
        if not rows:
            return 0
        values = {tuple(row[p] for p in parts) for row in touched}
        files = log.files(before, [p for p in before["parts"] if part_values(p) in values])
        old, kept = self._split(incoming, spec, before, files)
        fresh = keep_last(incoming, spec.key, spec.newest_first)
        if any(old.values()):
            # Everything stored went through this merge, so stored keys are unique.
            stored = self._read(spec, before, old).select(
                *self._held(spec, before, old), *[f"`{n}`" for n, _ in before["columns"]])
            fresh = merge_keep_last(stored, incoming, spec.key, spec.newest_first,
                                    stored_is_unique=True)
        self._write(fresh, spec, before, token, kept)
        return rows

    def _split(self, incoming: DataFrame, spec: TableSpec, commit: dict, files: dict):
        """The files of the touched partitions that are rewritten, and those that stay.

        Rewritten are files that hold a key of the batch, the only file of a partition, and the
        small files of a partition that has many. Only the key columns are read for it, which are
        the part of the rows that packs best, and tell for certain.
        """
        old = {p: own for p, own in files.items() if len(own) == 1}
        asked = {p: own for p, own in files.items() if len(own) > 1}
        if not asked:
            return old, {}
        keys = incoming.select(*spec.key).distinct()
        named = self._read(spec, commit, asked).select(
            *[F.col(k).alias(f"_own_{k}") for k in spec.key],
            F.col("_metadata.file_path").alias("file"))
        same = [F.col(k).eqNullSafe(F.col(f"_own_{k}")) for k in spec.key]
        found = named.join(keys, reduce(and_, same), "left_semi").select("file").distinct()
        hit = {_below(r["file"]) for r in found.collect()}
        kept = {}
        for part, own in asked.items():
            small = [e["file"] for e in own if e["bytes"] < SMALL_BYTES]
            gone = hit | set(small if len(small) > SMALL_FILES else [])
            old[part] = [e for e in own if e["file"] in gone]
            kept[part] = [e for e in own if e["file"] not in gone]
        return {p: own for p, own in old.items() if own}, kept

    def cluster(self, table: str | TableSpec, file_bytes: int = FILE_BYTES) -> int:
        """Rewrite the partitions whose files overlap in their codes, so that each file has a
        range of codes of its own, and return how many were rewritten.

        A write gathers a partition in few files, but each with all codes, and later batches add
        more. Once clustered, the rows of one code over all history stand in one file or two of
        each partition, and a batch for some codes rewrites the files of these only.
        """
        spec = spec_of(table)
        if not spec.code_col:
            return 0
        for attempt in range(MERGE_ATTEMPTS):
            before, log = self._commit(spec), self._log(spec)
            files = {p: own for p, own in log.files(before).items() if _overlap(own)}
            if not files:
                return 0
            size = sum(e["bytes"] for own in files.values() for e in own)
            rows = self._read(spec, before, files).select(
                *self._held(spec, before, files), *[f"`{n}`" for n, _ in before["columns"]])
            try:
                self._write(rows, spec, before, before["token"], ranges=1 + size // file_bytes)
                return len(files)
            except Conflict:
                if attempt == MERGE_ATTEMPTS - 1:
                    raise

    def _write(self, df: DataFrame, spec: TableSpec, before: dict, token: str | None,
               kept: dict[str, list[dict]] | None = None, ranges: int = 0) -> bool:
        """Write rows as the new content of their partitions, beside the files in ``kept``.
        Whether there were rows to write. REBALANCE gathers each partition value into files of
        AQE's advisory size: small values share no file, and a hot value is split over many
        tasks. With ``ranges``, tasks have so many ranges of partition, code and date instead."""
        log = self._log(spec)
        folder = log.new_folder(before["number"] + 1)
        path = f"{log.base}/{folder}"
        parts = list(spec.partitions)
        order = parts + [c for c in spec.sort_cols if c not in parts]
        rows = self._with_partitions(df, spec)
        if ranges:
            rows = rows.repartitionByRange(ranges, *dict.fromkeys(
                [*parts, spec.code_col, *spec.sort_cols]))
        else:
            rows = rows.hint("rebalance", *[F.col(c) for c in parts])
        try:
            rows.sortWithinPartitions(*order).write.partitionBy(*parts).parquet(path)
            files = self._described(spec, rows.schema, folder)
            if not files:
                log.delete(folder)
                return False
            written = {p: len(own) for p, own in files.items()}
            for part, own in (kept or {}).items():
                files[part] = own + files.get(part, [])
            extra = [[f.name, f.dataType.simpleString()] for f in df.schema.fields
                     if f.name not in spec.columns]
            held = [c for c in spec.columns if c in df.columns]
            self._publish(spec, before, folder, files, written, token, extra, held)
        except Exception:
            log.delete(folder)
            log.delete(f"_files/{folder}.json")
            raise
        log.clean(self._pinned(spec))
        return True

    def _described(self, spec: TableSpec, schema: T.StructType, folder: str):
        """What a commit keeps of each file of a new data folder, by partition. Reads the code and
        date columns."""
        log = self._log(spec)
        code = F.col(spec.code_col) if spec.code_col else F.lit(None).cast("string")
        day = F.col(spec.date_col) if spec.date_col else F.lit(None).cast("string")
        schema = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
        rows = self.spark.read.schema(schema).option("basePath", log.base).parquet(
            literal_path(f"{log.base}/{folder}"))
        found = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.max("_metadata.file_size").alias("bytes"), F.count("*").alias("rows"),
            F.min(code).alias("low"), F.max(code).alias("high"),
            F.count(code).alias("coded"), F.sort_array(F.collect_set(day)).alias("days"),
            F.count(day).alias("dated"))
        out: dict[str, list[dict]] = {}
        for r in sorted(found.collect(), key=lambda r: r["file"]):
            file = _below(r["file"])
            part = file.split("/", 1)[1].rpartition("/")[0]
            out.setdefault(part, []).append({
                "file": file, "bytes": r["bytes"], "rows": r["rows"],
                "codes": [r["low"], r["high"]], "uncoded": r["rows"] - r["coded"],
                "days": r["days"], "undated": r["rows"] - r["dated"]})
        return out

    def save_daily(self, df: DataFrame) -> int:
        return self.upsert(df, "daily")

    def save_stock_basic(self, df: DataFrame) -> int:
        return self.upsert(df, "stock_basic")

    def save_income(self, df: DataFrame) -> int:
        return self.upsert(df, "income")

    def save_balancesheet(self, df: DataFrame) -> int:
        return self.upsert(df, "balancesheet")

    def save_cashflow(self, df: DataFrame) -> int:
        return self.upsert(df, "cashflow")

    def save_trade_calendar(self, df: DataFrame) -> int:
        return self.upsert(df, "trade_calendar")

    def save_st_stocks(self, df: DataFrame) -> int:
        return self.upsert(df, "st_stocks")

    def save_adjfactor(self, df: DataFrame) -> int:
        return self.upsert(df, "adjfactor")

    def save_moneyflow(self, df: DataFrame) -> int:
        return self.upsert(df, "moneyflow")

    def save_index_basic(self, df: DataFrame, market: str) -> int:
        """Rows landed for one market; the market fills in where a row names none."""
        own = F.nullif(F.col("market"), F.lit("")) if "market" in df.columns else F.lit(None)
        return self.upsert(df.withColumn("market", F.coalesce(own, F.lit(market))), "index_basic")

    def _save_index(self, df: DataFrame, table: str, index_code: str) -> int:
        own = df.where(F.col(spec_of(table).code_col) == index_code)
        return self.upsert(own, table) if index_code in self.indices else 0

    def save_index_weight(self, df: DataFrame, index_code: str) -> int:
        """The rows of one tracked index; those of others are left out, and an unknown index
        saves nothing. Returns how many were taken."""
        return self._save_index(df, "index_weight", index_code)

    def save_index_daily(self, df: DataFrame, index_code: str) -> int:
        """As :meth:`save_index_weight`."""
        return self._save_index(df, "index_daily", index_code)


class Snapshot(Store):
    """The tables as of one commit each; nothing can be written."""

    def __init__(self, store: Store, commits: dict[str, int]):
        super().__init__(store.spark, store.root, store.indices)
        self._numbers = commits

    def _commit(self, spec: TableSpec) -> dict:
        number = self._numbers.get(spec.name, 0)
        return self._log(spec).commit(commit_name(number)) if number else EMPTY

    def upsert(self, *_, **__) -> int:
        raise TypeError("a snapshot is for reading; write to its store")


def _without_empty(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Empty text in key and partition columns as null, which it would be read back as."""
    names = {*spec.key, *(c for c in (spec.date_col,) if c), *(
        c for c in spec.partitions if c not in spec.derived)}
    kinds = dict(df.dtypes)
    return df.withColumns({
        c: F.nullif(F.col(c), F.lit("")) for c in df.columns if c in names
        and kinds[c] == "string"})


def _needed(spec: TableSpec) -> set[str | None]:
    """The columns that all files have, be they null: they say which row it is, and where it goes."""
    return {*spec.key, *spec.partitions, *spec.sort_cols, spec.code_col, spec.date_col}


def _overlap(files: list[dict]) -> bool:
    """Whether some code may stand in two files without being at the end of one and the beginning
    of the next."""
    held = sorted((e["codes"] for e in files if e["codes"][0] is not None))
    return any(b[0] < a[1] for a, b in zip(held, held[1:], strict=False))


def _below(uri: str) -> str:
    """The path below the table's folder of a file's URI, which has special characters as %XX."""
    path = unquote(uri)
    return path[path.rindex("/version=") + 1:]


def _columns(commit: dict) -> T.StructType:
    fields = (f for n, t in commit["columns"]
              for f in T.StructType.fromDDL(f"`{n}` {t}").fields)
    return T.StructType(list(fields))


def _may_hold(entry: dict, code: str) -> bool:
    low, high = entry["codes"]
    return low is not None and low <= code <= high
