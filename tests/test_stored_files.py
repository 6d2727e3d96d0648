"""Which files of a stored table are read and rewritten, and what commits tell without reading."""

import threading

import pytest
from pyspark.sql import functions as F

from barlake.catalog import spec_of
from barlake.operators import sketches
from barlake.operators.profile import manifest, profile, record_counts, table_manifest
from barlake.plans.market import Market
from barlake.plans.updates import apply_update
from barlake.sources import commits
from barlake.sources.commits import CommitLog
from barlake.sources.store import Store
from conftest import make, rows_of

LATEST = """
    SELECT ts_code, trade_date, close, pct_chg, amount
    FROM daily_view
    WHERE trade_date = (SELECT MAX(trade_date) FROM daily_view)
    ORDER BY amount DESC
    LIMIT 10
"""
LATEST_JOIN = """
    SELECT
        d.ts_code,
        s.name,
        s.industry,
        d.trade_date,
        d.close,
        d.pct_chg,
        d.amount
    FROM daily_view d
    LEFT JOIN stock_basic_view s ON d.ts_code = s.ts_code
    WHERE d.trade_date = (SELECT MAX(trade_date) FROM daily_view)
      AND s.industry IS NOT NULL
    ORDER BY d.amount DESC
    LIMIT 20
"""


def bar(code, date, close, **kw):
    return {"ts_code": code, "trade_date": date, "close": close, **kw}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "market"))


def closes(store):
    return sorted(rows_of(store.scan("daily").select("ts_code", "trade_date", "close")), key=str)


def files_of(store, table="daily"):
    return {e["file"] for _, e in store.known_files(table)}


def _month_of_files(store, spark, files):
    """One month in many files, each with rows of all codes."""
    rows = spark.range(0, files * 40, 1, files).selectExpr(
        "concat('C', lpad(CAST(id % 500 AS STRING), 4, '0')) AS ts_code",
        "concat('202401', lpad(CAST(1 + id % 28 AS STRING), 2, '0')) AS trade_date",
        "CAST(id AS DOUBLE) AS close").dropDuplicates(["ts_code", "trade_date"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = rows.repartition(files)
        commit = store._commit(spec_of("daily"))
        # REBALANCE would gather so few rows in one file.
        folder = store._log(spec_of("daily")).new_folder(1)
        path = f"{store.root}/daily/{folder}"
        full = store._with_partitions(store._with_extra(rows, spec_of("daily")), spec_of("daily"))
        full.write.partitionBy("ym").parquet(path)
        files = store._described(spec_of("daily"), full.schema, folder)
        store._publish(spec_of("daily"), commit, folder, files,
                       {p: len(own) for p, own in files.items()}, None, [])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_only_files_that_hold_a_key_are_rewritten(store, spark):
    _month_of_files(store, spark, 50)
    before, rows = files_of(store), dict(((r[0], r[1]), r[2]) for r in closes(store))
    assert len(before) == 50
    some = sorted(rows)[::151][:10]
    batch = [bar(c, d, -1.0) for c, d in some] + [bar("NEW", "20240105", 5.0)]
    holding = {r["file"] for r in store._stored(spec_of("daily")).where(
        F.concat("ts_code", F.lit("|"), "trade_date").isin(*["|".join(k) for k in some])
    ).select(F.input_file_name().alias("file")).collect()}
    assert store.save_daily(make(spark, "daily", batch)) == len(batch)
    kept = files_of(store) & before
    assert len(before - kept) == len(holding) <= 10
    assert closes(store) == sorted(
        ((*k, v) for k, v in (rows | {k: -1.0 for k in some} | {("NEW", "20240105"): 5.0}).items()),
        key=str)
    # Files of an old commit stay as long as it does, then go one by one.
    for n in range(3):
        store.save_daily(make(spark, "daily", [bar("C0001", "20240102", float(n))]))
    on_disk = {f"{f}/{p}/{n}" for f in store._names(f"{store.root}/daily")
               for p in store._names(f"{store.root}/daily/{f}")
               for n in store._names(f"{store.root}/daily/{f}/{p}")}
    assert files_of(store) <= on_disk
    assert len(on_disk) <= len(files_of(store)) + 3


def _statement(code, end="20231231", **kw):
    return {"ts_code": code, "end_date": end, "ann_date": "20240131", **kw}


@pytest.mark.parametrize("staged", [True, False])
def test_files_lack_the_columns_that_no_row_fills(store, spark, staged):
    spec = spec_of("income")
    wide = make(spark, "income", [_statement("A", revenue=1.0), _statement("B", revenue=2.0)])
    # Unstaged, only the columns that the batch does not have are known to be null.
    first = wide if staged else wide.select("ts_code", "end_date", "ann_date", "revenue")
    assert store.upsert(first, "income", staged=staged) == 2
    held = ["ts_code", "ann_date", "end_date", "revenue"]
    assert store.columns_held("income") == held
    file = f"{store.root}/income/{next(iter(files_of(store, 'income')))}"
    assert spark.read.parquet(file).columns == ["ts_code", "ann_date", "revenue"]
    assert store.scan("income").schema == wide.schema
    # Another batch fills other columns, of a row that is replaced and of a new one.
    second = make(spark, "income", [_statement("B", ebit=3.0, note="x"), _statement("C", ebit=4.0)])
    store.upsert(second.withColumn("note", F.lit(None).cast("string")), "income", staged=True)
    assert set(store.columns_held("income")) == {*held, "ebit"}
    seen = [("A", 1.0, None), ("B", None, 3.0), ("C", None, 4.0)]
    for _ in range(2):
        rows = store.scan("income")
        assert rows.columns == spec.columns
        assert sorted(rows_of(rows.select("ts_code", "revenue", "ebit"))) == seen
        assert store.extra_columns("income").names == ["note"]
        store.upsert(make(spark, "income", [_statement("D", "20230930")]), "income", staged=True)
        seen += [("D", None, None)] if len(seen) == 3 else []
    assert sorted(rows_of(store.full("income").select("ts_code", "revenue", "ebit", "note"))) == [
        (*r, None) for r in seen]


def test_a_list_that_does_not_say_its_columns_has_all(store, spark):
    _month_of_files(store, spark, 3)
    store.upsert(make(spark, "daily", [bar("C0001", "20240102", 1.0)]), "daily", staged=True)
    assert store.columns_held("daily") == spec_of("daily").columns


def test_many_small_files_are_gathered(store, spark, monkeypatch):
    monkeypatch.setattr("barlake.sources.store.SMALL_FILES", 20)
    _month_of_files(store, spark, 24)
    before = closes(store)
    store.save_daily(make(spark, "daily", [bar("NEW", "20240105", 5.0)]))
    assert len(files_of(store)) == 1
    assert closes(store) == sorted([*before, ("NEW", "20240105", 5.0)], key=str)


def test_a_code_outside_a_files_bounds_leaves_it_unread(store, spark):
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0), bar("C", "20240103", 1.0)]))
    store.save_daily(make(spark, "daily", [bar("M", "20240202", 2.0), bar(None, "20240203", 2.0)]))
    assert len(store.slice("daily", "B").inputFiles()) == 1
    assert rows_of(store.slice("daily", "M").select("close")) == [(2.0,)]
    assert store.slice("daily", "Z").count() == 0
    assert store.slice("daily").count() == 4


# -- other writers -----------------------------------------------------------------------------


def _between(store, monkeypatch, other, times=1):
    """Let ``other`` run right before the next commits are put in place."""
    put, left = CommitLog.put, [times]

    def slow(self, path, content):
        if path.startswith("_commits") and left[0]:
            left[0] -= 1
            other()
        return put(self, path, content)

    monkeypatch.setattr(CommitLog, "put", slow)


def test_writers_of_two_months_both_succeed(store, spark, monkeypatch):
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0), bar("A", "20240202", 1.0)]))
    other = Store(spark, store.root)
    _between(store, monkeypatch, lambda: other.save_daily(
        make(spark, "daily", [bar("A", "20240202", 2.0), bar("B", "20240302", 2.0)])))
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 3.0)]))
    assert closes(store) == [("A", "20240102", 3.0), ("A", "20240202", 2.0), ("B", "20240302", 2.0)]
    assert store._commit(spec_of("daily"))["number"] == 3


def test_writers_of_one_month_lose_no_row(store, spark, monkeypatch):
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0)]))
    other = Store(spark, store.root)
    _between(store, monkeypatch, lambda: other.save_daily(
        make(spark, "daily", [bar("B", "20240103", 2.0)])))
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 3.0), bar("C", "20240104", 3.0)]))
    assert closes(store) == [("A", "20240102", 3.0), ("B", "20240103", 2.0), ("C", "20240104", 3.0)]


def test_first_writers_of_a_table_lose_no_row(store, spark, monkeypatch):
    other = Store(spark, store.root)
    _between(store, monkeypatch, lambda: other.save_stock_basic(
        make(spark, "stock_basic", [{"ts_code": "A", "name": "a"}])))
    store.save_stock_basic(make(spark, "stock_basic", [{"ts_code": "B", "name": "b"}]))
    assert sorted(rows_of(store.scan("stock_basic").select("ts_code"))) == [("A",), ("B",)]


def test_a_commit_file_is_put_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    done = []
    threads = [threading.Thread(target=lambda k=k: done.append((log.put("_commits/1.json", {"n": k}),
                                                                k))) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [k for ok, k in done if ok]
    assert len(winners) == 1 and log.commit("1.json") == {"n": winners[0]}
    assert log.commits() == ["1.json"]


def test_a_young_folder_of_another_writer_stays(store, spark, monkeypatch):
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0)]))
    make(spark, "daily", [bar("B", "20240102", 1.0)]).write.parquet(
        f"{store.root}/daily/version=00000002-other")
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 2.0)]))
    assert "version=00000002-other" in store._names(f"{store.root}/daily")
    monkeypatch.setattr(commits, "STALE_SECONDS", -1)
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 3.0)]))
    assert "version=00000002-other" not in store._names(f"{store.root}/daily")


# -- columns beyond the catalogue ----------------------------------------------------------------


def test_new_columns_are_kept(store, spark):
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0), bar("B", "20240202", 1.0)]))
    noted = make(spark, "daily", [bar("A", "20240102", 2.0)]).withColumns(
        {"note": F.lit("x"), "odd name": F.lit(7)})
    store.save_daily(noted)
    store.save_daily(make(spark, "daily", [bar("C", "20240102", 3.0)]).withColumn(
        "Note", F.lit(5)))
    columns = [*spec_of("daily").columns, "note", "odd name"]
    assert store.full("daily").columns == columns
    assert store.scan("daily").columns == spec_of("daily").columns
    got = rows_of(store.full("daily").select("ts_code", "close", "note", "`odd name`"))
    assert sorted(got) == [("A", 2.0, "x", 7), ("B", 1.0, None, None), ("C", 3.0, "5", None)]
    # A row replaced without the column loses its value, as any replaced row does.
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 4.0)]))
    assert rows_of(store.full("daily").where("ts_code = 'A'").select("close", "note")) == [
        (4.0, None)]
    assert store.view("daily_view").columns == [*columns, "ym"]
    assert dict(store.full("daily").dtypes)["odd name"] == "int"


# -- free SQL ------------------------------------------------------------------------------------


def files_read(df):
    """Files that each scan of a query reads, most first. For its first run, without AQE."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    counts = []
    for k in range(leaves.size()):
        metric = leaves.apply(k).metrics().get("numFiles")
        if metric.isDefined():
            counts.append(metric.get().value())
    return sorted(counts, reverse=True)


@pytest.fixture
def two_years(store, spark):
    months = [f"{y}{m:02d}" for y in (2023, 2024) for m in range(1, 13)]
    rows = [bar(c, f"{m}{d:02d}", 1.0, amount=float(k)) for m in months for d in (3, 17)
            for k, c in enumerate("ABCD")]
    store.save_daily(make(spark, "daily", [*rows, bar("E", None, 9.0)]))
    store.save_stock_basic(make(spark, "stock_basic", [
        {"ts_code": c, "name": c.lower(), "industry": "i" if c != "D" else None} for c in "ABCD"]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield Market(store)
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("text, expected", [
    (LATEST, [("D", "20241217"), ("C", "20241217"), ("B", "20241217"), ("A", "20241217")]),
    ("SELECT ts_code, trade_date FROM daily_view WHERE trade_date = '20230517' "
     "ORDER BY ts_code DESC", [(c, "20230517") for c in "DCBA"]),
    ("SELECT ts_code, trade_date FROM daily_view WHERE trade_date BETWEEN '20240210' AND "
     "'20240228' ORDER BY ts_code DESC", [(c, "20240217") for c in "DCBA"]),
    ("SELECT ts_code, trade_date FROM daily_view WHERE trade_date LIKE '202302%' AND "
     "ts_code = 'A' ORDER BY 2", [("A", "20230203"), ("A", "20230217")]),
])
def test_free_sql_reads_the_months_of_its_dates(two_years, text, expected):
    df = two_years.raw_sql(text)
    # 24 months and the rows without a date, in 25 files.
    assert files_read(df) == [1, 1]
    assert [(r[0], r[1]) for r in df.collect()] == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.split("PartitionFilters:")[1]


def test_free_sql_join_reads_one_month(two_years):
    df = two_years.raw_sql(LATEST_JOIN)
    # A month, the rows without a date and the master.
    assert files_read(df) == [1, 1, 1]
    assert [r["ts_code"] for r in df.collect()] == ["C", "B", "A"]
    # The latest date comes from the date column alone.
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "max(trade_date" in plan


def test_views_have_undated_rows_too(two_years):
    assert two_years.raw_sql("SELECT count(*) FROM daily_view").first()[0] == 24 * 2 * 4 + 1
    undated = two_years.raw_sql("SELECT ts_code, close, ym FROM daily_view WHERE trade_date IS NULL")
    assert rows_of(undated) == [("E", 9.0, None)]


def test_index_views_are_pruned_by_code_and_date(store, spark):
    rows = [{"index_code": c, "con_code": "X", "trade_date": f"{y}0131", "weight": 1.0}
            for c in store.indices for y in range(2015, 2025)]
    store.upsert(make(spark, "index_weight", rows), "index_weight")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = Market(store).raw_sql(
            "SELECT weight FROM index_weight_view WHERE index_code = '000905.SH' "
            "AND trade_date >= '20230101'")
        assert files_read(df)[0] == 2 and df.count() == 2
        one = Market(store).raw_sql(
            "SELECT trade_date FROM index_weight_hs300_view WHERE trade_date < '2016'")
        assert rows_of(one) == [("20150131",)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# -- what commits tell ---------------------------------------------------------------------------


def _mixed(store, spark):
    store.save_daily(make(spark, "daily", [
        bar("A", "20240102", 1.0), bar("B", "20240102", 1.0), bar("A", "20240203", 1.0),
        bar("C", None, 1.0)]))
    store.save_daily(make(spark, "daily", [bar("A", "20240104", 1.0), bar("C", None, 2.0)]))
    for code in ("000905.SH", "000300.SH"):
        store.save_index_daily(make(spark, "index_daily", [
            {"ts_code": code, "trade_date": d} for d in ("20231229", "20240102", None)]), code)
    store.upsert(make(spark, "index_basic", [
        {"ts_code": "I", "market": m} for m in ("CSI", "SSE", None)]), "index_basic")
    store.save_trade_calendar(make(spark, "trade_calendar", [
        {"exchange": "SSE", "cal_date": d} for d in ("20231231", "20240101", None)]))
    store.save_stock_basic(make(spark, "stock_basic", [{"ts_code": "A"}, {"ts_code": "B"}]))
    store.save_income(make(spark, "income", [
        {"ts_code": c, "end_date": d} for c, d in (("A", "20231231"), ("B", "20230930"))]))


def test_counts_manifest_and_days_equal_those_of_the_rows(store, spark):
    _mixed(store, spark)
    counts = dict(rows_of(record_counts(store)))
    assert counts["daily"] == 5 and counts["moneyflow"] == 0
    got = {r["table"]: tuple(r) for r in manifest(store).collect()}
    for table in got:
        assert counts[table] == store.scan(table).count()
        assert got[table] == tuple(table_manifest(store.scan(table), table).first())
    assert rows_of(store.days("daily", "20240103", "20240203")) == [("20240104",), ("20240203",)]
    found = store.index_days("index_daily", end="20231231")
    assert sorted(rows_of(found)) == [("000300.SH", "20231229"), ("000905.SH", "20231229")]
    assert found.columns == ["ts_code", "trade_date"]
    assert rows_of(Market(store).trading_dates(2)) == [("20240203",), ("20240104",)]


def test_counts_and_gaps_open_no_data_file(store, spark, monkeypatch):
    _mixed(store, spark)

    def forbidden(*_, **__):
        raise AssertionError("rows are read")

    monkeypatch.setattr(Store, "_read", forbidden)
    monkeypatch.setattr(Store, "_stored", forbidden)
    assert record_counts(store).count() == 12 and manifest(store).count() == 12
    assert Market(store).trading_dates(3).count() == 3
    assert store.days("daily").count() == 3 and store.index_days("index_daily").count() == 4


# -- updates of several tables -------------------------------------------------------------------


def _steps(spark, value, broken=False):
    def fails():
        raise OSError("driver lost")

    return {
        "daily": lambda: make(spark, "daily", [bar("A", "20240102", value)]),
        "stock_basic": lambda: make(spark, "stock_basic", [{"ts_code": "A", "name": str(value)}]),
        "adjfactor": fails if broken else lambda: make(spark, "adjfactor", [
            {"ts_code": "A", "trade_date": "20240102", "adj_factor": value}]),
    }


def _seen(store):
    return (rows_of(store.scan("daily").select("close")),
            rows_of(store.scan("stock_basic").select("name")),
            rows_of(store.scan("adjfactor").select("adj_factor")))


def test_an_update_that_breaks_off_is_not_seen(store, spark):
    assert store.snapshot() is store
    apply_update(store, _steps(spark, 1.0))
    old = store.snapshot()
    first = ([(1.0,)], [("1.0",)], [(1.0,)])
    assert _seen(old) == first
    for _ in range(3):  # more commits than are kept otherwise
        with pytest.raises(OSError):
            apply_update(store, _steps(spark, 2.0, broken=True))
    assert _seen(old) == _seen(store.snapshot()) == first
    assert _seen(store) == ([(2.0,)], [("2.0",)], [(1.0,)])
    apply_update(store, _steps(spark, 3.0))
    assert _seen(store.snapshot()) == ([(3.0,)], [("3.0",)], [(3.0,)])
    # A reader that began before the update goes on with what it saw.
    assert _seen(old) == first
    with pytest.raises(TypeError):
        old.save_daily(make(spark, "daily", []))
    for value in (4.0, 5.0):
        apply_update(store, _steps(spark, value))
    # Those of two updates, and the last but one.
    assert len(store._commits(spec_of("daily"))) == 3
    assert dict(rows_of(record_counts(store.snapshot())))["daily"] == 1


# -- clustering and sketches ---------------------------------------------------------------------


def test_one_code_opens_few_files_of_a_clustered_table(store, spark):
    _month_of_files(store, spark, 50)
    rows = closes(store)
    assert len(store.slice("daily", "C0123").inputFiles()) == 50
    size = sum(e["bytes"] for _, e in store.known_files("daily"))
    assert store.cluster("daily", file_bytes=size // 20) == 1
    assert closes(store) == rows
    files = files_of(store)
    assert 15 <= len(files) <= 25
    one = store.slice("daily", "C0123")
    assert len(one.inputFiles()) <= 2
    assert one.count() == sum(r[0] == "C0123" for r in rows)
    assert store.cluster("daily", file_bytes=size // 20) == 0
    # A batch for one code leaves the other files as they are.
    store.save_daily(make(spark, "daily", [bar("C0123", r[1], -1.0) for r in rows
                                           if r[0] == "C0123"]))
    assert len(files - files_of(store)) <= 2
    assert store.cluster("stock_basic") == 0


def test_clustering_beside_a_writer_loses_no_row(store, spark, monkeypatch):
    _month_of_files(store, spark, 6)
    rows = closes(store)
    other = Store(spark, store.root)
    _between(store, monkeypatch, lambda: other.save_daily(
        make(spark, "daily", [bar("NEW", "20240105", 5.0)])))
    assert store.cluster("daily") == 1
    assert closes(store) == sorted([*rows, ("NEW", "20240105", 5.0)], key=str)


def test_sketches_are_within_their_bound(store, spark, monkeypatch):
    rows = spark.range(60_000).selectExpr(
        "concat('C', CAST(id % 20000 AS STRING)) AS ts_code",
        "concat('2024', lpad(CAST(1 + id % 9 AS STRING), 2, '0'), '15') AS trade_date",
        "IF(id % 3 = 0, NULL, CAST(id AS DOUBLE)) AS close",
        "IF(id % 2 = 0, 0.0D, -0.0D) AS open")
    store.save_daily(rows)
    got = {r["column"]: r for r in sketches.profile_sketched(store, "daily").collect()}
    exact = {r["column"]: (r["non_null"], r["distinct_count"]) for r in profile(
        store.scan("daily"), ["ts_code", "trade_date", "close", "open", "high"]).collect()}
    for column in ("ts_code", "trade_date", "close", "high"):
        assert got[column]["non_null"] == exact[column][0]
        assert got[column]["low"] <= exact[column][1] <= got[column]["high"]
    assert got["trade_date"]["distinct_estimate"] == 9 and got["high"]["distinct_estimate"] == 0
    assert got["open"]["distinct_estimate"] == 1
    # Only the month that a later write changes is read again.
    read, partitions = [], Store.partitions

    def noting(self, table, values):
        read.append(sorted(values, key=str))
        return partitions(self, table, values)

    monkeypatch.setattr(Store, "partitions", noting)
    store.save_daily(make(spark, "daily", [bar("X", "20240315", 1.0), bar("Y", None, 1.0)]))
    again = {r["column"]: r for r in sketches.profile_sketched(store, "daily").collect()}
    assert read == [[("202403",), (None,)]]
    assert again["ts_code"]["non_null"] == 60_002
    assert sketches.profile_sketched(store, "daily").count() == 11 and len(read) == 1
