"""Updates of a stored market, in batch and as a stream."""

import pytest
from pyspark.sql import functions as F

from barlake.operators.coverage import missing_dates
from barlake.operators.days import open_days
from barlake.plans import updates
from barlake.plans.market import Market
from barlake.sources.store import Store
from barlake.streaming.bars import STATE, bars, start_bar_stream, with_changes
from barlake.streaming.landing import stream_upsert
from conftest import FrameTables, make, rows_of

CODE = "000300.SH"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "market"))


@pytest.fixture
def landed(spark):
    days = [f"202402{d:02d}" for d in range(1, 21)]
    return FrameTables(
        spark,
        trade_calendar=[{"exchange": "SSE", "cal_date": d, "is_open": int(d[-1] not in "09")}
                        for d in days],
        daily=[{"ts_code": c, "trade_date": d, "close": 1.0} for d in days for c in "AB"],
        adjfactor=[{"ts_code": "A", "trade_date": d, "adj_factor": 1.0} for d in days],
        moneyflow=[{"ts_code": "A", "trade_date": d} for d in days],
        stock_basic=[{"ts_code": "A", "name": "ST A", "list_status": "L"},
                     {"ts_code": "B", "list_status": "D"}],
        st_stocks=[{"ts_code": "A", "st_type": "ST"}],
        index_basic=[{"ts_code": "1", "market": "CSI"}, {"ts_code": "2", "market": "MSCI"}],
        income=[{"ts_code": "A", "end_date": e} for e in ("20230930", "20231231", "20240331")],
        cashflow=[{"ts_code": "A", "end_date": "20231231"}],
        balancesheet=[{"ts_code": "A", "end_date": "20230630"}],
        index_weight=[{"index_code": CODE, "con_code": c, "trade_date": d, "weight": 1.0}
                      for d in ("20231130", "20240115", "20240215") for c in "AB"],
        index_daily=[{"ts_code": CODE, "trade_date": d, "close": 1.0} for d in days],
    )


def test_incremental_update_fills_the_gaps_and_is_idempotent(spark, store, landed):
    store.save_trade_calendar(landed.scan("trade_calendar"))
    store.save_daily(landed.on_dates("daily", "20240201", "20240202"))
    rows = updates.incremental_steps(landed, store, "20240220", 1)
    summary = dict(rows_of(updates.update_summary(rows)))
    open_count = 16
    assert summary == {
        "trade_calendar": 20, "stock_basic": 1, "st_stocks": 1, "index_basic": 1,
        "daily": 2 * (open_count - 2), "adjfactor": open_count, "moneyflow": open_count,
        "income": 2, "cashflow": 1, "balancesheet": 0, "index_weight": 2, "index_daily": 20,
    }
    assert updates.apply_update(store, rows) == summary
    again = updates.incremental_steps(landed, store, "20240220", 1)
    left = dict(rows_of(updates.update_summary(again)))
    assert {t: n for t, n in left.items() if t in ("daily", "adjfactor", "moneyflow", "index_weight",
                                                   "index_daily")} == dict.fromkeys(
        ("daily", "adjfactor", "moneyflow", "index_weight", "index_daily"), 0)
    assert missing_dates(open_days(store.scan("trade_calendar")), store.scan("daily")).count() == 0
    assert Market(store).record_counts().where("table = 'daily'").first()["row_count"] == 32


def test_days_replace_the_months(spark, store, landed):
    store.save_trade_calendar(landed.scan("trade_calendar"))
    rows = updates.incremental_steps(landed, store, "20240220", days=3)
    got = sorted({r["trade_date"] for r in rows["daily"]().collect()})
    assert got == ["20240216", "20240217", "20240218"]


def test_full_update(spark, store, landed):
    store.save_trade_calendar(landed.scan("trade_calendar"))
    store.save_index_weight(landed.on_dates("index_weight", "20231130"), CODE)
    indices = spark.createDataFrame([(CODE,)], "index_code string")
    rows = updates.full_steps(landed, store, "20240220", indices, years=1)
    summary = updates.apply_update(store, rows)
    assert summary["income"] == 2 and summary["balancesheet"] == 1 and summary["daily"] == 32
    # November 2023 is stored, the other months are not.
    assert summary["index_weight"] == 4 and store.scan("index_weight").count() == 6


def test_a_statement_step_asks_its_source_for_two_quarters(store, landed, monkeypatch):
    asked, scan = [], FrameTables.scan

    def noting(self, table, code=None, start=None, end=None, dates=None):
        asked.append((table, start, end))
        return scan(self, table, code, start, end, dates)

    monkeypatch.setattr(FrameTables, "scan", noting)
    step = updates.incremental_steps(landed, store, "20240220", 1)["income"]
    ends = sorted(r["end_date"] for r in step().collect())
    assert ends == ["20231231", "20240331"]
    assert asked == [("income", "20231231", "20240331")]


def test_incremental_steps_prune_both_sides(spark, tmp_path, landed):
    stores = [Store(spark, str(tmp_path / name), landed.indices) for name in ("landed", "stored")]
    for store in stores:
        for table in ("trade_calendar", "daily", "adjfactor", "moneyflow", "index_weight",
                      "index_daily", *updates.STATEMENTS):
            store.upsert(landed.scan(table), table)
    steps = updates.incremental_steps(*stores, "20240220", 1)
    for table in ("trade_calendar", "daily", "moneyflow", "index_weight", "index_daily"):
        plan = steps[table]()._jdf.queryExecution().executedPlan().toString()
        scans = plan.count("PartitionFilters: [")
        assert scans and plan.count("PartitionFilters: []") == 0, (table, plan)


def test_date_questions_read_the_newest_partitions(spark, store):
    days = [f"2023{m:02d}15" for m in range(1, 13)]
    rows = [{"ts_code": "A" if d < "20230601" else "B", "trade_date": d} for d in days]
    store.save_daily(make(spark, "daily", rows + [{"ts_code": "C"}]))
    m = Market(store)
    assert rows_of(m.trading_dates(2)) == [("20231215",), ("20231115",)]
    assert "PartitionFilters: []" not in m.trading_dates(2)._jdf.queryExecution() \
        .executedPlan().toString()
    assert m.trading_dates(100).where("trade_date IS NOT NULL").count() == 12
    assert m.get_daily_latest("A").first()["trade_date"] == "20230515"
    assert m.get_daily_latest("B").first()["trade_date"] == "20231215"
    assert m.get_daily_latest("C").count() == 1 and m.get_daily_latest("D").count() == 0
    assert {r["ym"] for r in m.stored_months().collect()} == {d[:6] for d in days} | {None}


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_landed_batches_stream_into_the_table(spark, store, tmp_path, fmt):
    landing = str(tmp_path / "landing")

    def land(columns, *rows):
        schema = ", ".join(f"{c} {'double' if c == 'close' else 'string'}" for c in columns.split())
        writer = spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append")
        writer.option("header", True).format(fmt).save(landing)

    def run():
        return sorted(rows_of(stream_upsert(store, "daily", landing, str(tmp_path / "checkpoint"),
                                            fmt=fmt).select("ts_code", "trade_date", "close")))

    land("ts_code trade_date close", ("A", "20240102", 1.0), ("B", "20240102", None))
    assert run() == [("A", "20240102", 1.0), ("B", "20240102", None)]
    # Another column order, and a column less.
    land("trade_date ts_code close", ("20240102", "B", 5.0), ("20231201", "A", 7.5))
    land("trade_date ts_code", ("20240103", "C"))
    late = run()
    assert late == [("A", "20231201", 7.5), ("A", "20240102", 1.0), ("B", "20240102", 5.0),
                    ("C", "20240103", None)]
    assert run() == late


def _ticks(spark, days, hours):
    rows = [(c, f"2024-01-0{d} 1{h}:00:00", d * 10 + h, float(d * 7 % 5 + h), 100 * h)
            for c in "AB" for d in days for h in hours]
    schema = "code string, ts string, seq long, price double, cents long"
    return spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts"))


def test_bar_stream_equals_batch(spark, store, tmp_path):
    landing = str(tmp_path / "ticks")
    frame = _ticks(spark, range(1, 8), range(5))
    # The newest files come first, days are split over files, and a day in the middle comes last.
    late = "day(ts) = 3"
    parts = [f"seq % 2 = 0 AND day(ts) > 4 AND NOT {late}", f"day(ts) <= 4 AND NOT {late}",
             f"seq % 2 = 1 AND day(ts) > 4 AND NOT {late}", late]

    def run():
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1)
        start_bar_stream(stream.parquet(landing), store,
                         str(tmp_path / "checkpoint")).awaitTermination()

    for part in parts:
        frame.where(part).coalesce(1).write.mode("append").parquet(landing)
        run()
    expected = with_changes(bars(frame)).orderBy("ts_code", "trade_date")
    assert rows_of(store.scan("daily").orderBy("ts_code", "trade_date")) == rows_of(expected)


def test_bar_stream_repeats_a_batch_without_adding_twice(spark, store, tmp_path, monkeypatch):
    landing, checkpoint = str(tmp_path / "ticks"), str(tmp_path / "checkpoint")
    frame = _ticks(spark, (1, 2), range(3))
    frame.coalesce(1).write.parquet(landing)
    upsert = Store.upsert

    def breaks(self, df, table, **kw):
        if table == "daily":
            raise OSError("driver lost")
        return upsert(self, df, table, **kw)

    def run():
        stream = spark.readStream.schema(frame.schema).parquet(landing)
        start_bar_stream(stream, store, checkpoint).awaitTermination()

    with monkeypatch.context() as m:
        m.setattr(Store, "upsert", breaks)
        with pytest.raises(Exception, match="driver lost"):
            run()
    assert store.scan("daily").count() == 0 and store.token(STATE)
    run()
    expected = with_changes(bars(frame)).orderBy("ts_code", "trade_date")
    assert rows_of(store.scan("daily").orderBy("ts_code", "trade_date")) == rows_of(expected)


def test_bar_stream_goes_on_from_saved_bars(spark, store, tmp_path):
    def bar(code, day, close, pre=None):
        return {"ts_code": code, "trade_date": day, "open": 1.0, "close": close, "pre_close": pre,
                "vol": 3.0}

    # A has bars before, on and after the streamed day, far apart; B has one of the same day only.
    saved = [bar("A", "20210301", 1.0), bar("A", "20230901", 4.0, 1.0), bar("A", "20240102", 7.0),
             bar("A", "20240301", 5.0, 7.0), bar("A", "20240302", 6.0, 5.0),
             bar("B", "20240102", 9.0, 20.0), bar("C", "20231229", 2.0)]
    store.save_daily(make(spark, "daily", saved))
    for month in range(1, 7):
        store.save_daily(make(spark, "daily", [bar("D", f"20230{month}01", 1.0)]))
    landing = str(tmp_path / "ticks")
    _ticks(spark, (2,), range(3)).coalesce(1).write.parquet(landing)
    stream = spark.readStream.schema(_ticks(spark, (2,), (0,)).schema).parquet(landing)
    start_bar_stream(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    got = {(r["ts_code"], r["trade_date"]): (r["close"], r["pre_close"], r["change"], r["vol"])
           for r in store.scan("daily").where("ts_code <> 'D'").collect()}
    assert got == {
        ("A", "20210301"): (1.0, None, None, 3.0), ("A", "20230901"): (4.0, 1.0, None, 3.0),
        ("A", "20240102"): (6.0, 4.0, 2.0, 3.0), ("A", "20240301"): (5.0, 6.0, -1.0, 3.0),
        ("A", "20240302"): (6.0, 5.0, None, 3.0), ("B", "20240102"): (6.0, 20.0, -14.0, 3.0),
        ("C", "20231229"): (2.0, None, None, 3.0)}


def _late_ticks(spark, rows):
    schema = "code string, ts string, seq long, price double, cents long"
    return spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts"))


@pytest.fixture
def scanned(monkeypatch):
    """The months that scans of ``daily`` ask for; None for all."""
    asked, scan = [], Store.scan

    def noting(self, table, code=None, start=None, end=None, dates=None):
        if table == "daily":
            asked.append(None if dates is None else {d[:6] for d in dates})
        return scan(self, table, code, start, end, dates)

    monkeypatch.setattr(Store, "scan", noting)
    return asked


def test_bar_stream_reads_other_months_for_late_ticks_only(spark, store, tmp_path, scanned):
    months = [f"{y}{m:02d}" for y in range(2020, 2024) for m in range(1, 13)]
    store.save_daily(make(spark, "daily", [
        {"ts_code": "A", "trade_date": f"{m}15", "close": float(k)} for k, m in enumerate(months)]
        + [{"ts_code": "OLD", "trade_date": "20200203", "close": 5.0}]))
    landing, checkpoint = str(tmp_path / "ticks"), str(tmp_path / "checkpoint")

    def take(*rows):
        scanned.clear()
        frame = _late_ticks(spark, [(*r, 100) for r in rows])
        frame.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(frame.schema).parquet(landing)
        start_bar_stream(stream, store, checkpoint).awaitTermination()
        return set().union(*[s or set(months) for s in scanned])

    def closes(code):
        return [(r["trade_date"], r["close"], r["pre_close"]) for r in store.scan("daily").where(
            f"ts_code = '{code}'").orderBy("trade_date").collect()]

    # The first micro-batch learns the codes from all that is stored.
    assert take(("A", "2024-01-02 10:00:00", 1, 50.0)) == {*months, "202401"}
    # A new code, and days after the last: their own month only.
    assert take(("NEW", "2024-01-03 10:00:00", 2, 7.0), ("A", "2024-01-03 10:00:00", 3, 51.0)) \
        == {"202401"}
    assert closes("NEW") == [("20240103", 7.0, None)]
    assert closes("A")[-2:] == [("20240102", 50.0, 47.0), ("20240103", 51.0, 50.0)]
    # Years after its last bar, which is known.
    assert take(("OLD", "2024-02-01 10:00:00", 4, 6.0)) == {"202402"}
    assert closes("OLD") == [("20200203", 5.0, None), ("20240201", 6.0, 5.0)]
    # A late day: back and ahead to its neighbours.
    read = take(("OLD", "2021-07-01 10:00:00", 5, 8.0), ("A", "2024-02-05 10:00:00", 6, 52.0))
    assert "202107" in read and "202002" in read and "202402" in read
    assert closes("OLD") == [("20200203", 5.0, None), ("20210701", 8.0, 5.0),
                             ("20240201", 6.0, 8.0)]
    # Before the first day of a code there is nothing to look for.
    read = take(("NEW", "2023-11-01 10:00:00", 7, 4.0))
    assert read <= {"202311", "202312", "202401"}
    assert closes("NEW") == [("20231101", 4.0, None), ("20240103", 7.0, 4.0)]
    # Bars saved by others between micro-batches count.
    store.save_daily(make(spark, "daily", [{"ts_code": "NEW", "trade_date": "20240110",
                                            "close": 9.0}]))
    assert take(("NEW", "2024-03-01 10:00:00", 8, 10.0)) == {"202401", "202403"}
    assert closes("NEW")[-1] == ("20240301", 10.0, 9.0)


def test_bar_stream_in_any_order_equals_batch(spark, store, tmp_path):
    import random

    rng = random.Random(11)
    days = [f"20{20 + k // 12}-{1 + k % 12:02d}-{1 + k % 27:02d}" for k in range(24)]
    rows = [(c, f"{rng.choice(days)} 1{rng.randrange(9)}:00:00", k, float(rng.randrange(1, 90)), k)
            for k, c in enumerate("ABCD" * 30)]
    frame = _late_ticks(spark, rows)
    landing = str(tmp_path / "ticks")
    for part in range(3):
        frame.where(f"seq % 3 = {part}").coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(frame.schema).parquet(landing)
        start_bar_stream(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    expected = with_changes(bars(frame)).orderBy("ts_code", "trade_date")
    assert rows_of(store.scan("daily").orderBy("ts_code", "trade_date")) == rows_of(expected)
