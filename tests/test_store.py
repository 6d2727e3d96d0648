import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake.catalog import CATALOG, spec_of
from barlake.operators.merge import merge_keep_last
from barlake.sources.store import Store
from conftest import make, rows_of


def bar(code, date, close, **kw):
    return {"ts_code": code, "trade_date": date, "close": close, **kw}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "market"))


def closes(store):
    return sorted(
        rows_of(store.scan("daily").select("ts_code", "trade_date", "close")),
        key=lambda r: tuple(str(v) for v in r),
    )


def test_nothing_stored_reads_as_empty_table(store):
    for name in CATALOG:
        df = store.scan(name)
        assert df.count() == 0 and df.schema == spec_of(name).schema


def test_incoming_replaces_stored_row_as_a_whole(store, spark):
    assert store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0, vol=5.0)])) == 1
    assert store.save_daily(make(spark, "daily", [bar("A", "20240102", 2.0)])) == 1
    row = store.scan("daily").first()
    assert (row["close"], row["vol"]) == (2.0, None)


def test_first_write_is_deduplicated_and_counts_incoming_rows(store, spark):
    batch = make(spark, "daily", [bar("A", "20240102", 1.0), bar("A", "20240102", 3.0)])
    assert store.save_daily(batch) == 2
    assert closes(store) == [("A", "20240102", 3.0)]


def test_newest_statement_revision_wins(store, spark):
    rows = [
        {"ts_code": "A", "end_date": "20231231", "f_ann_date": d, "ann_date": "20240101",
         "total_revenue": v}
        for d, v in (("20240301", 9.0), ("20240401", 1.0), ("20240215", 5.0))
    ]
    store.save_income(make(spark, "income", rows))
    assert rows_of(store.scan("income").select("f_ann_date", "total_revenue")) == [("20240401", 1.0)]


def test_untouched_partitions_stay(store, spark):
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0), bar("A", "20240202", 2.0)]))
    before = {f for f in _files(store, "daily") if "ym=202402" in f}
    store.save_daily(make(spark, "daily", [bar("B", "20240103", 3.0)]))
    assert before == {f for f in _files(store, "daily") if "ym=202402" in f}
    assert closes(store) == [
        ("A", "20240102", 1.0), ("A", "20240202", 2.0), ("B", "20240103", 3.0)]


def _files(store, table):
    return store._stored(spec_of(table)).inputFiles()


def test_null_key_parts_are_equal(store, spark):
    store.save_daily(make(spark, "daily", [bar(None, "20240102", 1.0), bar("A", None, 4.0)]))
    store.save_daily(make(spark, "daily", [bar(None, "20240102", 2.0), bar("A", None, 5.0)]))
    assert closes(store) == [("A", None, 5.0), (None, "20240102", 2.0)]


def test_empty_batch_and_missing_date_column_change_nothing(store, spark):
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0)]))
    assert store.save_daily(make(spark, "daily", [])) == 0
    assert store.save_daily(spark.createDataFrame([("A",)], "ts_code string")) == 0
    assert store.save_stock_basic(make(spark, "stock_basic", [])) == 0
    assert closes(store) == [("A", "20240102", 1.0)]


def test_missing_columns_are_filled_and_extra_ones_dropped(store, spark):
    df = spark.createDataFrame([("A", "20240102", 7, "x")],
                               "ts_code string, trade_date string, close int, note string")
    store.save_daily(df)
    assert store.scan("daily").columns == spec_of("daily").columns
    assert closes(store) == [("A", "20240102", 7.0)]


def test_one_code_in_two_markets_stays_twice(store, spark):
    row = make(spark, "index_basic", [{"ts_code": "I1", "name": "x"}])
    store.save_index_basic(row, "CSI")
    store.save_index_basic(row, "SSE")
    store.save_index_basic(row.withColumn("name", F.lit("y")), "SSE")
    got = sorted(rows_of(store.read_index_basic().select("ts_code", "market", "name")))
    assert got == [("I1", "CSI", "x"), ("I1", "SSE", "y")]


def test_unpartitioned_table_is_versioned(store, spark):
    for i in range(4):
        store.save_stock_basic(make(spark, "stock_basic", [{"ts_code": "A", "name": f"n{i}"},
                                                           {"ts_code": f"B{i}"}]))
    assert sorted(rows_of(store.scan("stock_basic").select("ts_code", "name"))) == [
        ("A", "n3"), ("B0", None), ("B1", None), ("B2", None), ("B3", None)]
    assert store._commits(spec_of("stock_basic")) == ["00000003.json", "00000004.json"]
    assert len(store._names(f"{store.root}/stock_basic")) == 2


def test_index_tables_hold_tracked_indices_only(store, spark):
    rows = make(spark, "index_weight", [
        {"index_code": "000300.SH", "con_code": "A", "trade_date": "20240131", "weight": 1.0},
        {"index_code": "XXX", "con_code": "A", "trade_date": "20240131", "weight": 1.0},
    ])
    assert store.save_index_weight(rows, "XXX") == 0
    assert store.save_index_weight(rows, "000300.SH") == 1
    assert store.index_view("index_weight", "hs300").count() == 1
    assert store.index_view("index_weight", "zz500").count() == 0
    assert store.index_union("index_weight").count() == 1


def test_date_filters_prune_partitions(store, spark):
    months = [f"2024{m:02d}15" for m in range(1, 7)]
    store.save_daily(make(spark, "daily", [bar("A", d, 1.0) for d in months]))
    df = store.slice("daily", "A", "20240201", "20240331")
    assert rows_of(df.select("trade_date").orderBy("trade_date")) == [("20240215",), ("20240315",)]
    assert len(df.inputFiles()) == 6  # the listing; the plan prunes below
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "ym#" in plan
    on = store.on_dates("daily", "20240115", "20240615")
    assert "PartitionFilters: [ym#" in on._jdf.queryExecution().executedPlan().toString()
    assert on.count() == 2


def test_hot_partition_is_written_as_several_files(store, spark):
    rows = spark.range(200_000).selectExpr(
        "CAST(id AS STRING) AS ts_code",
        "CASE WHEN id % 3 = 0 THEN '20240102' ELSE date_format(date_add(DATE'2023-01-01', "
        "CAST(id % 300 AS INT)), 'yyyyMMdd') END AS trade_date",
        "rand(7) AS close", "rand(8) AS open",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        assert store.save_daily(rows) == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = _files(store, "daily")
    assert sum("ym=202401" in f for f in files) > 3
    assert store.scan("daily").count() == 200_000


def test_partition_values_stay_text(store, spark):
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0)]))
    assert dict(store._stored(spec_of("daily")).dtypes)["ym"] == "string"


def test_every_table_round_trips(store, spark):
    for name, spec in CATALOG.items():
        row = {c: "20240131" for c in spec.columns if dict(_types(spec))[c] == "string"}
        row |= {c: 1 if t == "int" else 1.5 for c, t in _types(spec) if t != "string"}
        if name in ("index_weight", "index_daily"):
            row[spec.code_col] = "000905.SH"
        df = make(spark, name, [row])
        assert store.upsert(df, name) == 1
        assert rows_of(store.read(name)) == rows_of(df)


def _types(spec):
    return [(f.name, f.dataType.simpleString()) for f in spec.schema.fields]


_ROWS = st.lists(
    st.tuples(st.sampled_from("ABC") | st.none(), st.integers(1, 3), st.integers(0, 99)),
    max_size=12,
)


@settings(max_examples=10, deadline=None)
@given(_ROWS, _ROWS)
def test_merge_against_brute_force(spark, stored, incoming):
    schema = "k string, n int, v int"
    a, b = spark.createDataFrame(stored, schema), spark.createDataFrame(incoming, schema)
    expected = {}
    for batch in (sorted(stored, key=lambda r: r[2]), sorted(incoming, key=lambda r: r[2])):
        for k, n, v in batch:
            expected[k, n] = v
    once = merge_keep_last(a, b, ["k", "n"], ["v"])
    got = {(r["k"], r["n"]): r["v"] for r in once.collect()}
    assert got == expected and once.count() == len(expected)
    twice = merge_keep_last(once, b, ["k", "n"], ["v"], stored_is_unique=True)
    assert sorted(map(str, rows_of(twice))) == sorted(map(str, rows_of(once)))


def _partition_columns(spec):
    return {*spec.key, *spec.partitions} - set(spec.derived)


@pytest.mark.parametrize("table", [t for t, s in CATALOG.items() if s.partitions])
@pytest.mark.parametrize("first", [None, ""])
@pytest.mark.parametrize("second", [None, ""])
def test_null_and_empty_values_meet_without_loss(spark, tmp_path, table, first, second):
    spec = spec_of(table)
    store = Store(spark, str(tmp_path / "s"), {"I": "i"})
    column = spec.date_col or "market"
    code = "ts_code" if table == "index_basic" else [k for k in spec.key if k != column][-1]
    fixed = {"index_code": "I"} if table == "index_weight" else {}

    def rows(*values):
        out = []
        for name, value in values:
            row = {code: name, column: value, **fixed}
            if table == "index_daily":
                row = {"ts_code": "I", column: value}
            out.append(row)
        return make(spark, table, out)

    store.upsert(rows(("A", first), ("B", "20240102")), table)
    store.upsert(rows(("Z", second)), table)
    got = {(r[code], r[column]) for r in store.scan(table).collect()}
    expected = {("A", None), ("Z", None), ("B", "20240102")}
    if table == "index_daily":
        expected = {("I", None), ("I", "20240102")}
    assert got == expected


def test_reserved_partition_name_is_rejected(store, spark):
    row = make(spark, "index_basic", [{"ts_code": "A", "market": "__HIVE_DEFAULT_PARTITION__"}])
    with pytest.raises(Exception, match="is no value of market"):
        store.upsert(row, "index_basic")
    assert store.scan("index_basic").count() == 0


def test_broken_write_changes_nothing_and_can_be_rerun(store, spark, monkeypatch):
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0), bar("A", "20240202", 2.0)]))
    batch = make(spark, "daily", [bar("A", "20240102", 9.0), bar("B", "20240303", 3.0)])

    def fails(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", fails)
        with pytest.raises(OSError):
            store.save_daily(batch)
    assert closes(store) == [("A", "20240102", 1.0), ("A", "20240202", 2.0)]
    assert store.save_daily(batch) == 2
    assert closes(store) == [
        ("A", "20240102", 9.0), ("A", "20240202", 2.0), ("B", "20240303", 3.0)]
    # The folder of the broken write is dropped by a later one.
    assert len(store._names(f"{store.root}/daily")) == 2


def test_second_writer_of_a_commit_fails(store, spark):
    spec = spec_of("daily")
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0)]))
    before = store._commit(spec)
    rows = make(spark, "daily", [bar("B", "20240102", 1.0)])
    store._write(rows, spec, before, None)
    with pytest.raises(RuntimeError, match="another writer"):
        store._write(rows, spec, before, None)
    assert closes(store) == [("B", "20240102", 1.0)]


def test_views_keep_the_partition_columns(store, spark):
    store.save_daily(make(spark, "daily", [bar("A", "20240102", 1.0), bar("A", "20240202", 2.0)]))
    assert store.view("daily_view").columns == [*spec_of("daily").columns, "ym"]
    assert store.view("adjfactor_view").columns == [*spec_of("adjfactor").columns, "ym"]
    assert store.partition_values("daily", "ym") == ["202401", "202402"]
    assert store.partition_values("daily", "year") is None


def test_rows_of_other_indices_are_left_out(store, spark):
    rows = make(spark, "index_daily", [{"ts_code": c, "trade_date": "20240102"}
                                       for c in ("000300.SH", "000905.SH")])
    assert store.save_index_daily(rows, "000905.SH") == 1
    assert rows_of(store.scan("index_daily").select("ts_code")) == [("000905.SH",)]
