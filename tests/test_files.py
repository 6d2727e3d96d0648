import glob
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake.operators.export import (
    export, export_slice, export_table, plain_number, save_result, write_csv,
)
from barlake.sources.landing import (
    file_encodings, income_of_code, ingest, landed_slice, normalise, read_csv, read_csv_any_encoding,
    read_landed,
)
from conftest import FrameTables, make, rows_of


def put(folder, name, text, encoding):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))


def test_csv_is_all_text_and_skips_the_mark(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "code,n\n007,1\n008,\n", "utf-8-sig")
    put(tmp_path / "in", "b.csv", "code,n\n009,3\n", "utf-8")
    df = read_csv(spark, str(tmp_path / "in"))
    assert dict(df.dtypes) == {"code": "string", "n": "string"}
    assert sorted(rows_of(df)) == [("007", "1"), ("008", None), ("009", "3")]


def test_csv_of_mixed_encodings(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "gbk.csv", "code,name\n1,平安银行\n2,中\n", "gbk")
    put(folder, "bom.csv", "code,name\n3,平安\n", "utf-8-sig")
    put(folder, "plain.csv", "code,name\n4,ascii\n", "ascii")
    put(folder, "latin.csv", "code,name\n5,caf\xe9\n6,\xff\xfe\n", "latin-1")
    kinds = {r["file"].rsplit("/", 1)[1]: r["encoding"]
             for r in file_encodings(spark, str(folder)).collect()}
    assert kinds == {"gbk.csv": "GBK", "bom.csv": "UTF-8", "plain.csv": "UTF-8",
                     "latin.csv": "ISO-8859-1"}
    got = sorted(rows_of(read_csv_any_encoding(spark, str(folder))))
    assert got == [("1", "平安银行"), ("2", "中"), ("3", "平安"), ("4", "ascii"),
                   ("5", "caf\xe9"), ("6", "\xff\xfe")]


def test_the_lines_of_a_file_are_not_sorted_to_find_its_header(spark, tmp_path, capsys):
    put(tmp_path / "in", "a.csv", "code,n\n" + "".join(f"{i},{i}\n" for i in range(2000)), "utf-8")
    put(tmp_path / "in", "b.csv", "n,code\n3,009\n", "utf-8")
    files = file_encodings(spark, str(tmp_path / "in"), ("UTF-8",))
    files.explain()
    assert "SortAggregate" not in capsys.readouterr().out
    assert sorted((bytes(r["header"]), r["size"], r["clean"]) for r in files.collect()) == [
        (b"code,n", (tmp_path / "in" / "a.csv").stat().st_size, True),
        (b"n,code", (tmp_path / "in" / "b.csv").stat().st_size, True)]


def test_files_with_other_columns_unite_by_name(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "code,name\n1,平安银行\n", "gbk")
    put(tmp_path / "in", "b.csv", "code,extra\n2,x\n", "utf-8")
    df = read_csv_any_encoding(spark, str(tmp_path / "in"))
    assert sorted(rows_of(df.select("code", "name", "extra"))) == [("1", "平安银行", None), ("2", None, "x")]


def test_normalise(spark):
    raw = spark.createDataFrame(
        [("I", "nan", "20240131", "1.5", "e"), ("", "B", "None", "x", "f"),
         ("<NA>", "C", "20240131", "nan", "g")],
        "index_code string, con_code string, trade_date string, weight string, extra string")
    assert rows_of(normalise(raw, "index_weight")) == [
        ("I", None, "20240131", 1.5), (None, "B", None, None), (None, "C", "20240131", None)]
    assert normalise(raw, "index_weight", allow_extra=True).columns[-1] == "extra"
    calendar = spark.createDataFrame([("SSE", "1.0"), ("SSE", "y")], "exchange string, is_open string")
    assert [r["is_open"] for r in normalise(calendar, "trade_calendar").collect()] == [1, None]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_ingest_of_landed_files(spark, tmp_path, fmt):
    rows = spark.createDataFrame(
        [("A", "20240102", "1.5"), ("A", "20080102", "2"), ("B", "20240103", "nan")],
        "ts_code string, trade_date string, close string")
    path = str(tmp_path / "landed")
    if fmt == "parquet":
        rows = rows.withColumn("close", F.col("close").cast("double"))
    rows.write.format(fmt).option("header", True).save(path)
    got = ingest(spark, "daily", path, fmt, "20240201")
    assert sorted(rows_of(got.select("ts_code", "trade_date", "close")), key=str) == [
        ("A", "20240102", 1.5), ("B", "20240103", None)]
    assert ingest(spark, "daily", path, fmt, "20240201", code="A", start="20080101").count() == 2


def test_slices_follow_their_calls(spark):
    st = make(spark, "stock_basic", [
        {"ts_code": "A", "name": "ST A", "list_status": "L", "exchange": "SSE"},
        {"ts_code": "B", "name": "ST B", "list_status": "D", "exchange": "SSE"}])
    assert landed_slice(st, "stock_basic", "20240201", exchange="SZSE").count() == 0
    assert rows_of(landed_slice(st, "st_stocks", "20240201").select("ts_code")) == [("A",)]
    income = make(spark, "income", [{"ts_code": "A", "end_date": "20240331"},
                                    {"ts_code": "A", "end_date": "20231231"}])
    assert landed_slice(income, "income", "20240201").first()["end_date"] == "20240331"
    with pytest.raises(ValueError):
        income_of_code(income, "20240201", "")
    with pytest.raises(ValueError):
        landed_slice(make(spark, "index_weight", []), "index_weight", "20240201")


def test_export_round_trips(spark, tmp_path):
    df = make(spark, "daily", [
        {"ts_code": "平", "trade_date": "20240102", "close": 2441641000.0, "vol": None,
         "amount": 0.1, "open": 1.25e-7, "high": -3.0},
        {"ts_code": 'q"u,o', "trade_date": "20240103", "close": 1e22}])
    expected = sorted(rows_of(df), key=str)
    for fmt in ("csv", "parquet", "json"):
        path = str(tmp_path / fmt)
        assert export(df, path, fmt)
        back = spark.read.schema(df.schema).json(path) if fmt == "json" else (
            normalise(read_csv(spark, path), "daily") if fmt == "csv" else spark.read.parquet(path))
        assert sorted(rows_of(back), key=str) == expected
    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{tmp_path}/csv/*.csv"))
    assert "2441641000.0" in text and "E9" not in text
    lines = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{tmp_path}/json/*.json"))
    assert all("vol" in json.loads(line) for line in lines.splitlines())


def test_empty_export_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    assert not export(make(spark, "daily", []), path, "csv") and not glob.glob(path)
    with pytest.raises(ValueError):
        export(make(spark, "daily", []), path, "xlsx")


def test_save_result_by_suffix(spark, tmp_path):
    df = make(spark, "adjfactor", [{"ts_code": "A", "trade_date": "20240102", "adj_factor": 1.5}])
    save_result(df, str(tmp_path / "x.parquet"))
    assert spark.read.parquet(str(tmp_path / "x.parquet")).count() == 1
    save_result(df, str(tmp_path / "x.txt"))
    write_csv(df, str(tmp_path / "deep" / "er" / "y"))
    assert read_csv(spark, str(tmp_path / "x.txt")).count() == 1


def test_export_slices(spark, tmp_path):
    tables = FrameTables(
        spark,
        moneyflow=[{"ts_code": "A", "trade_date": "20240102"}, {"ts_code": "A", "trade_date": "20240103"}],
        index_basic=[{"ts_code": "1", "market": "CSI"}, {"ts_code": "2", "market": "SSE"}],
        daily=[{"ts_code": "A", "trade_date": "20240102"}, {"ts_code": "B", "trade_date": "20240103"}],
        stock_basic=[{"ts_code": "A"}, {"ts_code": "B"}],
        index_weight=[{"index_code": "000300.SH", "con_code": "A", "trade_date": "20240102"}],
    )
    assert export_slice(tables, "moneyflow", period="20240103").count() == 1
    with pytest.raises(ValueError):
        export_slice(tables, "moneyflow", start="20240101")
    with pytest.raises(ValueError):
        export_slice(tables, "nothing")
    assert export_slice(tables, "index_basic", "CSI").count() == 1
    assert export_slice(tables, "index_basic", "other").count() == 2
    assert export_slice(tables, "daily", start="20240103").count() == 1
    assert export_slice(tables, "stock_basic", "A").count() == 1
    assert export_slice(tables, "index_weight", "000300.SH").count() == 1
    assert export_table(tables, "daily", str(tmp_path / "d"), "parquet", code="A")


def test_parquet_files_of_other_types_for_a_null_column(spark, tmp_path):
    path = str(tmp_path / "landed")
    for text in ("CAST(NULL AS INT)", "1.5D", "CAST('NaN' AS DOUBLE)"):
        df = spark.sql(f"SELECT 'A' AS ts_code, '20240102' AS trade_date, {text} AS close")
        df.write.mode("append").parquet(path)
    got = ingest(spark, "daily", path, "parquet", "20240201")
    assert sorted(rows_of(got.select("close")), key=str) == [(1.5,), (None,), (None,)]


def test_line_breaks_inside_quotes(spark, tmp_path):
    put(tmp_path / "in", "a.csv", 'code,name\n1,"two\nlines"\n', "utf-8")
    assert rows_of(read_csv(spark, str(tmp_path / "in"))) == [("1", "two\nlines")]


def test_columns_are_matched_by_header_name(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "code,name\n1,x\n", "utf-8")
    put(tmp_path / "in", "b.csv", "name,code\ny,2\n", "utf-8")
    put(tmp_path / "in", "c.csv", 'name,"more, or less"\nz,3\n', "utf-8")
    df = read_csv(spark, str(tmp_path / "in")).select("code", "name", "more, or less")
    assert sorted(rows_of(df), key=str) == [("1", "x", None), ("2", "y", None), (None, "z", "3")]


def test_paths_with_spaces_and_pattern_characters(spark, tmp_path):
    folder = tmp_path / "in 1"
    put(folder, "a b%20[x].csv", "code,name\n1,平安\n", "gbk")
    put(folder, "plain.csv", "code,name\n2,y\n", "utf-8")
    assert sorted(rows_of(read_csv_any_encoding(spark, str(folder)))) == [("1", "平安"), ("2", "y")]


def test_encodings_are_an_argument(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "code,name\n1,caf\xe9\n", "latin-1")
    path = str(tmp_path / "in")
    assert rows_of(read_csv_any_encoding(spark, path, ("UTF-8", "ISO-8859-1"))) == [("1", "caf\xe9")]
    with pytest.raises(ValueError, match="no known encoding"):
        read_csv_any_encoding(spark, path, ("UTF-8",))


def test_text_with_line_breaks_and_quotes_round_trips(spark, tmp_path):
    names = ["two\nlines", 'a "quoted, one"', "back\\slash", "\ttab ", "cr\r\nlf", "平\n安"]
    df = make(spark, "stock_basic", [{"ts_code": str(i), "name": n} for i, n in enumerate(names)])
    path = str(tmp_path / "out")
    assert export(df, path, "csv")
    back = read_landed(spark, path, "csv", "stock_basic")
    assert [r["name"] for r in back.orderBy("ts_code").collect()] == names


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=20))
def test_numbers_are_plain_and_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, text in df.select("v", plain_number(F.col("v"))).collect():
        assert re.fullmatch(r"-?[0-9]+\.[0-9]+", text) and float(text) == v, (v, text)
