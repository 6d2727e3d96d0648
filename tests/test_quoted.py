"""Large CSV files with line breaks in quotes: the same rows as Spark's reader of whole files."""

import itertools
import random
import re

import pyarrow as pa
import pytest

from barlake.sources import landing, quoted
from conftest import rows_of


def states(text, inside):
    """Whether a line ends inside quotes, character by character."""
    field_start, quoted_field, k = not inside, inside, 0
    while k < len(text):
        c = text[k]
        if quoted_field:
            if c == '"' and text[k + 1:k + 2] == '"':
                k += 1
            elif c == '"':
                quoted_field = False
            field_start = False
        elif field_start and c == '"':
            quoted_field, field_start = True, False
        else:
            field_start = c == ","
        k += 1
    return quoted_field


def test_lines_end_as_character_by_character():
    texts = ["".join(t) for n in range(7) for t in itertools.product('",x', repeat=n)]
    lines = pa.array([t.encode() for t in texts], pa.binary())
    outside, inside = quoted._ends(lines)
    assert outside == [states(t, False) for t in texts]
    assert inside == [states(t, True) for t in texts]


def test_clean_lines_end_outside(spark):
    usual = ["", "x", "x,x", '"x"', '"x,x",x', '"x""x",""', 'x,"",x', '"x"\r']
    texts = usual + ["".join(t) for n in range(8) for t in itertools.product('",x', repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    found = dict(rows_of(df.select("line", quoted.clean(df["line"]))))
    assert not [t for t in texts if found[t] and states(t, False)]
    # Fields as they are usually written are clean.
    assert all(found[t] for t in usual)
    assert not found['"x'] and not found['x,"']


def _cell(rng):
    kind = rng.random()
    if kind < 0.4:
        return rng.choice(["", "x", "plain text", "7"])
    body = "".join(rng.choice(['a', 'b', ',', '""', '\n', ' ', 'é', "\n\n"])
                   for _ in range(rng.randrange(1, 40)))
    return f'"{body}"'


def _file(folder, name, rows, encoding="utf-8", end="\n"):
    folder.mkdir(exist_ok=True)
    text = "code,name,note" + end + end.join(rows) + end
    (folder / name).write_bytes(text.encode(encoding))


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _whole(spark, path, encoding="UTF-8"):
    return spark.read.csv(path, header=True, escape='"', multiLine=True, encoding=encoding,
                          schema="code string, name string, note string")


@pytest.mark.parametrize("encoding, end", [("UTF-8", "\n"), ("UTF-8", "\r\n"), ("GBK", "\n"),
                                           ("ISO-8859-1", "\n")])
def test_records_equal_those_of_whole_files(spark, tmp_path, small_blocks, encoding, end):
    rng, folder = random.Random(encoding + end), tmp_path / "in"
    cell = {"GBK": "中国\n平安", "ISO-8859-1": "caf\xe9\xff\nx", "UTF-8": "平\n安"}[encoding]
    for k in range(3):
        rows = [f'{n},{_cell(rng).replace("é", "e")},{_cell(rng).replace("é", "e")}'
                for n in range(120)]
        rows[60] = f'60,"{cell}",""'
        _file(folder, f"{k}.csv", rows, encoding.lower(), end)
    # One record over several blocks, and a file without any line break in quotes.
    long = '"' + "line, of text\n" * 200 + '"'
    _file(folder, "long.csv", ["1,x,y", f"2,{long},z", "3,a,b"] * 3, encoding.lower(), end)
    _file(folder, "flat.csv", [f"{n},x,y" for n in range(200)], "ascii", end)
    path = str(folder)
    kinds = ("UTF-8", encoding)
    got = landing.read_csv_any_encoding(spark, path, kinds)
    want = _whole(spark, path, encoding)
    assert sorted(map(str, rows_of(got))) == sorted(map(str, rows_of(want)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path, small_blocks):
    rng = random.Random(2)
    _file(tmp_path / "in", "a.csv", [f"{n},{_cell(rng)},{_cell(rng)}" for n in range(400)])
    lines = quoted._lines(spark, [str(tmp_path / "in")])
    assert lines.rdd.getNumPartitions() > 10
    assert len(quoted._block_ends(lines)) == 1


def test_a_quote_that_never_closes(spark, tmp_path, small_blocks):
    _file(tmp_path / "in", "a.csv", ["1,x,y"] * 100 + ['2,"open,z'] + ["3,x,y"] * 200)
    path = str(tmp_path / "in")

    def stripped(df):  # the reader of whole files keeps the line break at the end of the file
        return sorted(tuple(v and v.rstrip("\n") for v in r) for r in df.select("code", "name").collect())

    got = stripped(landing.read_csv(spark, path))
    assert len(got) == 101 and got == stripped(_whole(spark, path))


def test_small_files_and_flat_files_need_no_cutting(spark, tmp_path):
    _file(tmp_path / "in", "a.csv", ['1,"two\nlines",x'])
    _file(tmp_path / "in", "b.csv", ['2,"one ""quoted"" line",x'])
    kinds = {re.sub(r".*/", "", r["file"]): r["clean"]
             for r in landing.file_encodings(spark, str(tmp_path / "in")).collect()}
    assert kinds == {"a.csv": False, "b.csv": True}
    got = landing.read_csv(spark, str(tmp_path / "in"))
    assert sorted(rows_of(got)) == [("1", "two\nlines", "x"), ("2", 'one "quoted" line', "x")]
    assert "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString()
