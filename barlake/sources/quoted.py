"""Large CSV files with line breaks inside quotes, read by many tasks.

Whether a line break ends a record depends on all quotes before it. A line may begin outside or
inside of quotes, and for either case it ends outside or inside; these two answers of the lines of
a block add up to two answers of the block. One pass finds them for every block, so that the
state at the start of each is known, and a second pass cuts the records. What a block has of a record
that began in another one, or goes on in the next, is put together by Spark afterwards.

Lines are looked at as bytes: in the encodings at hand neither line feeds, quotes nor commas occur
inside other characters.
"""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Quotes open a field at its first character only. Inside, two of them stand for one; what follows
# the closing one up to the next comma belongs to the field, quotes included.
_REST = r'(?:[^",][^,]*)?'
_CLOSED = r'(?:"(?:[^"]|"")*"' + _REST + r'|' + _REST + r")"
_OPEN = r'"(?:[^"]|"")*$'
# Lines that end inside quotes, for those that begin outside, and those that begin inside.
FROM_OUTSIDE = rf"(?s)^(?:{_CLOSED},)*{_OPEN}"
FROM_INSIDE = rf'(?s)^(?:[^"]|"")*$|^(?:[^"]|"")*"{_REST},(?:{_CLOSED},)*{_OPEN}'


def clean(line: Column) -> Column:
    """Whether every quote of a line that begins outside belongs to a field that ends in it. If
    so, the line ends outside; if not, it may."""
    quote = F.lit('"')
    closed = F.regexp_replace(F.replace(line, F.lit('""'), F.lit("")),
                              r'(?:^|(?<=,))"[^"]*"(?=,|\r?$)', "")
    return F.when(F.contains(line, quote), ~F.contains(closed, quote)).otherwise(True)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"))


def _ends(lines: pa.Array) -> tuple[list[bool], list[bool]]:
    return tuple(pc.match_substring_regex(lines, p).to_pylist()
                 for p in (FROM_OUTSIDE, FROM_INSIDE))


def _by_block(batch: pa.RecordBatch):
    """((file, block), rows) of the runs of a batch; a task has one block after the other."""
    keys = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(),
                    strict=True))
    begin = 0
    for k in range(1, len(keys) + 1):
        if k == len(keys) or keys[k] != keys[begin]:
            yield keys[begin], batch.slice(begin, k - begin)
            begin = k


def _block_ends(lines: DataFrame) -> dict[str, tuple[list[int], list[bool]]]:
    """Per file the blocks with quotes, in order, and whether they end inside of them. The driver
    gets one short row per block."""
    def run(batches):
        found: dict[tuple, tuple[bool, bool]] = {}
        for batch in batches:
            for key, own in _by_block(batch):
                out, inside = found.get(key, (False, True))
                for ends in zip(*_ends(own.column("line")), strict=True):
                    out, inside = ends[out], ends[inside]
                found[key] = (out, inside)
        yield pa.RecordBatch.from_pydict({
            "file": pa.array([f for f, _ in found], pa.string()),
            "block": pa.array([b for _, b in found], pa.int64()),
            "out": pa.array([x for x, _ in found.values()], pa.bool_()),
            "inside": pa.array([x for _, x in found.values()], pa.bool_())})

    # A line without a quote ends as it begins.
    quoted = lines.where(F.contains("line", F.lit(b'"')))
    ends = quoted.mapInArrow(run, "file string, block long, out boolean, inside boolean")
    found: dict[str, tuple[list[int], list[bool]]] = {}
    for r in sorted(ends.collect(), key=lambda r: (r["file"], r["block"])):
        blocks, states = found.setdefault(r["file"], ([], []))
        state = r["inside"] if states and states[-1] else r["out"]
        blocks.append(r["block"])
        states.append(state)
    return found


def _inside(ends: dict, file: str, block: int) -> bool:
    """Whether a block begins inside quotes: as the last block with quotes before it ends."""
    blocks, states = ends.get(file, ([], []))
    k = bisect_left(blocks, block)
    return k > 0 and states[k - 1]


class _Cutter:
    """The records of one block, whose lines come in pieces."""

    def __init__(self, inside: bool):
        # The lines of the record that is open, and whether it began in this block.
        self.open: list[bytes] | None = [] if inside else None
        self.began_here = not inside

    def take(self, lines: pa.Array):
        """(record, began here) of the records that end in these lines."""
        quoted = pc.find_substring(lines, b'"').to_numpy(zero_copy_only=False) >= 0
        ends = _ends(lines.filter(pa.array(quoted))) if quoted.any() else ([], [])
        k = 0
        for line, has in zip(lines.to_pylist(), quoted.tolist(), strict=True):
            inside = self.open is not None
            after = ends[inside][k] if has else inside
            k += has
            if not inside and not after:
                yield line, True
                continue
            if not inside:
                self.open, self.began_here = [], True
            self.open.append(line)
            if not after:
                yield b"\n".join(self.open), self.began_here
                self.open, self.began_here = None, True


def _pieces(lines: DataFrame, ends) -> DataFrame:
    """(file, block, begins, ends, record): records, and parts of records that begin or end in
    another block."""
    def run(batches):
        cutter, key = None, None
        for batch in batches:
            rows = []
            for own_key, own in _by_block(batch):
                if own_key != key:
                    rows += _left(cutter, key)
                    key, cutter = own_key, _Cutter(_inside(ends.value, *own_key))
                    own = own.slice(1) if key[1] == 0 else own  # the header
                rows += [(*key, begins, True, record)
                         for record, begins in cutter.take(own.column("line"))]
            yield _batch(rows)
        yield _batch(_left(cutter, key))

    return lines.mapInArrow(
        run, "file string, block long, begins boolean, ends boolean, record binary")


def _left(cutter: _Cutter | None, key) -> list[tuple]:
    """What is open at the end of a block."""
    if cutter is None or cutter.open is None:
        return []
    return [(*key, cutter.began_here, False, b"\n".join(cutter.open))]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
    names = ("file", "block", "begins", "ends", "record")
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], list(names))


def read_quoted(
    spark: SparkSession, paths: list[str], names: tuple[str, ...], encoding: str
) -> DataFrame:
    """CSV files with one header, which has no line break, every column as text, as Spark's reader
    gives them with ``multiLine``, but split over tasks. A record that runs on to the end of its file because a
    quote never closes is put together in one task, and lacks the file's last line break."""
    lines = _lines(spark, paths)
    ends = spark.sparkContext.broadcast(_block_ends(lines))
    pieces = _pieces(lines, ends)
    whole = F.col("begins") & F.col("ends")
    # At most two parts per block; a record's parts follow the one that begins it.
    in_order = Window.partitionBy("file").orderBy("block", "begins")
    parts = pieces.where(~whole).withColumn(
        "number", F.sum(F.col("begins").cast("int")).over(in_order))
    joined = parts.groupBy("file", "number").agg(F.array_sort(F.collect_list(
        F.struct("block", "begins", "record"))).alias("parts")).select(
        F.array_join(F.transform("parts", lambda p: F.decode(p["record"], encoding)), "\n")
        .alias("record"))
    text = pieces.where(whole).select(F.decode("record", encoding).alias("record")).union(joined)
    record = F.regexp_replace("record", r"\r$", "")
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    cells = F.from_csv(record, schema, {"escape": '"', "multiLine": "true"})
    return text.where(F.length(record) > 0).select(cells.alias("cells")).select("cells.*")
