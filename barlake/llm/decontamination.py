"""Benchmark decontamination by a broadcast hash set of the test items' word windows.

An item's windows are its runs of 13 words; an item of fewer words is one window. Tasks scan
the word windows of the training texts against the set, compare the words of each hash hit,
and mark every word inside an occurrence. The set is broadcast in blocks of a fixed number of
windows; with more than one block, the texts are scanned once per block and the marks, kept
in two columns, are written to the shared folder in between.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import cut, unwrapped, wrapped
from barlake.llm.tokens import Words, alnum_bytes, chunks, slices, text_bytes

WINDOW = 13
# A window of 13 words takes about 100 bytes as text and 300 in the table, so a block stays
# below 100 MB.
BLOCK_WINDOWS = 200_000
_SIEVE_BITS = 20


class WindowSet:
    """Windows by length: sorted hashes, a bit sieve over them, and words and items by hash."""

    def __init__(self, items: list[tuple[object, bytes]], window: int = WINDOW):
        self.owners: dict[int, dict[int, dict[bytes, set[str]]]] = defaultdict(dict)
        for item, text in items:
            words = Words([text], alnum_bytes())
            n = min(window, len(words.hashes))
            if not n:
                continue
            for i, h in enumerate(words.runs(n).tolist()):
                known = self.owners[n].setdefault(h, {}).setdefault(words.phrase(i, n), set())
                if item is not None:
                    known.add(str(item))
        self.sieves = {}
        for n, by_hash in self.owners.items():
            sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
            sieve[np.fromiter(by_hash, dtype=np.uint64) >> np.uint64(64 - _SIEVE_BITS)] = True
            self.sieves[n] = sieve

    def hits(self, words: Words) -> Iterator[tuple[int, int, set[str]]]:
        """Place, length and items of the windows that occur."""
        for n, sieve in self.sieves.items():
            runs, by_hash = words.runs(n), self.owners[n]
            for i in np.flatnonzero(sieve[runs >> np.uint64(64 - _SIEVE_BITS)]).tolist():
                items = by_hash.get(int(runs[i]), {}).get(words.phrase(i, n))
                if items is not None:
                    yield i, n, items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(texts: list[bytes], windows: WindowSet):
    """Per text: its number of words, hit spans as [first word, end) and items."""
    for begin, end in chunks(texts):
        words = Words(texts[begin:end], alnum_bytes())
        spans, items = defaultdict(list), defaultdict(set)
        for i, n, found in windows.hits(words):
            k = int(np.searchsorted(words.firsts, i, side="right")) - 1
            if i + n <= words.firsts[k + 1]:
                first = int(words.firsts[k])
                spans[k].append((i - first, i - first + n))
                items[k] |= found
        for k in range(end - begin):
            yield int(words.firsts[k + 1] - words.firsts[k]), spans[k], items[k]


def _marked(df: DataFrame, text_col: str, windows) -> DataFrame:
    marks = [T.StructField("__words", T.LongType()),
             T.StructField("__spans", T.ArrayType(T.ArrayType(T.LongType()))),
             T.StructField("__items", T.ArrayType(T.StringType()))]
    kept = [f for f in df.schema.fields if f.name not in ("__words", "__spans", "__items")]
    names = [f.name for f in kept]
    again = "__words" in df.columns

    def scan(batches):
        for batch in slices(batches):
            words, spans, items = [], [], []
            texts = text_bytes(batch.column(batch.schema.get_field_index(text_col)))
            none = [()] * len(texts)
            old_spans = batch.column("__spans").to_pylist() if again else none
            old_items = batch.column("__items").to_pylist() if again else none
            found = _scan(texts, windows.value)
            for (n, s, i), s0, i0 in zip(found, old_spans, old_items, strict=True):
                words.append(n)
                spans.append(_merged([*map(tuple, s0), *s]))
                items.append(sorted({*i0, *i}))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(words, pa.int64()),
                 pa.array([[list(x) for x in s] for s in spans], pa.list_(pa.list_(pa.int64()))),
                 pa.array(items, pa.list_(pa.string()))],
                [*names, "__words", "__spans", "__items"])

    return df.mapInArrow(scan, T.StructType([*kept, *marks]))


def marked(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    bench_text: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` with __words (number of words), __spans (hit words as [first, end), merged and
    sorted) and __items (distinct ids, as text, of items with an occurring window).

    A null or empty text has no words and no hits, on either side. Repeated item rows count
    once; an item without an id marks words but is not listed. Other columns pass through.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_col).alias("item"), F.col(bench_text).alias("text"))
    # Windows are at most one more than the bytes, halved: a word and a separator.
    size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) / 2 + 1)
    blocks = 1 + int((bench.select(size).first()[0] or 0) // block_windows)
    for block in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        rows = [(r["item"], (r["text"] or "").encode()) for r in part.collect()]
        docs = _marked(docs, text_col, spark.sparkContext.broadcast(WindowSet(rows, window)))
        if block + 1 < blocks:
            docs = cut(docs)
    return docs


def n_hit():
    return F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def contaminated():
    """At least one word in 20 is hit."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("__words"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they came."""
    found = marked(wrapped(docs, "doc_id", "text"), benchmark)
    return unwrapped(found.where(~contaminated()), docs.columns)


def without_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """All documents, with the hit words (and what stands between them) cut from the text."""
    found = marked(wrapped(docs, text_col), benchmark, text_col)

    def cut_words(batches):
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            for i, spans in enumerate(batch.column("__spans").to_pylist()):
                if spans:
                    words = Words([texts[i]], alnum_bytes())
                    for first, end in reversed(spans):
                        begin, stop = words.starts[first] - 1, words.ends[end - 1] - 1
                        texts[i] = texts[i][:begin] + texts[i][stop:]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.binary()).cast(pa.string()), batch.column("__rest")],
                [text_col, "__rest"])

    kept = found.select(text_col, "__rest")
    cleaned = found.select(text_col, "__rest", "__spans").mapInArrow(cut_words, kept.schema)
    return unwrapped(cleaned, docs.columns)
