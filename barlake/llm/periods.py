"""Periodic runs of words by a dictionary of basic factors.

A basic factor is a stretch of 2^k words. Level by level, equal factors of a text get equal
names: a factor is named by the names of its halves. Next occurrences of a factor no further on
than its length form arithmetic progressions, whose step is a period: while the next occurrence
of the factor at i, i + 1, ... is p words on, the text repeats itself with period p. A run with
period p and at least 4p words shows at every level with p <= 2^k <= 2p, as one unbroken stretch
of such places: a closer occurrence would be a smaller period. So a stretch extended by its
factor and its period is the whole run, and runs found at two levels are equal.

Only places whose factor occurs again in the same text go on to the next level, so ordinary
prose is done after a few. The texts of about a megabyte are worked on together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import BLANKS, words
from barlake.llm.tokens import chunks, slices, text_bytes

LEAST_WORDS, LEAST_PERIODS = 6, 4
PIECE_BYTES = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType())
                                  for n in ("start", "length", "period")]))


def pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of whole words, which bounds what is held beside it."""
    begin = 0
    while begin < len(text):
        blank = _BLANK.search(text, begin + PIECE_BYTES)
        end = blank.start() if blank else len(text)
        yield text[begin:end]
        begin = end


def word_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words of all texts as numbers, the first word of each text, and the words by number."""
    known: dict[bytes, int] = {}
    parts, firsts, n = [np.zeros(0, np.int64)], [0], 0
    for text in texts:
        for piece in pieces(text):
            found = piece.split()  # at tab to carriage return and space, as bytes are
            parts.append(np.fromiter((known.setdefault(w, len(known)) for w in found),
                                     np.int64, len(found)))
            n += len(found)
        firsts.append(n)
    return np.concatenate(parts), np.array(firsts), list(known)


def periodic_runs(numbers: np.ndarray, firsts: np.ndarray,
                  least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS):
    """(start, end, period) arrays of all runs, by start and period; starts count from the first
    word of all texts. ``least_periods`` is at least 4, which the levels rely on."""
    if least_periods < 4:
        raise ValueError("least_periods must be 4 at least")
    ends = np.repeat(firsts[1:], np.diff(firsts))
    place, name, size = np.arange(len(numbers)), numbers, 1
    found = []
    while len(place):
        order = np.argsort(name, kind="stable")
        place, name = place[order], name[order]
        # A next occurrence in the same text; places of one name are in order.
        again = (name[1:] == name[:-1]) & (ends[place[1:]] == ends[place[:-1]])
        found.append(_stretches(place[:-1][again], (place[1:] - place[:-1])[again], size))
        twice = np.concatenate((again, [False])) | np.concatenate(([False], again))
        place, name = place[twice], name[twice]
        place, name = _doubled(place, name, size, ends)
        size *= 2
    start, end, period = (np.concatenate(x) for x in zip(
        *found, (np.zeros(0, np.int64),) * 3, strict=True))
    keep = end - start >= np.maximum(least_words, least_periods * period)
    if not keep.any():
        return start[keep], end[keep], period[keep]
    return tuple(np.unique(np.stack((start, period, end))[:, keep], axis=1)[[0, 2, 1]])


def _stretches(place: np.ndarray, step: np.ndarray, size: int):
    """(start, end, period) of the unbroken stretches of places with one step of ``size`` at
    most, extended by the factor and the step."""
    near = step <= size
    place, step = place[near], step[near]
    order = np.lexsort((place, step))
    place, step = place[order], step[order]
    first = np.ones(len(place), bool)
    first[1:] = (step[1:] != step[:-1]) | (place[1:] != place[:-1] + 1)
    begins = np.flatnonzero(first)
    lasts = np.append(begins[1:], len(place))[:len(begins)] - 1
    return place[begins], place[lasts] + size + step[begins], step[begins]


def _doubled(place: np.ndarray, name: np.ndarray, size: int, ends: np.ndarray):
    """Places and names of the factors of twice the size, in order of place."""
    order = np.argsort(place)
    place, name = place[order], name[order]
    at = np.searchsorted(place, place + size)
    at[at == len(place)] = 0
    whole = (place[at] == place + size) if len(place) else np.zeros(0, bool)
    whole &= place + 2 * size <= ends[place]
    left, right = name[whole], name[at[whole]]
    top = int(name.max()) + 1 if len(name) else 1
    _, named = np.unique(left * top + right, return_inverse=True)
    return place[whole], named.astype(np.int64)


def _of_texts(texts: list[bytes]):
    """Per text: its runs as tuples, counted from its own first word, and its kept words."""
    for begin, stop in chunks(texts):
        numbers, firsts, names = word_numbers(texts[begin:stop])
        start, end, period = periodic_runs(numbers, firsts)
        # A run covers what follows its first period.
        cover = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(cover, start + period, 1)
        np.add.at(cover, end, -1)
        kept = np.cumsum(cover[:-1]) == 0
        at = np.searchsorted(start, firsts)
        for k in range(stop - begin):
            a, b = firsts[k], firsts[k + 1]
            own = slice(at[k], at[k + 1])
            runs = [{"start": s, "length": n, "period": p} for s, n, p in zip(
                (start[own] - a).tolist(), (end[own] - start[own]).tolist(),
                period[own].tolist(), strict=True)]
            yield runs, b" ".join([names[i] for i in numbers[a:b][kept[a:b]]])


def with_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__runs``, by start and then period, and ``__collapsed``, the text without
    what repeats.

    Words are parted by tab to carriage return and space. A run is a stretch of words with
    smallest period q and at least max(6, 4q) words that cannot be extended; the words after its
    first q are left out of the collapsed text, whose words are parted by one space. A null or
    empty text has no runs and collapses to the empty text. Every row is looked at by itself,
    repeated ones too.
    """
    def run(batches):
        for batch in slices(batches):
            found = list(_of_texts(text_bytes(batch.column(
                batch.schema.get_field_index(text_col)))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns,
                 pa.array([r for r, _ in found], pa.list_(pa.struct(
                     [(n, pa.int64()) for n in ("start", "length", "period")]))),
                 pa.array([c for _, c in found], pa.binary()).cast(pa.string())],
                [*batch.schema.names, "__runs", "__collapsed"])

    return docs.mapInArrow(run, T.StructType([
        *docs.schema.fields, T.StructField("__runs", _RUNS),
        T.StructField("__collapsed", T.StringType())]))


def longest() -> Column:
    """The longest of ``__runs``; of equals the first, then that of the smallest period; null if
    there is none."""
    return F.reduce(
        "__runs", F.try_element_at("__runs", F.lit(1)),
        lambda best, r: F.when(r["length"] > best["length"], r).otherwise(best))


def runs_text() -> Column:
    """A line ``start,length,period`` for each run."""
    return F.array_join(F.transform("__runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a repetition put into the texts of one id in ten.

    Let h be the checksum of the id, g = floor(h / 10) and n the words: where 10 divides h, word i
    from a = g % n on becomes word a + (i - a) % p with p = 1 + floor((n - a) / (3 + g % 8)).
    Rows without an id or without words stay.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    found = words(F.col(text_col), BLANKS)
    rows = docs.withColumns({"__h": h, "__w": F.when(h % 10 == 0, found)})
    n, g = F.size("__w").cast("long"), F.floor(F.col("__h") / 10)
    rows = rows.withColumn("__a", F.when(n > 0, g % n))
    a = F.col("__a")
    rows = rows.withColumn("__p", F.lit(1) + F.floor((n - a) / (3 + g % 8)))
    repeated = F.transform("__w", lambda w, i: F.when(
        i < a, w).otherwise(F.col("__w")[(a + (i - a) % F.col("__p")).cast("int")]))
    return rows.withColumn(text_col, F.when(
        a.isNotNull(), F.array_join(repeated, " ")).otherwise(F.col(text_col))).drop(
        "__h", "__w", "__a", "__p")
