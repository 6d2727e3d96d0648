"""Toxicity: a factorization machine over hashed terms.

A text's terms are its distinct words and the first letters of longer words (a group of marked
words often shares its beginning), hashed into 2^18 slots and weighted by inverse document
frequency. The machine adds to the linear weights a product of factors for each pair of terms,
so that an insult next to a group mention can count for more than both alone. It is fitted on
the driver, by AdaGrad over mini-batches in a seeded order, on at most ``max_rows`` labelled
rows (those first by hash of the id). Terms are chosen in two steps: those whose own share of ones
is off, and then, by the joint counts of all pairs of terms, those that say something only together:
rows that hold both are compared with what a machine of the first terms expects of them. Inverse
document frequencies weight the terms of a row against each other; they belong to the fitted
machine and are those of the rows it is fitted on. Scoring sends the weights, of fixed size, to the
tasks and reads every text as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import unwrapped, wrapped
from barlake.llm.tokens import Words, alnum_bytes, chunks, mixed_bits, slices, text_bytes

BITS = 18
FACTORS = 4
PREFIXES = (4, 5, 6, 7)
MAX_ROWS = 20_000
MIN_DF, MIN_Z = 6, 3.0
# Words in a larger share of rows are paired; rows with both, and standard errors that they are off,
# for a pair to count: among the pairs of some thousand words, none is so far off by chance.
PAIR_SHARE, MIN_PAIR_DF, MIN_PAIR_Z = 0.005, 10, 7.0
PAIR_BLOCK, PAIR_ROWS = 512, 4096
THRESHOLD = 0.3
_SALT = np.uint64(0xA0761D6478BD642F)


def held_out(id_col: str = "doc_id") -> Column:
    """Kept out of learning; a row without an id is not."""
    left = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2
    return F.coalesce(left, F.lit(False))


def text_terms(texts: list[bytes], prefixes: tuple[int, ...] = PREFIXES) -> list[np.ndarray]:
    """Sorted distinct term slots of each text: of words, and of beginnings of so many letters."""
    out = []
    for begin, end in chunks(texts):
        words = Words(texts[begin:end], alnum_bytes())
        hashes = [words.hashes]
        for n in prefixes:
            begun = words.beginnings(n)
            longer = words.ends - words.starts > n
            hashes.append(np.where(longer, mixed_bits(begun + _SALT), hashes[0]))
        slots = np.stack(hashes, axis=1) >> np.uint64(64 - BITS)
        for k in range(end - begin):
            own = slots[words.firsts[k]:words.firsts[k + 1]]
            out.append(np.unique(own).astype(np.int32))
    return out


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    idf: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def values(self, terms: np.ndarray) -> np.ndarray:
        x = self.idf[terms]
        return x / max(float(np.sqrt(x @ x)), 1e-9)

    def margin(self, terms: np.ndarray) -> float:
        terms = terms[self.idf[terms] > 0]
        x = self.values(terms)
        v = self.factors[terms] * x[:, None]
        both = 0.5 * float((v.sum(axis=0) ** 2).sum() - (v * v).sum())
        return self.bias + float(self.weights[terms] @ x) + both

    def score(self, terms: np.ndarray) -> float:
        return float(_sigmoid(np.array(self.slope * self.margin(terms) + self.shift)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _told(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document frequencies, and which terms tell the classes apart: in MIN_DF rows at least,
    with a share of ones more than MIN_Z standard errors off that of all rows."""
    size, share = 1 << BITS, labels.mean()
    df, ones = np.zeros(size), np.zeros(size)
    for terms, label in zip(rows, labels, strict=True):
        df[terms] += 1
        ones[terms] += label
    error = np.sqrt(np.maximum(df * share * (1 - share), 1e-9))
    return df, (df >= MIN_DF) & (np.abs(ones - df * share) > MIN_Z * error)


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7,
        words: list[np.ndarray] | None = None, each=map) -> Machine:
    """A machine fitted on four fifths of the rows, whose scores the last fifth calibrates.
    ``words`` are the terms of each row that are paired; by default all. ``each`` maps the
    counting of pairs.

    Without rows or with one class only, the score is the share of ones.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.5
    size, bias = 1 << BITS, float(np.log(share / (1 - share)))
    flat = Machine(bias, np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32),
                   np.zeros(size, np.float32))
    last = np.arange(len(rows)) % 5 == 4
    if min(len(set(labels[last].tolist())), len(set(labels[~last].tolist()))) < 2:
        return flat
    part = np.flatnonzero(~last)
    own, known = [rows[i] for i in part], labels[part]
    df, told = _told(own, known)
    idf = np.log((1 + len(part)) / (1 + df))
    flat.idf = np.where(told, idf, 0).astype(np.float32)
    machine = _descend(replace(flat, weights=flat.weights.copy()), own, known, seed)
    paired = _paired([(words or rows)[i] for i in part], known,
                     np.array([machine.margin(t) for t in own]), each)
    if len(paired):
        told[paired] = True
        flat.idf = np.where(told, idf, 0).astype(np.float32)
        machine = _descend(flat, own, known, seed, epochs=40, spread=0.3, pull=1.0)
    z = np.array([machine.margin(rows[i]) for i in np.flatnonzero(last)])
    machine.slope, machine.shift = _calibrated(z, labels[last])
    return machine


def _paired(rows: list[np.ndarray], labels: np.ndarray, margins: np.ndarray,
            each=map) -> np.ndarray:
    """Terms of pairs that say something together: in the rows with both, the labels are more than
    MIN_PAIR_Z standard errors off what the margins expect. Terms that stand in the same rows, like a
    word and its beginning, are no pair. All pairs are counted, a block against a block, for which
    ``each`` may spread the work."""
    # Copies of a text are one row: they say nothing more together.
    first = {own.tobytes(): i for i, own in reversed(list(enumerate(rows)))}
    chosen = np.array(sorted(first.values()), np.int64)
    rows, labels, margins = [rows[i] for i in chosen], labels[chosen], margins[chosen]
    expected = _sigmoid(margins)
    df = np.zeros(1 << BITS)
    for own in rows:
        df[own] += 1
    terms = np.flatnonzero(df >= max(MIN_PAIR_DF, PAIR_SHARE * len(rows)))
    place = np.full(1 << BITS, -1, np.int16 if len(terms) < 1 << 15 else np.int32)
    place[terms] = np.arange(len(terms))
    pairs = _Pairs([place[t][place[t] >= 0] for t in rows], (labels - expected).astype(np.float32),
                   (expected * (1 - expected)).astype(np.float32), df[terms])
    begins = range(0, len(terms), PAIR_BLOCK)
    found = list(each(pairs.of, [(a, b) for a in begins for b in begins if a <= b]))
    return terms[np.unique(np.concatenate(found))] if found else terms[:0]


@dataclass
class _Pairs:
    """The terms of some rows by number, how far each row is off and how far by chance, and the
    rows that each term has."""

    slots: list[np.ndarray]
    rest: np.ndarray
    noise: np.ndarray
    count: np.ndarray

    def of(self, blocks: tuple[int, int]) -> np.ndarray:
        """The distinct terms of the pairs between two blocks that count; some rows at a time."""
        left, right = blocks
        both, off, spread = sums = np.zeros((3, PAIR_BLOCK, PAIR_BLOCK), np.float32)
        for at in range(0, len(self.slots), PAIR_ROWS):
            part = slice(at, at + PAIR_ROWS)
            a, b = _dense(self.slots[part], left), _dense(self.slots[part], right)
            sums[0] += a.T @ b
            sums[1] += a.T @ (b * self.rest[part, None])
            sums[2] += a.T @ (b * self.noise[part, None])
        i, j = np.nonzero((both >= MIN_PAIR_DF) & (np.abs(off) > MIN_PAIR_Z * np.sqrt(
            np.maximum(spread, 1.0))))
        apart = both[i, j] < 0.9 * np.minimum(self.count[i + left], self.count[j + right])
        return np.unique(np.concatenate((i[apart] + left, j[apart] + right)))


def _in_tasks(spark: SparkSession):
    """Maps a bound method over pairs of numbers in Spark tasks; its object, which is sent, has
    the terms of MAX_ROWS rows at most."""
    def each(work, items: list[tuple[int, int]]):
        if not items:
            return []
        sent = spark.sparkContext.broadcast(work)

        def run(batches):
            for batch in batches:
                found = [sent.value(x) for x in zip(
                    batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f.tolist() for f in found], pa.list_(pa.int64()))], ["found"])

        blocks = spark.createDataFrame(items, "a long, b long").repartition(
            min(len(items), 64), F.xxhash64("a", "b"))
        rows = blocks.mapInArrow(run, "found array<long>").toArrow()["found"]
        sent.destroy()
        return [np.asarray(x.values, dtype=np.int64) for x in rows]

    return each


def _dense(slots: list[np.ndarray], begin: int) -> np.ndarray:
    """Which of PAIR_BLOCK terms each row has."""
    out = np.zeros((len(slots), PAIR_BLOCK), np.float32)
    for k, own in enumerate(slots):
        low, high = np.searchsorted(own, (begin, begin + PAIR_BLOCK))
        out[k, own[low:high] - begin] = 1
    return out


def _calibrated(z: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over the margins, by Newton steps with a small pull
    towards slope 1 and shift 0."""
    x, at = np.stack([z, np.ones_like(z)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ at)
        gradient = x.T @ (p - labels) + 0.1 * (at - [1.0, 0.0])
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        at = at - np.linalg.solve(curve, gradient)
    return max(float(at[0]), 0.05), float(at[1])


def _descend(m: Machine, rows: list[np.ndarray], labels: np.ndarray, seed: int,
             epochs: int = 10, batch: int = 256, rate: float = 0.3,
             decay: float = 1e-4, spread: float = 0.05, pull: float = 0.2) -> Machine:
    """Logistic loss, mini-batches in seeded order, AdaGrad steps. ``spread`` is that of the first
    factors, ``pull`` the size of their steps against those of the weights."""
    rng = np.random.default_rng(seed)
    m.factors = rng.normal(0, spread, m.factors.shape).astype(np.float32)
    rows = [t[m.idf[t] > 0] for t in rows]
    xs = [m.values(t).astype(np.float32) for t in rows]
    w2, f2, b2 = np.full_like(m.weights, 1e-8), np.full_like(m.factors, 1e-8), 1e-8
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            own = order[at:at + batch]
            terms = np.concatenate([rows[i] for i in own])
            x = np.concatenate([xs[i] for i in own])
            row = np.repeat(np.arange(len(own)), [len(rows[i]) for i in own])
            vx = m.factors[terms] * x[:, None]
            sums = np.stack([np.bincount(row, vx[:, f], len(own)) for f in range(FACTORS)], 1)
            squares = np.bincount(row, (vx * vx).sum(axis=1), len(own))
            z = m.bias + np.bincount(row, m.weights[terms] * x, len(own)) \
                + 0.5 * ((sums * sums).sum(axis=1) - squares)
            g = (_sigmoid(z) - labels[own]) / len(own)
            b2 += float(g.sum()) ** 2
            m.bias -= 0.2 * rate * float(g.sum()) / b2 ** 0.5
            if not len(terms):
                continue
            slots, back = np.unique(terms, return_inverse=True)
            gx = g[row] * x
            gw = np.bincount(back, gx, len(slots)) + decay * m.weights[slots]
            gf = np.stack([np.bincount(back, gx * (sums[row, f] - vx[:, f]), len(slots))
                           for f in range(FACTORS)], 1) + decay * m.factors[slots]
            w2[slots] += gw * gw
            f2[slots] += gf * gf
            m.weights[slots] -= rate * gw / np.sqrt(w2[slots])
            m.factors[slots] -= pull * rate * gf / np.sqrt(f2[slots])
    return m


def learned(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Machine:
    """The machine of the labelled documents (doc_id, text; doc_id, toxic).

    Held-out rows, rows without a label and rows without an id are not learned from. Of
    repeated label rows the largest label counts.
    """
    marks = (
        labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    # The ids are chosen before any text moves.
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def terms(batches):
        for batch in slices(batches):
            texts = text_bytes(batch.column("text"))
            words = text_terms(texts, ())
            # The words first, then the other terms.
            found = [np.concatenate((w, np.setdiff1d(t, w, assume_unique=True)))
                     for w, t in zip(words, text_terms(texts), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"),
                 pa.array(found, pa.list_(pa.int32())),
                 pa.array(list(map(len, words)), pa.int32())],
                ["doc_id", "toxic", "terms", "words"])

    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    schema = T.StructType([known.schema["doc_id"], known.schema["toxic"],
                           T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("words", T.IntegerType())])
    rows = known.select("doc_id", "toxic", "text").mapInArrow(terms, schema).toArrow()
    order = sorted(range(len(rows)), key=lambda i: (rows["doc_id"][i].as_py(), i))
    terms = [np.asarray(rows["terms"][i].values, dtype=np.int32) for i in order]
    words = [t[:rows["words"][i].as_py()] for t, i in zip(terms, order, strict=True)]
    marked = np.array([rows["toxic"][i].as_py() for i in order], dtype=np.float64)
    machine = fit(terms, marked, words=words, each=_in_tasks(docs.sparkSession))
    # The driver goes on for long after this; its pool would keep what the rows took.
    del rows, terms, words
    pa.default_memory_pool().release_unused()
    return machine


def scored(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__score``, 0 to 1. A null or empty text has the score of no terms."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def scores(batches):
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            found = [sent.value.score(t) for t in text_terms(text_bytes(batch.column(at)))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())],
                [*batch.schema.names, "__score"])

    return docs.mapInArrow(
        scores, T.StructType([*docs.schema.fields, T.StructField("__score", T.DoubleType())]))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, as they came."""
    found = scored(wrapped(docs, "doc_id", "text"), learned(docs, labels))
    return unwrapped(found.where(F.col("__score") < threshold), docs.columns)
