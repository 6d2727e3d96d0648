"""Hard negatives of anchor vectors by segment summary filtering.

Vectors are cut into segments of neighbouring components, of which the mean m and the deviation s
are kept. A segment of length n adds n (m m' + s s') at most and n (m m' - s s') at least to the
inner product of two vectors, so the sums over all segments bound the score. In a tile of rows
and anchors, the bounds of few segments are one small matrix product; rows that may still be
wanted are refined with more segments, and only what is left is scored exactly. What may be
wanted is told by the scores already found: those of the rows that the summaries put first.

Rows and anchors meet in tiles of blocks by hash, whatever their labels, so no label is a group of
its own. Each tile sends the best rows of its anchors on, and Spark keeps the best of all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.common import cut

ROWS, ANCHORS, AT_ONCE = 8192, 4096, 256
# Segments per vector, coarse to fine.
SEGMENTS = (4, 16)
HUGE = 1e70
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """floor(256 x), as doubles, which hold it exactly."""
    return np.floor(256 * x)


class Vectors:
    """Vectors of one length with the summaries of their segments."""

    def __init__(self, x: np.ndarray):
        self.x, self.dims = x, x.shape[1]
        with np.errstate(over="ignore"):
            self.norms = np.sqrt((x * x).sum(axis=1))
        self.largest = float(np.abs(x).max(initial=0))
        self.summaries = [self._summary(min(n, self.dims)) for n in SEGMENTS if self.dims]

    def _summary(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Means and deviations times the root of the segment's length, so that their products
        add up to the bounds."""
        begins = np.arange(n) * self.dims // n
        sizes = np.diff(np.append(begins, self.dims))
        with np.errstate(over="ignore", invalid="ignore"):
            mean = np.add.reduceat(self.x, begins, axis=1) / sizes
            apart = self.x - np.repeat(mean, sizes, axis=1)
            squares = np.add.reduceat(apart * apart, begins, axis=1)
        return mean * np.sqrt(sizes), np.sqrt(squares)

    def middle_and_reach(self, level: int, rows, other: "Vectors", its):
        """Middle and half width of the bounds of scores with rows of other vectors; the width
        has a margin for rounding. Numbers too large to multiply are unbounded."""
        if max(self.largest, other.largest) > HUGE:
            none = np.zeros((len(rows), len(its)))
            return none, none + np.inf
        m, s = self.summaries[level]
        om, os = other.summaries[level]
        slack = 1e-9 * np.multiply.outer(self.norms[rows], other.norms[its]) + 1e-6
        return m[rows] @ om[its].T, s[rows] @ os[its].T + slack

    def scores(self, rows: np.ndarray, other: "Vectors", i: int) -> np.ndarray:
        """Exact scores as whole numbers, held at the ends of the long range."""
        if self.dims * self.largest * other.largest < 1 << 53:
            return (self.x[rows] @ other.x[i]).astype(np.int64)
        y = [int(v) for v in other.x[i]]
        exact = (sum(int(a) * b for a, b in zip(r, y, strict=True)) for r in self.x[rows])
        return np.array([min(max(e, _LEAST), _MOST) for e in exact], np.int64)


def _first(scores: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores; of equals those first in ``order``."""
    return np.lexsort((order, ~scores))[:k]


def _refined(rows: Vectors, own: np.ndarray, may: np.ndarray, anchors: Vectors, i: int,
             low: int, high: int) -> np.ndarray:
    """Of some places in ``own`` those whose score may lie between low and high, by all finer
    summaries."""
    for level in range(1, len(rows.summaries)):
        middle, reach = (v[:, 0] for v in rows.middle_and_reach(level, own[may], anchors, [i]))
        may = may[(middle + reach >= low) & (middle - reach <= high)]
    return may


def best_of(rows: Vectors, own: np.ndarray, order: np.ndarray, anchors: Vectors, i: int,
            middle: np.ndarray, reach: np.ndarray, windows, k: int):
    """For each window (low, high), the places in ``own`` and the scores of the first k rows
    with a score inside. ``middle`` and ``reach`` are the coarse bounds of ``own``."""
    low, high = min(w[0] for w in windows), max(w[1] for w in windows)
    may = np.flatnonzero((middle + reach >= low) & (middle - reach <= high))
    # The likeliest rows tell which scores the others have to reach.
    likely = may[np.argsort(-np.where(middle[may] <= high, middle[may], -np.inf))[:6 * k]]
    found = rows.scores(own[likely], anchors, i)
    reached = []
    for a, b in windows:
        inside = np.sort(found[(found >= a) & (found <= b)])
        reached.append(max(a, int(inside[-k])) if len(inside) >= k else a)
    low = min(reached)
    may = may[middle[may] + reach[may] >= low]
    may = _refined(rows, own, may, anchors, i, low, high)
    found = rows.scores(own[may], anchors, i)
    out = []
    for a, b in windows:
        inside = np.flatnonzero((found >= a) & (found <= b))
        first = inside[_first(found[inside], order[own[may[inside]]], k)]
        out.append((may[first], found[first]))
    return out


def _by_length(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, Vectors]]:
    """Places and vectors of each vector length."""
    column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = {}
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        out[n] = at, Vectors(whole_numbers(flat.astype(np.float64).reshape(len(at), n)))
    return out


_FOUND = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("p", T.IntegerType()),
    T.StructField("row", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("score", T.LongType())])


def _tile(left: pa.Table, right: pa.Table, k: int, same_label: bool) -> pa.Table:
    """The first k rows of each window of each anchor among the rows of the tile."""
    parts = [[np.zeros(0, np.int64)] for _ in range(4)]
    if len(left) and len(right):
        label, row = left["label"].to_numpy(), left["row"].to_numpy()
        order = _id_order(left)
        names, mine = right["its"].to_numpy(), right["mine"].to_numpy()
        windows = right["windows"].to_pylist()
        stored = _by_length(left["vec"])
        for n, (at, anchors) in _by_length(right["asking"]).items():
            if n not in stored:
                continue
            places, rows = stored[n]
            for begin in range(0, len(at), AT_ONCE):
                its = np.arange(begin, min(begin + AT_ONCE, len(at)))
                if n:
                    bounds = rows.middle_and_reach(0, np.arange(len(places)), anchors, its)
                else:
                    bounds = (np.zeros((len(places), len(its))),) * 2
                for j, i in enumerate(its):
                    a = at[i]
                    own = (label[places] == mine[a]) == same_label
                    own = np.flatnonzero(own & (row[places] != names[a]))
                    if not len(own) or not windows[a]:
                        continue
                    found = best_of(rows, own, order[places], anchors, i, bounds[0][own, j],
                                    bounds[1][own, j], [(w["low"], w["high"]) for w in windows[a]], k)
                    for w, (at_own, score) in zip(windows[a], found, strict=True):
                        parts[0].append(np.full(len(score), a))
                        parts[1].append(np.full(len(score), w["p"]))
                        parts[2].append(places[own[at_own]])
                        parts[3].append(score)
    anchor, p, at, score = (np.concatenate(x) for x in parts)
    return pa.table({
        "anchor": right["its"].take(pa.array(anchor)), "p": pa.array(p, pa.int32()),
        "row": left["row"].take(pa.array(at)), "id": left["id"].take(pa.array(at)),
        "score": pa.array(score, pa.int64())})


def _id_order(table: pa.Table) -> np.ndarray:
    """Rank of each row by id, then row; rows without an id last."""
    order = pc.sort_indices(
        table.select(["id", "row"]), sort_keys=[("id", "ascending"), ("row", "ascending")])
    rank = np.empty(len(table), np.int64)
    rank[order.to_numpy()] = np.arange(len(table))
    return rank


def _best(rows: DataFrame, asking: DataFrame, n_rows: int, n_anchors: int, k: int,
          same_label: bool) -> DataFrame:
    """(anchor, p, rank, row, id, score): the first k rows in each window of each anchor."""
    tall, wide = (max(1, math.ceil(n / size)) for n, size in ((n_rows, ROWS), (n_anchors, ANCHORS)))

    def block(n):
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.select(block(tall).alias("r"), every(wide).alias("a"), "row", "id", "label", "vec")
    right = asking.select(
        every(tall).alias("s"), block(wide).alias("b"), F.col("row").alias("its"),
        F.col("label").alias("mine"), F.col("vec").alias("asking"), "windows")
    found = left.groupBy("r", "a").cogroup(right.groupBy("s", "b")).applyInArrow(
        lambda one, two: _tile(one, two, k, same_label), _FOUND)
    rank = ("row_number() OVER (PARTITION BY anchor, p ORDER BY score DESC, id NULLS LAST, row) "
            "AS rank")
    return found.selectExpr("*", rank).where(F.col("rank") <= k)


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(row, id, label, vec) of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(256 * x) != float("inf")))
    return vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"), vec.alias("vec"),
    ).where(F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))


def mined(
    vectors: DataFrame, anchors_each: int = 100, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, id_col: str = "vec_id", vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``anchors_each`` divides. A row's score is the inner product
    with the anchor after each component x became floor(256 x); higher scores come first, then
    smaller ids, rows without an id last. An anchor's positives are its first other rows of the
    same label. For each of them its negatives are the first rows of another label with
    low * positive_score <= 100 * score <= high * positive_score.

    Rows with a null label, a null vector, or a component that is null or whose 256-fold is not
    finite take no part. Rows meet rows with vectors of the same length only; empty vectors score
    0. Repeated rows are rows of their own, and an anchor that stands twice gives its rows twice.
    Scores beyond the long range are held at its ends. Every row is looked at: the bounds leave
    out only what cannot be among the first.
    """
    rows = cut(usable(vectors, id_col, vec_col, label_col))
    anchors = rows.where(F.col("id") % anchors_each == 0)
    counts = rows.agg(F.count("*"), F.count_if(F.col("id") % anchors_each == 0)).first()

    def window(p, a, b):
        return F.struct(p.alias("p"), a.cast("long").alias("low"), b.cast("long").alias("high"))

    anything = F.array(window(F.lit(0), F.lit(_LEAST), F.lit(_MOST)))
    best = cut(_best(rows, anchors.withColumn("windows", anything), *counts, positives, True)
               .select("anchor", F.col("rank").alias("p"), F.col("id").alias("positive_id"),
                       F.col("score").alias("positive_score")))
    # Whole numbers between both ends; decimals hold the products.
    score = F.col("positive_score").cast("decimal(20,0)")
    ends = (F.ceil(score * low / 100), F.floor(score * high / 100))
    asked = best.groupBy(F.col("anchor").alias("row")).agg(
        F.collect_list(window(F.col("p"), *ends)).alias("windows"))
    asking = anchors.join(asked, "row").withColumn(
        "windows", F.filter("windows", lambda w: w["low"] <= w["high"]))
    found = _best(rows, asking, *counts, negatives, False)
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return found.join(best, ["anchor", "p"]).join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def shifted_labels(vectors: DataFrame, each: int = 7, labels: int = 10) -> DataFrame:
    """``vectors`` with the next label wherever ``each`` divides the id."""
    return vectors.withColumn("label", F.when(
        F.col("vec_id") % each == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))
