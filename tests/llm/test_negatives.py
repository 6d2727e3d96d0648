"""Hard negatives against exact scores of all pairs."""

import math
import random

import numpy as np
import pytest
from llm_cases import rows_of

from barlake.llm import negatives, queries
from barlake.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int, `row` string, score double"
LARGEST = (1 << 63) - 1


def usable(vec, label):
    return label is not None and vec is not None and all(
        x is not None and math.isfinite(256 * x) for x in vec)


def plain(rows, each=100, positives=5, negatives=10):
    rows = [(k, i, [math.floor(256 * x) for x in v], g) for k, (i, v, g) in enumerate(rows)
            if usable(v, g)]
    out = []
    for k, i, v, g in rows:
        if i is None or i % each:
            continue
        found = []
        for other, j, w, h in rows:
            if other != k and len(w) == len(v):
                s = sum(a * b for a, b in zip(v, w, strict=True))
                s = min(max(s, -LARGEST - 1), LARGEST)
                found.append((-s, j is None, j or 0, other, j, h == g))
        found.sort(key=lambda f: f[:4])
        for p in [f for f in found if f[5]][:positives]:
            own = [f for f in found if not f[5] and -30 * p[0] <= -100 * f[0] <= -90 * p[0]]
            out += [(i, p[4], n + 1, f[4], -p[0], -f[0]) for n, f in enumerate(own[:negatives])]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows], SCHEMA)


def sorted_rows(rows):
    return sorted(map(str, rows))


def _clustered(rng, n, dims):
    centres = rng.normal(0, 0.2, (6, dims))
    spread = rng.normal(0, 0.1, (n, dims)) + centres[rng.integers(0, 6, n)]
    return [(int(i), [float(x) for x in v], int(g)) for i, v, g in zip(
        rng.permutation(n), spread, rng.integers(0, 3, n), strict=True)]


@pytest.mark.parametrize("dims, n", [(1, 150), (3, 200), (19, 300), (64, 300)])
def test_mined_equals_all_pairs(spark, monkeypatch, dims, n):
    monkeypatch.setattr(negatives, "ROWS", 70)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "AT_ONCE", 3)
    rows = _clustered(np.random.default_rng(dims), n, dims)
    rows += [r for r in rows if r[0] < 12]  # repeated rows
    got = rows_of(negatives.mined(frame(spark, rows), anchors_each=10))
    assert sorted_rows(got) == sorted_rows(plain(rows, each=10)) and got


def test_odd_vectors(spark):
    rng, nan, inf = random.Random(4), float("nan"), float("inf")
    rows = [(100 * k, [rng.uniform(-1, 1) for _ in range(4)], k % 2) for k in range(30)]
    rows += [
        (None, [0.5, 0.5, 0.5, 0.5], 0), (None, [0.4, 0.4, 0.4, 0.4], 1), (100, None, 1),
        (200, [1.0, None, 0.0, 0.0], 1), (200, [nan, 0.0, 0.0, 0.0], 1), (200, [inf] * 4, 0),
        (300, [0.5] * 4, None), (300, [], 0), (400, [], 1), (500, [0.0] * 4, 0),
        (600, [1.0, 2.0], 0), (601, [1.0, 2.0], 0), (602, [0.5, 1.0], 1), (700, [1e308] * 4, 1),
        (800, [1e15, -1e15, 3e14, 0.1], 0), (801, [1e15, -1e15, 1e3, 0.0], 0),
        (802, [9e13, -9e13, 0.0, 0.0], 1), (900, [1e200, 0.0, 0.0, 0.0], 0)]
    got = rows_of(negatives.mined(frame(spark, rows)))
    assert sorted_rows(got) == sorted_rows(plain(rows))
    assert {300, 600, 800} <= {r[0] for r in got}
    none = negatives.mined(frame(spark, rows).where("false"))
    assert not rows_of(none) and none.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_bounds_hold_the_scores():
    rng = np.random.default_rng(1)
    for dims in (1, 5, 64):
        x = negatives.Vectors(negatives.whole_numbers(rng.normal(0, 0.2, (200, dims))))
        y = negatives.Vectors(negatives.whole_numbers(rng.normal(0, 0.2, (50, dims))))
        exact, widths = x.x @ y.x.T, []
        for level in range(2):
            middle, reach = x.middle_and_reach(level, np.arange(200), y, np.arange(50))
            assert (np.abs(exact - middle) <= reach).all()
            widths.append(reach.mean())
        assert widths[1] <= widths[0]


def test_query_equals_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(i, [float(x) for x in v], (g + 1) % 10 if i % 7 == 0 else g) for i, v, g in rows_of(
        table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))]
    got = rows_of(queries.op12_negatives(spark, folder))
    assert sorted_rows(got) == sorted_rows(plain(rows)) and got
