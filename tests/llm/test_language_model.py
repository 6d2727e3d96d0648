"""The Pitman-Yor model: counts and base score against plain ones, its restaurants against
exact probabilities."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import BLANK, no_documents, odd_documents, rows_of, words

from barlake.llm import pitmanyor, queries
from barlake.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def plain(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base score) of each row."""
    tokens = [[*words(t, BLANK), None] for _, t in rows]
    count = Counter(w for (i, _), t in zip(rows, tokens, strict=True) if not held_out(i) for w in t)
    n, v = sum(count.values()), len(count)
    return [(i, held_out(i), len(t), sum(count[w] > 0 for w in t), n,
             round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 5))
            for (i, _), t in zip(rows, tokens, strict=True)]


def rounded(rows):
    return sorted(map(str, ((*r[:5], round(r[5], 5)) for r in rows)))


def test_query_counts_and_base_score(spark):
    got = rows_of(queries.op11_language_model(spark, FOLDER))
    docs = rows_of(table(spark, FOLDER, "documents").select("doc_id", "text"))
    assert rounded(got) == sorted(map(str, plain(docs)))
    base, score = (sum(r[k] for r in got if r[1]) for k in (5, 6))
    assert base < score < 0


def _small_parts(monkeypatch):
    """Many slices, buckets and split contexts."""
    for name, value in (("SLICE_BYTES", 3000), ("WORD_BUCKET_BYTES", 60_000),
                        ("PAIR_BUCKET_BYTES", 40_000), ("CONTEXT_TOKENS", 40)):
        monkeypatch.setattr(pitmanyor, name, value)


def test_cut_into_small_parts(spark, monkeypatch):
    docs = table(spark, FOLDER, "documents").select("doc_id", "text")
    whole = dict(rows_of(pitmanyor.scored(docs).select("doc_id", "score")))
    _small_parts(monkeypatch)
    rows = rows_of(pitmanyor.scored(docs))
    assert rounded([(r[0], held_out(r[0]), *r[1:]) for r in rows]) == sorted(
        map(str, plain(rows_of(docs))))
    # Other random draws and a coarser exchange, so near, but not equal.
    near = [abs(r[5] - whole[r[0]]) / abs(whole[r[0]]) for r in rows]
    assert max(near) < 0.05 and np.mean(near) < 0.01


def test_odd_documents(spark):
    docs = odd_documents(spark, ["a b a b", "A B a", "never seen this"])
    got = rows_of(pitmanyor.scored(docs))
    want = plain(rows_of(docs.select("doc_id", "text")))
    assert rounded([(r[0], held_out(r[0]), *r[1:]) for r in got]) == sorted(map(str, want))
    assert all(math.isfinite(r[5]) and r[5] < 0 for r in got)
    empty = {r[5] for r in got if r[1] == 1}
    assert len(empty) == 1  # nothing before the end mark: the same wherever it stands
    assert not rows_of(pitmanyor.scored(no_documents(spark)))
    untrained = rows_of(pitmanyor.scored(docs, learned=docs["doc_id"] < 0))
    assert {(r[2], r[3], r[4], r[5]) for r in untrained} == {(0, 0, 0.0, 0.0)}


def test_probabilities_add_up_to_one(spark):
    """Texts of one and no word tell p(w | begin) p(end | w) and p(end | begin); texts of two words
    whose first is w tell p(v | w) as well. Unknown words are one outcome."""
    learned = ["a b a", "b a c", "a", "", "c c a b", "b b", "a b a b a"] * 3
    names = ["a", "b", "c", "unknown"]
    asked = ["", *names, *(" ".join(x) for x in itertools.product(names, repeat=2))]
    rows = [(k, t, True) for k, t in enumerate(learned)] + [
        (1000 + k, t, False) for k, t in enumerate(asked)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mine boolean")
    found = pitmanyor.scored(docs, learned=docs["mine"])
    p = {asked[r[0] - 1000]: 10 ** r[5] for r in rows_of(found) if r[0] >= 1000}
    # p("w v") = p(w | begin) p(v | w) p(end | v), so with x(w) = p(end | w) the sums over v of
    # p("w v") / x(v) + p("w") are p(w | begin); x solves p("w") = p(w | begin) x(w).
    x = {w: 0.3 for w in names}
    for _ in range(400):
        x = {w: p[w] / (p[w] + sum(p[f"{w} {v}"] / x[v] for v in names)) for w in names}
    begin = {w: p[w] / x[w] for w in names}
    assert p[""] + sum(begin.values()) == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize("n, weight, discount", [(2, 0.7, 0.5), (5, 0.4, 0.8), (6, 2.0, 0.2)])
def test_gibbs_sampling_has_the_exact_distribution(n, weight, discount):
    """With a fixed weight of new tables, a seating's chance is that weight to the power of its
    tables, times the product of (1 - d) (2 - d) ... over their customers."""
    chance = Counter()
    for sizes in _partitions(n):
        value = weight ** len(sizes)
        for size in sizes:
            value *= math.prod(k - discount for k in range(1, size))
        chance[len(sizes)] += value * _ways(n, sizes)
    total = sum(chance.values())
    pairs = 20_000
    rng = np.random.default_rng(n)
    count = np.full(pairs, n)

    def mass(tables):
        return np.full(pairs, weight)

    seating = pitmanyor.Seating(discount, rng, np.ones(pairs), count)
    pitmanyor.reseat(seating, count, mass, 60)
    assert (np.add.reduceat(seating.sizes, seating._first()) == n).all()
    got = np.bincount(seating.tables, minlength=n + 1) / pairs
    for k in range(1, n + 1):
        assert got[k] == pytest.approx(chance[k] / total, abs=0.015)


def _partitions(n, most=None):
    most = most or n
    if n == 0:
        yield ()
    for k in range(min(n, most), 0, -1):
        for rest in _partitions(n - k, k):
            yield (k, *rest)


def _ways(n, sizes):
    ways = math.factorial(n)
    for size in sizes:
        ways //= math.factorial(size)
    for same in Counter(sizes).values():
        ways //= math.factorial(same)
    return ways


def test_customers_are_all_seated():
    rng = np.random.default_rng(3)
    count = np.concatenate((rng.integers(2, 40, 500), [100_000, 3, 2_000_000]))

    def mass(tables):
        return np.full(len(tables), 0.6)

    seating = pitmanyor.seated(count, 0.7, rng, mass)
    pitmanyor.reseat(seating, count, mass, 3)
    assert (np.add.reduceat(seating.sizes, seating._first()) == count).all()
    assert (seating.tables >= 1).all() and (seating.sizes >= 1).all()
    assert len(seating.sizes) == seating.tables.sum()


def test_packing_gives_the_numbers_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert (pitmanyor._sorted_numbers(pitmanyor._steps(x)) == x).all()
        assert (pitmanyor._numbers(pitmanyor._planes(x[::-1])) == x[::-1]).all()
    for x in ([], [0, 255], [256], [1 << 20], [1 << 40], [-1, 5], [-(1 << 40)]):
        x = np.array(x, np.int64)
        assert (pitmanyor._small(x) == x).all()
