"""Periodic runs against a plain search over every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_cases import BLANK, counted, no_documents, odd_documents, rows_of

from barlake.llm import periods, queries
from barlake.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def plain_runs(w):
    """(start, length, period) of all runs, by looking at every period."""
    out, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        begin = None
        for i in range(n - q + 1):
            same = i < n - q and w[i] == w[i + q]
            if same and begin is None:
                begin = i
            if not same and begin is not None:
                end = i + q
                if end - begin >= max(6, 4 * q):
                    out.setdefault((begin, end), q)  # the smallest period of the stretch
                begin = None
    return sorted((s, e - s, q) for (s, e), q in out.items())


def collapsed(w, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in drop)


def planted(i, text):
    w = BLANK.findall(text or "")
    if i is not None and w:
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    return w


def expected(i, text):
    w = planted(i, text)
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (i, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed(w, runs).encode()).hexdigest())


def _random_words(rng):
    letters = "ab" if rng.random() < 0.5 else "abcdefgh"
    w = []
    while len(w) < rng.randrange(1, 120):
        base = [rng.choice(letters) for _ in range(rng.randrange(1, 9))]
        w += base * rng.choice((1, 1, 2, 4, 5, 9)) + base[:rng.randrange(len(base))]
    return w


def test_runs_equal_a_search_over_all_periods():
    rng = random.Random(3)
    texts = [_random_words(rng) for _ in range(400)]
    numbers, firsts, _ = periods.word_numbers([" ".join(t).encode() for t in texts])
    start, end, period = periods.periodic_runs(numbers, firsts)
    got = sorted(zip(start.tolist(), (end - start).tolist(), period.tolist(), strict=True))
    want = [(s + int(firsts[k]), n, q) for k, t in enumerate(texts) for s, n, q in plain_runs(t)]
    assert got == sorted(want) and len(want) > 300


def test_a_text_of_one_word_is_one_run():
    numbers = np.zeros(100_000, np.int64)
    found = periods.periodic_runs(numbers, np.array([0, 100_000]))
    assert [x.tolist() for x in found] == [[0], [100_000], [1]]
    with pytest.raises(ValueError):
        periods.periodic_runs(numbers, np.array([0, 100_000]), least_periods=3)


def test_words_are_parted_in_pieces(monkeypatch):
    monkeypatch.setattr(periods, "PIECE_BYTES", 5)
    texts = ["", " \x0b\f", "a bb\tccc\x1cd  Größe\n a " + "x" * 40 + " bb b"]
    numbers, firsts, names = periods.word_numbers([t.encode() for t in texts])
    got = [[names[i].decode() for i in numbers[a:b]] for a, b in zip(firsts, firsts[1:], strict=False)]
    assert got == [BLANK.findall(t) for t in texts]


def test_query_equals_plain_version(spark):
    got = rows_of(queries.op13_periods(spark, FOLDER))
    docs = rows_of(table(spark, FOLDER, "documents").select("doc_id", "text"))
    assert sorted(got) == sorted(expected(*d) for d in docs)
    assert any(r[1] for r in got)


def test_runs_of_odd_documents(spark):
    docs = odd_documents(spark, ["go " * 6, "go " * 5, "a b a b a b a b", "A a A a A a A a a a a a a a"])
    found = periods.with_runs(docs)
    assert found.columns[:-2] == docs.columns and found.count() == docs.count()
    for r in found.collect():
        w = BLANK.findall(r["text"] or "")
        runs = plain_runs(w) if len(w) < 5000 else [tuple(x) for x in r["__runs"]]
        assert [tuple(x) for x in r["__runs"]] == runs
        assert r["__collapsed"] == collapsed(w, runs)
    assert not counted(periods.with_runs(no_documents(spark)))
    kept = periods.planted(docs)
    assert kept.columns == docs.columns
    got = [(i, BLANK.findall(t or "")) for i, t in rows_of(kept.select("doc_id", "text"))]
    want = [(i, planted(i, t)) for i, t in rows_of(docs.select("doc_id", "text"))]
    assert sorted(map(str, got)) == sorted(map(str, want))
