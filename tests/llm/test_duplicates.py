"""Components, n-gram Jaccard join, exact substrings and embeddings."""

import contextlib
import gc
import hashlib
import os
import random
import threading
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import Groups, near_groups, no_documents, odd_documents, rows_of, shingles

from barlake.llm import embeddings, jaccard, queries, suffixes
from barlake.llm.components import components

FOLDER = "/root/testdata/sf0.001"
EDGE = st.tuples(st.integers(0, 30), st.integers(0, 30))


@settings(max_examples=12, deadline=None)
@given(st.lists(EDGE, max_size=40))
def test_components_equal_union_find(spark, edges):
    groups = Groups()
    for a, b in edges:
        groups.join(a, b)
    df = spark.createDataFrame([*edges, (None, 1)], "a long, b long")
    got = dict(rows_of(components(df)))
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: groups.find(x) for x in nodes}


def test_a_long_chain_is_one_component(spark):
    order = list(range(400))
    random.Random(5).shuffle(order)
    df = spark.createDataFrame(list(zip(order, order[1:], strict=False)), "a long, b long")
    got = rows_of(components(df))
    assert len(got) == 400 and {c for _, c in got} == {0}


def _texts(rng, n=60, length=40):
    """Groups of copies, near copies of them, and texts that share passages."""
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [rng.choice(vocabulary) for _ in range(25)]
    out = []
    for _ in range(n // 6):
        base = [rng.choice(vocabulary) for _ in range(length)]
        out.append(base)
        for k in range(4):
            copy = list(base)
            for _ in range(k % 3):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(copy)
        out.append(base[:10] + passage)
    return [" ".join(t) for t in out]


@pytest.mark.parametrize("width, num, den", [(3, 90, 100), (5, 80, 100), (1, 70, 100)])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, width, num, den):
    monkeypatch.setattr(jaccard, "BLOCK", 4)  # many tiles
    texts = _texts(random.Random(width)) + ["one two", "ONE\ttwo", "one", "a b c d e", ""]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {d: (n, c) for d, n, c in rows_of(jaccard.near_duplicates(docs, width, num, den))}
    assert got == near_groups(rows, width, num, den)
    kept = jaccard.without_duplicates(docs, width, num, den)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({
        c for _, c in got.values()})


def test_a_prefix_shares_enough_with_any_similar_set():
    rng = np.random.default_rng(2)
    repeats = np.zeros(1 << jaccard.SKETCH_BITS)
    repeats[rng.integers(0, len(repeats), 60_000)] = rng.integers(1, 5000, 60_000)
    for _ in range(300):
        n = int(rng.integers(9, 200))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) << np.uint64(1))
        drop, add = rng.integers(0, max(1, len(a) // 15), 2)
        b = np.unique(np.concatenate((a[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64))))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 90 * (len(a) + len(b) - both):
            (pa, la), (pb, lb) = (jaccard.prefix(s, repeats, 90, 100) for s in (a, b))
            assert len(np.intersect1d(pa, pb)) >= min(la, lb)


def test_jaccard_query_on_the_table(spark):
    rows = rows_of(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in queries.op6_jaccard(spark, FOLDER).collect()}
    assert got == near_groups(rows, 3, 90, 100)


def test_jaccard_of_odd_documents(spark):
    docs = odd_documents(spark)
    got = rows_of(jaccard.near_duplicates(docs, 3, 90, 100))
    assert len(got) == docs.count()
    by_id = {d: c for d, n, c in got if d is not None}
    # Both texts of id 1 are one document, and 9 is a copy of the first.
    assert by_id == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 1}
    assert sorted(n for d, n, _ in got if d is None) == [0, 3, 3]
    assert all(c is None for d, _, c in got if d is None)
    kept = jaccard.without_duplicates(docs, 3, 90, 100)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], shingles(r["text"], 3)) for r in kept.collect()]
    # One row of each group; texts without words all stay, repeated rows once.
    assert sorted(str(d) for d, _ in left) == sorted(
        ["1", "1", "None", "None", "2", "3", "4", "5", "7", "8"])
    assert jaccard.near_duplicates(no_documents(spark), 3, 90, 100).count() == 0
    assert jaccard.without_duplicates(no_documents(spark), 3, 90, 100).count() == 0


def test_jaccard_of_near_copies_without_an_id(spark):
    base, other = ([f"{c}{i}" for i in range(100)] for c in "ab")

    def text(words, *ends):
        return " ".join([*words[len(ends):], *ends])

    # 7 and 3 are near to the text between them only.
    rows = [(7, text(base)), (None, text(base, "x", "y", "z")),
            (3, text(base[3:] + ["x", "y", "z", "t", "u", "v", "w"])),
            (None, text(other)), (None, text(other, "x")), (None, text(other, "x")),
            (9, "one two three four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(rows_of(jaccard.near_duplicates(docs, 3, 90, 100)), key=str)
    assert got == sorted([(7, 98, 3), (None, 98, 3), (3, 102, 3), (None, 98, None),
                          (None, 98, None), (None, 98, None), (9, 2, 9)], key=str)


def plain_substrings(rows):
    """doc_id -> (bytes, runs, hash of what is left), for rows in order."""
    seen, out = set(), {}
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - suffixes.SPAN + 1):
            piece = raw[s:s + suffixes.SPAN]
            if piece in seen:
                gone[s:s + suffixes.SPAN] = b"\1" * suffixes.SPAN
            seen.add(piece)
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        runs = len([r for r in bytes(gone).split(b"\0") if r])
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def _digest(rows):
    return {r["doc_id"]: (r["n_bytes"], sum(e - s for s, e in r["spans"]), len(r["spans"]),
                          hashlib.sha256(r["kept"]).hexdigest()) for r in rows}


@pytest.mark.parametrize("options", [{}, {"per_bucket": 20}, {"hot": 1}, {"per_bucket": 7, "hot": 0}])
def test_substrings_equal_brute_force(spark, options):
    rng = random.Random(4)

    def noise(n):
        return "".join(rng.choice("abcdé日 ") for _ in range(n))

    passages = [noise(n) for n in (60, 99, 100, 101, 150, 400, 1000)]
    rows = [(i, noise(rng.randrange(300)) + rng.choice(passages) + noise(rng.randrange(40)) +
             rng.choice(passages)) for i in range(60)]
    rows += [(60 + i, "ab" * 300) for i in range(3)] + [(70, "x" * 99), (71, "x" * 99),
                                                        (72, "y" * 1000), (73, None), (74, "")]
    rows += [(80, passages[6]), (81, passages[6]), (82, "z" + passages[6][:120])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = _digest(suffixes.deduplicated(docs, **options).collect())
    assert got == plain_substrings(rows)


def test_substring_query_on_the_table(spark):
    rows = rows_of(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text"))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in queries.op3_suffixes(spark, FOLDER).collect()}
    assert got == plain_substrings(sorted(rows))


def test_substrings_of_odd_documents(spark):
    docs = odd_documents(spark)
    rows = suffixes.deduplicated(docs).collect()
    assert len(rows) == docs.count()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["n_bytes"], r["spans"]))
    assert got[2] == [(0, [])] and got[3] == [(0, [])] and len(got[1]) == 3
    # The long text is repetitive itself; its copy goes as a whole.
    assert got[6] == [(got[5][0][0], [[0, got[5][0][0]]])]
    assert suffixes.deduplicated(no_documents(spark)).count() == 0


@pytest.mark.parametrize("parts", [1, 2])
def test_a_repeated_row_keeps_its_text(spark, parts):
    rng = random.Random(8)
    once, bare, own = ("".join(rng.choice("abcdefgh ") for _ in range(300)) for _ in range(3))
    rows = [(1, once), (None, bare), (2, own + once[:150])]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows * 2, parts),
                                 "doc_id long, text string")
    got = suffixes.deduplicated(docs).collect()
    assert len(got) == 6
    for i, kept, spans in ((1, once, []), (None, bare, []), (2, own, [[300, 450]])):
        assert [(bytes(r["kept"]).decode(), r["spans"]) for r in got if r["doc_id"] == i] == [
            (kept, spans)] * 2


def test_multikey_order_sorts_by_all_keys():
    rng = np.random.default_rng(0)
    keys = [rng.integers(0, 4, 500) for _ in range(4)]
    order = suffixes.multikey_order(keys)
    rows = list(zip(*[k[order] for k in keys], strict=True))
    assert rows == sorted(rows)
    assert len(suffixes.multikey_order([np.zeros(0, int)] * 2)) == 0


def _plain_vectors(rows, threshold=0.98):
    """Per row (links, smallest id) in double precision."""
    units = []
    for _, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links, groups = [0] * len(rows), Groups()
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a is not None and b is not None and rows[i][2] == rows[j][2] \
                    and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                groups.join(i, j)
    least = {}
    for i, row in enumerate(rows):
        root = groups.find(i)
        if row[0] is not None:
            least[root] = min(least.get(root, row[0]), row[0])
    return [(n, least.get(groups.find(i))) for i, n in enumerate(links)]


@pytest.mark.parametrize("dims", [1, 2, 3, 7, 64])
def test_vectors_equal_brute_force(spark, monkeypatch, dims):
    monkeypatch.setattr(embeddings, "BLOCK", 5)
    monkeypatch.setattr(embeddings, "PER_DIRECTION", 8)
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(60, dims))
    noise = rng.normal(size=(240, dims)) * rng.choice([0, 0.05, 0.1, 0.15, 0.2], (240, 1))
    x = base[rng.integers(0, 60, 240)] + noise * np.linalg.norm(base[0]) / dims ** 0.5
    rows = [(i, [float(np.float32(v)) for v in row], i % 3) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["id"]: (r["n_links"], r["component"])
           for r in embeddings.near_vectors(df).collect()}
    assert got == dict(enumerate(_plain_vectors(rows)))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1),
            (4, [1.0, 0.0], None), (5, [1.0, 0.0], 2), (6, [0.0, 0.0], 1), (7, None, 1),
            (8, [], 1), (9, [1.0, None], 1), (10, [nan, 1.0], 1), (11, [1.0, inf], 1),
            (12, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 1),
            (13, [-1.0, 0.0], 1)]
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS node", "2 AS vec", "3 AS cell")
    got = sorted(map(str, rows_of(embeddings.near_vectors(df))))
    assert got == sorted(str((r[0], *p)) for r, p in zip(rows, _plain_vectors(rows), strict=True))
    assert embeddings.near_vectors(df.where("false")).count() == 0
    assert embeddings.near_vectors(df.where("label IS NULL")).count() == 1


def test_vector_query_on_the_table(spark):
    rows = rows_of(spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select(
        "vec_id", "embedding", "label"))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    x = {r[0]: np.array(r[1], float) for r in rows}
    got = {r["id"]: r["n_links"] for r in embeddings.near_vectors(df).collect()}
    expected = {}
    for label in sorted({r[2] for r in rows}):
        ids = [r[0] for r in rows if r[2] == label]
        units = np.array([x[i] / np.linalg.norm(x[i]) for i in ids])
        expected |= dict(zip(ids, ((units @ units.T) >= 0.98).sum(axis=1) - 1, strict=True))
    assert got == expected


def test_vectors_of_extreme_length(spark):
    rows = [(k, v, 1) for k, v in enumerate((
        [1e-200, 0.0], [2e-200, 0.0], [1e200, 0.0], [2e200, 0.0], [0.0, 5e-324], [0.0, 1e308],
        [1e-160, 1e-160], [1e300, 1e300], [1.0, 0.1], [-1e250, 0.0]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(rows_of(embeddings.near_vectors(df)))
    # 8 is 5.7 degrees off the first four.
    assert got == [(0, 4, 0), (1, 4, 0), (2, 4, 0), (3, 4, 0), (4, 1, 4), (5, 1, 4), (6, 1, 6),
                   (7, 1, 6), (8, 4, 0), (9, 0, 9)]


def test_vectors_of_large_and_small_families_in_several_rounds(spark, monkeypatch):
    for name, value in (("BLOCK", 6), ("PER_DIRECTION", 10), ("PER_ROUND", 1)):
        monkeypatch.setattr(embeddings, name, value)
    rng = np.random.default_rng(5)
    rows = []
    # (label, length, vectors, bases): a crowd round one base, large, small and single families.
    for label, dims, n, bases in ((1, 8, 90, 30), (1, 5, 70, 1), (2, 8, 60, 12), (3, 8, 6, 2),
                                  (4, 8, 7, 2), (5, 8, 1, 1), (None, 8, 5, 1)):
        base = rng.normal(size=(bases, dims))
        x = base[rng.integers(0, bases, n)] + rng.normal(size=(n, dims)) * rng.choice(
            [0, 0.02, 0.2], (n, 1))
        rows += [[len(rows) + i, [float(np.float32(v)) for v in row], label]
                 for i, row in enumerate(x)]
    # The same vectors under another label do not link to these.
    rows += [[len(rows) + i, row[1], 9] for i, row in enumerate(rows[:40])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    turns = []
    sent = embeddings._sent
    monkeypatch.setattr(embeddings, "_sent", lambda *a: turns.append(a[3]) or sent(*a))
    got = {r["id"]: (r["n_links"], r["component"])
           for r in embeddings.near_vectors(df).collect()}
    assert got == dict(enumerate(_plain_vectors(rows)))
    assert len(turns) > 2


def test_vectors_take_little_disk(spark, tmp_path):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(
        np.random.default_rng(6).normal(size=(8000, 64)).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.repartition(4).write.parquet(f"{tmp_path}/embeddings")
    df = spark.read.parquet(f"{tmp_path}/embeddings")
    embeddings.near_vectors(df.limit(1)).count()  # sets the checkpoint folder
    jvm = spark.sparkContext._jvm
    tops = [*jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
            .localDirsString(), spark.sparkContext.getCheckpointDir().removeprefix("file:")]

    def taken():
        total = 0
        for top in tops:
            for folder, _, files in os.walk(top):
                for f in files:
                    with contextlib.suppress(OSError):
                        total += os.path.getsize(f"{folder}/{f}")
        return total

    gc.collect()
    jvm.System.gc()
    time.sleep(1)
    before, most, over = taken(), [0], threading.Event()

    def watch():
        while not over.wait(0.02):
            most[0] = max(most[0], taken())

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        found = embeddings.near_vectors(df).count()
    finally:
        over.set()
        watching.join()
    assert found == len(rows)
    assert max(most[0], taken()) - before < 10 * 4 * 64 * len(rows)


def _forged(text: bytes, like: int) -> bytes:
    """The text with four bytes at its end that give it the checksum ``like``."""
    table = [0] * 256
    for n in range(256):
        c = n
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table[n] = c
    back = {table[n] >> 24: n for n in range(256)}
    want, state = like ^ 0xFFFFFFFF, zlib.crc32(text) ^ 0xFFFFFFFF
    places, value = [], want
    for _ in range(4):
        n = back[value >> 24]
        places.append(n)
        value = (value ^ table[n]) << 8 & 0xFFFFFFFF
    out = b""
    for n in reversed(places):
        byte = (state ^ n) & 0xFF
        out += bytes([byte])
        state = state >> 8 ^ table[n]
    return text + out


@pytest.mark.parametrize("id_", [None, 7])
def test_texts_of_equal_checksum_are_told_apart(spark, id_):
    rng = random.Random(8)
    half = "".join(rng.choice("abcdefgh ") for _ in range(150))
    twice, k = half + half, 0
    while True:
        # Four bytes that are text.
        plain = "".join(rng.choice("ijklmnop ") for _ in range(304))
        forged = _forged(plain.encode(), zlib.crc32(twice.encode()))
        k += 1
        if max(forged[-4:]) < 128 and min(forged[-4:]) > 0:
            break
    other = forged.decode()
    assert zlib.crc32(other.encode()) == zlib.crc32(twice.encode()) and k < 10_000
    df = spark.createDataFrame([(id_, twice), (id_, other)], "doc_id long, text string")
    got = {r["n_bytes"]: bytes(r["kept"]).decode() for r in suffixes.deduplicated(df).collect()}
    assert got == {300: half, 308: other}
