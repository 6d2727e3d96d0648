"""Exact substring deduplication by range-partitioned suffixes.

Every string of SPAN bytes is found by an anchor: the place inside it whose 16 leading bytes have
the least hash. Equal strings have their anchors at the same place, so only the suffixes that
start at anchors, about one in 40, are sorted. Neighbouring strings with the same anchor form its
context.

1. Sampled splitters range-partition the anchors' suffixes by their leading bytes, ties by the hash
   of the context. Each bucket is sorted by a multikey quicksort: by the first key, then only what
   is tied by the next. Of equal contexts all but the earliest are removed as a whole. A context
   whose leading bytes stand in other contexts as well has to be compared string by string, and so has
   one at the end of a bucket, whose neighbour may be in the next bucket.
2. Those contexts are fetched from the texts and meet by their leading bytes; of equal strings all
   but the earliest are removed. Contexts of very frequent leading bytes, or from the ends of
   buckets, meet string by string.
3. The removed runs are joined and cut out of the texts.

Equal contexts of one batch are reduced to the earliest before any shuffle. Strings are compared by
64-bit hashes. What moves between tasks are packed, compressed arrays.
"""

from __future__ import annotations

import struct
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import cut, n_bytes
from barlake.llm.tokens import _CODES, mixed_bits, slices

SPAN = 100
LEAD = 16
PER_BUCKET = 400_000
# Bytes of text per group of documents.
GROUP_BYTES = 4 << 20
SAMPLED_TEXTS = 2_000
SAMPLED_PER_TEXT = 200
HOT = 20_000
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
DUP, ASK, HOT_ASK = 0, 1, 2


class _Powers:
    """Powers of a factor modulo 2^64, as many as were ever needed."""

    def __init__(self, factor: int):
        self.factor, self.known = np.uint64(factor), np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            more = np.full(max(n, 2 * len(self.known)), self.factor, dtype=np.uint64)
            more[0] = 1
            self.known = np.cumprod(more, dtype=np.uint64)
        return self.known[:n]


_UP, _DOWN = _Powers(_FACTOR), _Powers(_INVERSE)


def pack(*columns: np.ndarray) -> bytes:
    raw = b"".join(struct.pack("<2sq", c.dtype.str[1:].encode(), len(c)) + c.tobytes()
                   for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        kind, n = struct.unpack_from("<2sq", raw, at)
        column = np.frombuffer(raw, dtype="<" + kind.decode(), count=n, offset=at + 10)
        out.append(column)
        at += 10 + column.nbytes
    return out


def _stacked(blobs: list[bytes]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*map(unpack, blobs), strict=True)]


def _prefix_hashes(raw: np.ndarray) -> np.ndarray:
    return np.concatenate(([np.uint64(0)], np.cumsum(_CODES[raw] * _UP.upto(len(raw)),
                                                     dtype=np.uint64)))


def _range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed_bits((sums[ends] - sums[starts]) * _DOWN.upto(len(sums))[starts])


def anchors(text: bytes):
    """Per anchor: leading bytes as two numbers, hash of the context, start of its first string
    and number of its strings."""
    raw = np.frombuffer(text, dtype=np.uint8)
    n, last = len(raw), len(raw) - LEAD + 1
    word = np.zeros(n - 7, dtype=np.uint64)
    for b in range(8):
        word = word << np.uint64(8) | raw[b:n - 7 + b]
    first, second = word[:last], word[8:8 + last]
    order = mixed_bits(mixed_bits(first) + second)
    low = np.uint64(32)
    # Hash above, place below: the minimum is the leftmost of the least hashes.
    least = order >> low << low | np.arange(last, dtype=np.uint64)
    width, wanted = 1, SPAN - LEAD + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = wanted - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.concatenate((start, [len(at)])))
    at = at[start]
    context = _range_hashes(_prefix_hashes(raw), start, start + count + SPAN - 1)
    context = mixed_bits(context + (at - start).astype(np.uint64) * np.uint64(1009)
                         + count.astype(np.uint64))
    return first[at], second[at], context, start.astype(np.int32), count.astype(np.int32)


def multikey_order(keys: list[np.ndarray]) -> np.ndarray:
    """Sorted order by the keys in turn; each key is looked at only where the ones before tie."""
    order = np.argsort(keys[0], kind="stable")
    head = np.concatenate(([True], np.diff(keys[0][order]) != 0)) if len(order) else order
    for key in keys[1:]:
        tied = ~head
        tied[:-1] |= ~head[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        run = np.cumsum(head[at])
        inner = np.lexsort((key[order[at]], run))
        order[at] = order[at][inner]
        sorted_key = key[order[at]]
        head[at] |= np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    return order


def _group_of(doc: np.ndarray, text: np.ndarray, groups: int) -> np.ndarray:
    return (mixed_bits(doc.astype(np.uint64) * np.uint64(31) + text.astype(np.uint64))
            % np.uint64(groups)).astype(np.int64)


def _split(by: np.ndarray, columns: list[np.ndarray]):
    """(value, columns) per value of ``by``."""
    order = np.argsort(by, kind="stable")
    cuts = np.flatnonzero(np.diff(by[order])) + 1
    parts = [np.split(c[order], cuts) for c in columns]
    for k, value in enumerate(by[order][np.concatenate(([0], cuts))] if len(by) else []):
        yield int(value), [p[k] for p in parts]


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({"g": pa.array([r[0] for r in rows], pa.int64()),
                     "kind": pa.array([r[1] for r in rows], pa.int64()),
                     "data": pa.array([r[2] for r in rows], pa.binary())})


_PACKED = "g long, kind long, data binary"


def _texts(batch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _buckets(splitters: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
    """Number of splitters that are not above each row."""
    n = len(splitters[0])
    keys = [np.concatenate((s, r)) for s, r in zip(splitters, rows, strict=True)]
    is_row = np.concatenate((np.zeros(n, dtype=bool), np.ones(len(rows[0]), dtype=bool)))
    order = np.lexsort((is_row, keys[2], keys[1], keys[0]))
    below = np.cumsum(~is_row[order])
    out = np.empty(len(order), dtype=np.int64)
    out[order] = below
    return out[n:]


def _later(head: np.ndarray, *place: np.ndarray) -> np.ndarray:
    """Which sorted records lie elsewhere than the first of their context (of which ``head`` is
    true). Those at its very place come from a repeated row, which is the same document."""
    first = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    return np.any([x != x[first] for x in place], axis=0)


def _dealt(docs: DataFrame, splitters, groups: int) -> DataFrame:
    """Anchors packed by bucket; runs that equal an earlier one of the batch go by group of
    documents, with a negative number."""
    def run(batches):
        for batch in slices(batches):
            doc = batch.column("doc").to_numpy()
            mark = batch.column("mark").to_numpy()
            found = [(i, anchors(t)) for i, t in enumerate(_texts(batch)) if len(t) >= SPAN]
            if not found:
                continue
            index = np.concatenate([np.full(len(a[0]), i) for i, a in found])
            first, second, context, start, count = (
                np.concatenate([a[k] for _, a in found]) for k in range(5))
            d, c = doc[index], mark[index]
            order = np.lexsort((start, c, d, context))
            head = np.concatenate(([True], context[order][1:] != context[order][:-1]))
            again = order[_later(head, d[order], c[order], start[order])]
            rows = [(-1 - g, DUP, pack(*part)) for g, part in _split(
                _group_of(d[again], c[again], groups), [x[again] for x in (d, c, start, count)])]
            kept = order[head]
            columns = [x[kept] for x in (first, second, context, d, c, start, count)]
            rows += [(g, ASK, pack(*part)) for g, part in _split(
                _buckets(splitters.value, columns[:3]), columns)]
            yield from _table(rows).to_batches()

    return docs.mapInArrow(run, _PACKED)


def _sorted_bucket(key, rows: pa.Table, groups: int, meets: int, hot: int) -> pa.Table:
    """Runs to remove, and contexts to compare, packed by group of documents."""
    blobs = rows["data"].to_pylist()
    if key[0].as_py() < 0:
        return _table([(-1 - key[0].as_py(), DUP, b) for b in blobs])
    first, second, context, d, c, start, count = _stacked(blobs)
    order = multikey_order([first, second, context, d, c, start])
    first, second, context, d, c, start, count = (
        x[order] for x in (first, second, context, d, c, start, count))
    lead = np.concatenate(([True], (np.diff(first) != 0) | (np.diff(second) != 0)))
    head = lead | np.concatenate(([True], np.diff(context) != 0))
    again = _later(head, d, c, start)
    rows = [(g, DUP, pack(*part)) for g, part in _split(
        _group_of(d[again], c[again], groups), [x[again] for x in (d, c, start, count)])]
    number = np.cumsum(lead) - 1
    classes = np.bincount(number, head)[number]
    # The leading bytes at both ends may go on in the next bucket.
    end = (number == 0) | (number == number[-1])
    meet = (mixed_bits(mixed_bits(first) + second) % np.uint64(meets)).astype(np.int64)
    for kind, chosen in ((ASK, head & ~end & (classes > 1) & (classes <= hot)),
                         (HOT_ASK, head & (end | (classes > hot)))):
        rows += [(g, kind, pack(*part)) for g, part in _split(
            _group_of(d[chosen], c[chosen], groups),
            [x[chosen] for x in (d, c, start, count, meet)])]
    return _table(rows)


def _grouped_texts(docs: DataFrame, groups: int) -> DataFrame:
    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches):
            doc, mark = batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(_group_of(doc, mark, groups)), batch.column("doc_id"),
                 batch.column("doc"), batch.column("mark"),
                 pa.array([press.compress(t) for t in _texts(batch)], pa.binary())],
                ["g", "doc_id", "doc", "mark", "packed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"g long, doc_id {kind}, doc long, mark long, packed binary")


def _contexts(texts: pa.Table, asked: pa.Table, groups: int, meets: int) -> pa.Table:
    """The bytes of the asked contexts, packed by where they meet; strings that equal an earlier
    one here go by group of documents, with a negative number."""
    wanted = defaultdict(list)
    for kind, blob in zip(asked["kind"].to_pylist(), asked["data"].to_pylist(), strict=True):
        if kind != DUP:
            d, c, start, count, meet = unpack(blob)
            for k in range(len(d)):
                wanted[int(d[k]), int(c[k])].append(
                    (int(start[k]), int(count[k]), int(meet[k]), kind))
    out: dict[int, list] = defaultdict(list)
    single: list[tuple] = []
    press = zstandard.ZstdDecompressor()
    docs = zip(texts["doc"].to_pylist(), texts["mark"].to_pylist(), range(len(texts)), strict=True)
    for d, c, k in sorted(docs):
        # Repeated rows are the same document.
        asks = wanted.pop((d, c), [])
        if not asks:
            continue
        raw = np.frombuffer(press.decompress(texts["packed"][k].as_py()), dtype=np.uint8)
        sums = _prefix_hashes(raw) if any(a[3] == HOT_ASK for a in asks) else None
        for start, count, meet, kind in sorted(asks):
            if kind == ASK:
                out[meet].append((d, c, start, raw[start:start + count + SPAN - 1]))
            else:
                at = np.arange(start, start + count)
                single.append((_range_hashes(sums, at, at + SPAN), np.full(count, d),
                               np.full(count, c), at,
                               [raw[s:s + SPAN] for s in range(start, start + count)]))
    rows = []
    if single:
        strings, d, c, s = (np.concatenate([x[i] for x in single]) for i in range(4))
        raws = [r for x in single for r in x[4]]
        order = np.lexsort((s, c, d, strings))
        again = np.concatenate(([False], strings[order][1:] == strings[order][:-1]))
        # Only the earliest of equal strings goes on; the others are known already.
        known = order[again]
        rows += [(-1 - g, DUP, pack(*part)) for g, part in _split(
            _group_of(d[known], c[known], groups),
            [d[known], c[known], s[known].astype(np.int32), np.ones(len(known), np.int32)])]
        for k in order[~again].tolist():
            out[int(strings[k]) % meets].append((int(d[k]), int(c[k]), int(s[k]), raws[k]))
    for meet, records in out.items():
        d, c, s = (np.array([r[i] for r in records], dtype=np.int64) for i in range(3))
        sizes = np.array([len(r[3]) for r in records], dtype=np.int64)
        rows.append((meet, ASK, pack(d, c, s, sizes, np.concatenate([r[3] for r in records]))))
    return _table(rows)


def _compared(key, rows: pa.Table, groups: int) -> pa.Table:
    """Of equal strings all but the earliest, as runs to remove."""
    blobs = rows["data"].to_pylist()
    if key[0].as_py() < 0:
        return _table([(-1 - key[0].as_py(), DUP, b) for b in blobs])
    d, c, start, sizes, raw = _stacked(blobs)
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    count = sizes - SPAN + 1
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(begins, count) + within
    strings = _range_hashes(_prefix_hashes(raw), at, at + SPAN)
    d, c, s = np.repeat(d, count), np.repeat(c, count), np.repeat(start, count) + within
    order = np.lexsort((s, c, d, strings))
    same = strings[order][1:] == strings[order][:-1]
    again = order[np.concatenate(([False], same))]
    order = again[np.lexsort((s[again], c[again], d[again]))]
    d, c, s = d[order], c[order], s[order]
    # Strings side by side are one run.
    head = np.concatenate(([True], (np.diff(d) != 0) | (np.diff(c) != 0) | (np.diff(s) > 1)))
    head = head[:len(d)]
    first = np.flatnonzero(head)
    last = np.concatenate((first[1:], [len(d)])) - 1 if len(d) else first
    length = s[last] - s[first] + 1
    columns = [d[first], c[first], s[first].astype(np.int32), length.astype(np.int32)]
    return _table([(g, DUP, pack(*part)) for g, part in _split(
        _group_of(columns[0], columns[1], groups), columns)])


def _removed(texts: pa.Table, runs: pa.Table) -> pa.Table:
    """Per document: its bytes, the removed runs and what is left."""
    own = defaultdict(list)
    for kind, blob in zip(runs["kind"].to_pylist(), runs["data"].to_pylist(), strict=True):
        if kind == DUP:
            d, c, start, count = unpack(blob)
            for (doc, mark), (s, n) in _by_document(d, c, start, count):
                own[doc, mark].append((s, n))
    press = zstandard.ZstdDecompressor()
    spans, kept, sizes = [], [], []
    for d, c, packed in zip(texts["doc"].to_pylist(), texts["mark"].to_pylist(),
                            texts["packed"].to_pylist(), strict=True):
        raw = press.decompress(packed)
        found = own.get((d, c))
        pieces, at, merged = [], 0, []
        if found:
            start = np.concatenate([f[0] for f in found]).astype(np.int64)
            end = start + np.concatenate([f[1] for f in found]) + SPAN - 1
            order = np.argsort(start, kind="stable")
            start, end = start[order], np.maximum.accumulate(end[order])
            head = np.concatenate(([True], start[1:] > end[:-1]))
            tail = np.concatenate((head[1:], [True]))
            merged = list(zip(start[head].tolist(), end[tail].tolist(), strict=True))
        for s, e in merged:
            pieces.append(raw[at:s])
            at = e
        sizes.append(len(raw))
        spans.append([list(x) for x in merged])
        kept.append(b"".join([*pieces, raw[at:]]))
    return pa.table({"doc_id": texts["doc_id"], "n_bytes": pa.array(sizes, pa.int64()),
                     "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                     "kept": pa.array(kept, pa.binary())})


def _by_document(d, c, start, count):
    order = np.lexsort((c, d))
    d, c, start, count = d[order], c[order], start[order], count[order]
    cuts = np.flatnonzero((np.diff(d) != 0) | (np.diff(c) != 0)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(d)], strict=True):
        if hi > lo:
            yield (int(d[lo]), int(c[lo])), (start[lo:hi], count[lo:hi])


def _splitters(docs: DataFrame, buckets: int, texts: int) -> list[np.ndarray]:
    """Anchors of a bounded sample of texts, at even distances in sorted order."""
    def run(batches):
        for batch in batches:
            rows = []
            for t in _texts(batch):
                if len(t) >= SPAN:
                    found = anchors(t)[:3]
                    step = 1 + len(found[0]) // SAMPLED_PER_TEXT
                    rows.append((0, ASK, pack(*[x[::step] for x in found])))
            yield from _table(rows).to_batches()

    share = min(1.0, SAMPLED_TEXTS / max(texts, 1))
    blobs = docs.sample(share, seed=3).mapInArrow(run, _PACKED).select("data").toArrow()
    if not len(blobs):
        return [np.zeros(0, dtype=np.uint64)] * 3
    keys = _stacked(blobs["data"].to_pylist())
    order = multikey_order(keys)
    at = order[np.unique(np.arange(1, buckets) * len(order) // buckets)]
    return [k[at] for k in keys]


def deduplicated(docs: DataFrame, per_bucket: int = PER_BUCKET, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of each row of ``docs`` (doc_id, text).

    A byte is removed if a string of SPAN bytes over it also starts earlier: in a document with a
    smaller id, or before in the same one. ``spans`` are the maximal removed runs as [start, end),
    ``kept`` the other bytes (which need not be whole characters). A null text is empty. Documents
    without an id come before all others; those with the same id are ordered by a digest of
    their texts; equal rows are one document, with the same result for each.
    """
    spark = docs.sparkSession
    # 64 bits that nobody can make equal for two texts of one id.
    digest = F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 16)
    mark = F.conv(digest, 16, -10).cast("long")
    least = F.lit(-(1 << 63)).cast("long")
    docs = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), least).alias("doc"),
                       mark.alias("mark"), "text")
    texts, size = docs.agg(F.count("*"), F.sum(n_bytes(F.col("text")))).first()
    size = size or 0
    groups = 1 + size // GROUP_BYTES
    buckets = 1 + size // 40 // per_bucket
    meets = 1 + size // 40 // 50_000
    splitters = spark.sparkContext.broadcast(_splitters(docs, buckets, texts))
    sorted_out = cut(
        _dealt(docs, splitters, groups).groupBy("g")
        .applyInArrow(lambda key, rows: _sorted_bucket(key, rows, groups, meets, hot), _PACKED)
    )
    grouped = _grouped_texts(docs, groups)
    asked = sorted_out.where(F.col("kind") != DUP).select(F.col("g").alias("h"), "kind", "data")
    met = grouped.groupBy("g").cogroup(asked.groupBy("h")).applyInArrow(
        lambda one, two: _contexts(one, two, groups, meets), _PACKED)
    compared = met.groupBy("g").applyInArrow(
        lambda key, rows: _compared(key, rows, groups), _PACKED)
    runs = sorted_out.where(F.col("kind") == DUP).union(compared).select(
        F.col("g").alias("h"), "kind", "data")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return grouped.groupBy("g").cogroup(runs.groupBy("h")).applyInArrow(
        _removed, f"doc_id {kind}, n_bytes long, spans array<array<long>>, kept binary")
