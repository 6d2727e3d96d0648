"""Language-model scores from a hierarchical Pitman-Yor process over word pairs.

Every context word has a restaurant whose customers are the words that follow it in the training
texts, and every dish a word. All context restaurants share one parent, the root restaurant,
which gets a customer for each of their tables; the root's parent is uniform over the words and
one place for all unknown ones. Customers are seated by the Chinese restaurant process and
reseated by Gibbs sampling; a word's probability is the average over the sampled seatings.

The work is dealt out twice. Texts are gathered in slices of some megabytes, in which equal words
and equal pairs are one entry; entries go to buckets by hash, where those of all slices meet. A
bucket answers in the order in which it was asked, so answers are bare arrays. Words of long
standing as contexts are split over several buckets by the word that follows. A pair that occurs
once has one table and needs no sampling, so only the others are seated. Seating runs in passes: in
each, the buckets reseat their pairs under the root's probabilities of the pass before, then the
root is seated from the tables that they report. Restaurants learn of tables in other buckets and
of the root between passes only, the usual approximation of a sampler that is spread out.

Words are 64-bit hashes in all counts, and the first 48 bits of these in the restaurants.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.periods import pieces
from barlake.llm.suffixes import pack, unpack
from barlake.llm.tokens import Words, blank_bytes, chunks, mixed_bits, text_bytes
from barlake.session import scratch_folder

SLICE_BYTES, WORD_BUCKET_BYTES, PAIR_BUCKET_BYTES = 16 << 20, 32 << 20, 16 << 20
# A context with more training tokens is split.
CONTEXT_TOKENS = 1 << 21
PASSES, ROUNDS, SAMPLES = 2, 4, 3
STRENGTH = 1.0
# Marks beside all words: before the first and after the last word of a text.
BEGIN, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_LOW = np.uint64(16)
# Kinds of rows.
WORDS, ASKED, PAIRS, ROOT, WANTED, SEATS, ROOMS, VALUES, TEXTS, SPLIT = range(10)
_ROW = "g long, kind int, sub long, data binary, n long, m long"


def held_out(id_col: str = "doc_id") -> Column:
    """Kept out of learning; a row without an id is not."""
    left = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(7)) == 2
    return F.coalesce(left, F.lit(False))


# -- packing ---------------------------------------------------------------------------------


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them."""
    low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    kinds = ("u1", "u2", "u4", "i8") if low >= 0 else ("i1", "i2", "i4", "i8")
    return x.astype(next(k for k in kinds if np.iinfo(k).min <= low and high <= np.iinfo(k).max))


def _planes(x: np.ndarray) -> np.ndarray:
    """The bytes of unsigned numbers, lowest of all first: high ones are alike and pack well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).reshape(-1)


def _numbers(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").reshape(-1).astype(np.uint64)


def _steps(x: np.ndarray) -> np.ndarray:
    """Sorted unsigned numbers as planes of their differences."""
    return _planes(np.diff(x, prepend=x.dtype.type(0)))


def _sorted_numbers(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(_numbers(raw), dtype=np.uint64)


def _rows(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    names = ("g", "kind", "sub", "data", "n", "m")
    rows = [(*r, 0, 0)[:6] for r in rows]
    return pa.table({n: pa.array([r[k] for r in rows], t)
                     for k, (n, t) in enumerate(zip(names, kinds, strict=True))})


def _grouped(df: DataFrame, work) -> DataFrame:
    """``work`` gets a group's number and its rows by kind: lists of (sub, unpacked data, row)."""
    def run(key, table):
        kinds: dict[int, list] = {}
        for row in sorted(table.to_pylist(), key=lambda r: (r["kind"], r["sub"])):
            kinds.setdefault(row["kind"], []).append((row["sub"], row["data"]))
        return _rows(work(key[0].as_py(), kinds))

    return df.groupBy("g").applyInArrow(run, _ROW)


# -- slices of texts -------------------------------------------------------------------------


def _slices(batches):
    """(number, ids, texts, marks) of runs of rows with about SLICE_BYTES of text. A partition
    read again gives the same slices."""
    number = (TaskContext.get().partitionId() << 32) if TaskContext.get() else 0
    ids, texts, marks, size = [], [], [], 0
    for batch in batches:
        found = zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")),
                    batch.column("learned").to_pylist(), strict=True)
        for one, text, mark in found:
            if size and size + len(text) > SLICE_BYTES:
                yield number, ids, texts, np.array(marks, bool)
                ids, texts, marks, size, number = [], [], [], 0, number + 1
            ids.append(one)
            texts.append(text)
            marks.append(mark)
            size += len(text) + 16
    if ids:
        yield number, ids, texts, np.array(marks, bool)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and each value's place among them."""
    found, distinct = pd.factorize(values)
    order = np.argsort(distinct)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return distinct[order], rank[found]


class Tokens:
    """The words of some texts: ``words``, sorted, with both marks; per token its word, the word
    before and its text."""

    def __init__(self, texts: list[bytes]):
        parts, owner = [], []
        for k, text in enumerate(texts):
            own = list(pieces(text))
            parts += own
            owner += [k] * len(own)
        hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
        for begin, stop in chunks(parts):
            found = Words(parts[begin:stop], blank_bytes())
            hashes.append(found.hashes)
            np.add.at(counts, owner[begin:stop], np.diff(found.firsts))
        ends = np.cumsum(counts + 1) - 1
        dish = np.full(int(counts.sum()) + len(texts), END)
        inner = np.ones(len(dish), bool)
        inner[ends] = False
        dish[inner] = np.concatenate(hashes)
        self.words, found = _numbered(np.concatenate(([BEGIN, END], dish)))
        self.begin, self.word = found[0], found[2:]
        self.before = np.empty_like(self.word)
        self.before[1:] = self.word[:-1]
        self.before[np.concatenate(([0], ends[:-1] + 1))[:len(texts)]] = self.begin
        self.text = np.repeat(np.arange(len(texts)), counts + 1)
        self.lengths = counts + 1

    def _keys(self) -> np.ndarray:
        return self.before * len(self.words) + self.word

    def pairs(self):
        """(context, word) of the distinct pairs, sorted, and the pair of each token."""
        found, of_token = np.unique(self._keys(), return_inverse=True)
        return *np.divmod(found, len(self.words)), of_token

    def counted_pairs(self, learned: np.ndarray):
        """(context, word, count) of the distinct pairs, sorted; tokens of the texts marked as
        learned count."""
        keys = np.sort(2 * self._keys() + learned[self.text])
        found, one = keys >> 1, keys & 1
        first = np.flatnonzero(np.diff(found, prepend=-1))
        count = np.add.reduceat(one, first) if len(first) else one
        return *np.divmod(found[first], len(self.words)), count


def _word_bucket(code: np.ndarray, n: int) -> np.ndarray:
    return (code % np.uint64(n)).astype(np.int64)


def _pair_bucket(context: np.ndarray, word: np.ndarray, n: int, split) -> np.ndarray:
    """``split``: sorted codes of the split contexts, and the number of their parts."""
    bucket = mixed_bits(context)
    codes, parts = split
    if len(codes):
        at = np.minimum(np.searchsorted(codes, context), len(codes) - 1)
        mine = codes[at] == context
        bucket[mine] += mixed_bits(word[mine]) % parts[at[mine]].astype(np.uint64)
    return (bucket % np.uint64(n)).astype(np.int64)


def _dealt(bucket: np.ndarray):
    """(bucket, places) for each bucket, places in order."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for own in np.split(order, cuts) if len(order) else []:
        yield int(bucket[own[0]]), own


# -- counts ----------------------------------------------------------------------------------


def _words_of_slices(docs: DataFrame, n_words: int) -> DataFrame:
    def run(batches):
        for number, _, texts, learned in _slices(batches):
            tokens = Tokens(texts)
            count = np.bincount(tokens.word, learned[tokens.text], len(tokens.words))
            code = tokens.words >> _LOW
            yield from _rows([
                (g, ASKED, number, pack(_steps(tokens.words[own]),
                                        _small(count[own].astype(np.int64))))
                for g, own in _dealt(_word_bucket(code, n_words))]).to_batches()

    return docs.mapInArrow(run, _ROW)


def _counted_words(g: int, kinds: dict) -> list[tuple]:
    """The words of a bucket with their counts, the slices' answers (a place among these words,
    or -1), and the contexts to split."""
    asked = [(sub, *unpack(data)) for sub, data in kinds[ASKED]]
    words = [_sorted_numbers(w) for _, w, _ in asked]
    known, of = np.unique(np.concatenate(words), return_inverse=True)
    count = np.bincount(of, np.concatenate([c for _, _, c in asked])).astype(np.int64)
    seen = count > 0
    place = np.where(seen, np.cumsum(seen) - 1, -1)[of]
    known, count = known[seen], count[seen]
    out = [(g, WORDS, 0, pack(_steps(known), _small(count)), int(count.sum()), len(known))]
    ends = np.cumsum([len(w) for w in words])[:-1]
    out += [(g, ASKED, sub, pack(part.astype(np.int32)))
            for (sub, *_), part in zip(asked, np.split(place, ends), strict=True)]
    large = np.flatnonzero(count > CONTEXT_TOKENS)
    return out + [(int(known[k] >> _LOW), SPLIT, 0, None, int(count[k])) for k in large]


def _pairs_of_slices(docs: DataFrame, n_pairs: int, split) -> DataFrame:
    def run(batches):
        for number, _, texts, learned in _slices(batches):
            tokens = Tokens(texts)
            context, word, count = tokens.counted_pairs(learned)
            code = tokens.words >> _LOW
            context, word = code[context], code[word]
            rows = []
            for g, own in _dealt(_pair_bucket(context, word, n_pairs, split.value)):
                mine = context[own]
                first = np.flatnonzero(np.diff(mine, prepend=~mine[:1]) != 0)
                rows.append((g, ASKED, number, pack(
                    _steps(mine[first]), _small(np.diff(np.append(first, len(mine)))),
                    _planes(word[own]), _small(count[own]))))
            yield from _rows(rows).to_batches()

    return docs.mapInArrow(run, _ROW)


def _counted_pairs(g: int, kinds: dict, n_words: int, split) -> list[tuple]:
    """The restaurants of a bucket; answers to the slices: -1 for an unseen pair, 0 for one seen
    once, else its place, from 1 on, among those seen more often; words with a customer from
    each pair for the root; and the words whose root probability is wanted."""
    asked = [(sub, *unpack(data)) for sub, data in kinds[ASKED]]
    context = np.concatenate([np.repeat(_sorted_numbers(c), n) for _, c, n, _, _ in asked])
    word = np.concatenate([_numbers(w) for _, _, _, w, _ in asked])
    # Equal pairs by one hash of both, and only the distinct ones in order.
    of, found = pd.factorize(mixed_bits(mixed_bits(context) + word))
    first = np.empty(len(found), np.int64)
    first[of[::-1]] = np.arange(len(of))[::-1]
    context, word = context[first], word[first]
    order = np.lexsort((word, context))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    context, word, of = context[order], word[order], rank[of]
    count = np.bincount(of, np.concatenate([x for *_, x in asked])).astype(np.int64)
    many = count > 1
    place = np.where(many, np.cumsum(many), np.where(count == 1, 0, -1))[of]
    ends = np.cumsum([len(w) // 8 for _, _, _, w, _ in asked])[:-1]
    out = [(g, ASKED, sub, pack(part.astype(np.int32)))
           for (sub, *_), part in zip(asked, np.split(place, ends), strict=True)]
    seen = count > 0
    context, word, count, many = context[seen], word[seen], count[seen], many[seen]
    rooms, room = np.unique(context, return_inverse=True)
    dishes, dish = np.unique(word[many], return_inverse=True)
    by = np.lexsort((dishes, _word_bucket(dishes, n_words)))
    rank = np.empty(len(dishes), np.int64)
    rank[by] = np.arange(len(dishes))
    out.append((g, PAIRS, 0, pack(
        _steps(rooms), _small(np.bincount(room[~many], minlength=len(rooms))),
        _small(np.bincount(room[many], minlength=len(rooms))), _small(rank[dish]),
        _small(count[many]), _planes(dishes[by])),
        int((~many).sum()), int((count == 2).sum())))
    out += [(b, WANTED, g, pack(_steps(dishes[own])))
            for b, own in _dealt(_word_bucket(dishes, n_words))]
    words, of = np.unique(word, return_inverse=True)
    once = np.bincount(of[~many], minlength=len(words))
    pairs = np.bincount(of, minlength=len(words))
    of_room = np.bincount(room, minlength=len(rooms))
    out += [(int(rooms[k]), SPLIT, 0, None, int(of_room[k]))
            for k in np.flatnonzero(np.isin(rooms, split[0]))]
    return out + [(b, ROOT, g, pack(_steps(words[own]), _small(once[own]), _small(pairs[own])))
                  for b, own in _dealt(_word_bucket(words, n_words))]


# -- seating ---------------------------------------------------------------------------------


class Seating:
    """Tables of many pairs at a time: ``tables`` per pair, and the customers at each table, those
    of one pair side by side."""

    def __init__(self, discount: float, rng, tables: np.ndarray, sizes: np.ndarray):
        self.discount, self.rng = discount, rng
        self.tables, self.sizes = tables.astype(np.int64), sizes.astype(np.int64)

    def _first(self) -> np.ndarray:
        return np.cumsum(self.tables) - self.tables

    def _chosen(self, pairs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """One table of each pair, with a chance in proportion to its weight."""
        total, first = np.cumsum(weight), self._first()[pairs]
        last = first + self.tables[pairs] - 1
        low = total[first] - weight[first]
        x = low + self.rng.random(len(pairs)) * (total[last] - low)
        return np.clip(np.searchsorted(total, x, "right"), first, last)

    def seat(self, pairs: np.ndarray, there: np.ndarray, some: np.ndarray, mass: np.ndarray):
        """Add ``some`` customers to pairs that have ``there``: each opens a table with a chance
        of mass : there - discount * tables; those who don't join one table, chosen by size."""
        if not len(pairs):
            return
        old = there - self.discount * self.tables[pairs]
        new = self.rng.binomial(some, mass / (mass + old))
        stay = some > new
        at = self._chosen(pairs[stay], self.sizes - self.discount)
        self.sizes[at] += (some - new)[stay]
        self.sizes = np.insert(
            self.sizes, np.repeat((self._first() + self.tables)[pairs], new), 1)
        self.tables[pairs] += new

    def leave(self, pairs: np.ndarray):
        """A random customer of each pair gets up; empty tables go."""
        if not len(pairs):
            return
        self.sizes[self._chosen(pairs, self.sizes.astype(float))] -= 1
        owner = np.repeat(np.arange(len(self.tables)), self.tables)
        here = self.sizes > 0
        self.tables = np.bincount(owner[here], minlength=len(self.tables))
        self.sizes = self.sizes[here]


def seated(count: np.ndarray, discount: float, rng, mass) -> Seating:
    """All customers seated one after the other, or, once there are 16 of a pair, an eighth of
    those there at a time. ``mass`` gives the weight of a new table for each pair, given the tables
    of all."""
    out = Seating(discount, rng, np.ones(len(count)), np.ones(len(count)))
    there = np.ones(len(count), np.int64)
    while True:
        left = np.flatnonzero(there < count)
        if not len(left):
            return out
        some = np.minimum(count[left] - there[left], np.maximum(1, there[left] // 8))
        out.seat(left, there[left], some, mass(out.tables)[left])
        there[left] += some


def reseat(seating: Seating, count: np.ndarray, mass, rounds: int) -> None:
    """Gibbs sampling: in each round one random customer of every pair gets up and is seated
    anew, given all others."""
    every = np.flatnonzero(count > 1)
    for _ in range(rounds):
        seating.leave(every)
        seating.seat(every, count[every] - 1, np.ones(len(every), np.int64),
                     mass(seating.tables)[every])


def _discount(once: int, twice: int) -> float:
    """The usual estimate from the numbers of things seen once and twice."""
    return min(max(once / (once + 2 * twice), 0.1), 0.9) if once else 0.5


@dataclass
class Model:
    """Numbers that hold for the whole model, as the passes tell them."""

    tokens: int
    words: int
    texts: int
    discount: float = 0.5
    root_discount: float = 0.5
    customers: int = 0
    root_tables: np.ndarray = field(default_factory=lambda: np.zeros(1))
    open_tables: dict[int, int] = field(default_factory=dict)

    def root(self, customers, tables, sample):
        """Root probabilities of words with so many customers and tables."""
        d = self.root_discount
        base = (STRENGTH + d * self.root_tables[sample]) / (self.words + 1)
        return (customers - d * tables + base) / (STRENGTH + self.customers)


def _seat_pairs(g: int, kinds: dict, model: Model, number: int, last: bool, n_words: int):
    """One pass over the restaurants of a bucket."""
    rooms, once, many, dish, count, dishes = unpack(kinds[PAIRS][0][1])
    rooms, dishes, count = _sorted_numbers(rooms), _numbers(dishes), count.astype(np.int64)
    chance = np.concatenate([unpack(data)[0] for _, data in kinds.get(WANTED, [])]
                            or [np.zeros(0)]).astype(float)[dish]
    room = np.repeat(np.arange(len(rooms)), many)
    rng, d = np.random.default_rng([number, g]), model.discount
    tables = unpack(kinds[SEATS][0][1])[0] if SEATS in kinds else many
    # What the other parts of a split restaurant had when they last told.
    there = np.array([model.open_tables.get(c, 0) for c in rooms.tolist()]
                     if model.open_tables else np.zeros(len(rooms)))
    before = once + (np.bincount(room, tables, len(rooms)) if SEATS in kinds else many)
    outside = np.where(there > 0, there - before, 0)

    def opened(tables):
        return outside + once + np.bincount(room, tables, len(rooms))

    def mass(tables):
        return (STRENGTH + d * opened(tables)[room]) * chance

    if SEATS in kinds:
        seating = Seating(d, rng, *unpack(kinds[SEATS][0][1]))
    else:
        seating = seated(count, d, rng, mass)
    reseat(seating, count, mass, ROUNDS)
    out, total, samples = [], np.zeros(len(count)), []
    for _ in range(SAMPLES if last else 0):
        reseat(seating, count, mass, ROUNDS)
        total += seating.tables
        samples.append(opened(seating.tables) - outside)
    for b, own in _dealt(_word_bucket(dishes, n_words)):
        own_tables = np.bincount(dish, seating.tables, len(dishes))[own].astype(np.int64)
        out.append((b, ROOT, g, pack(_steps(dishes[own]), _small(own_tables))))
    if not last:
        out.append((g, SEATS, 0, pack(_small(seating.tables), _small(seating.sizes))))
        own = (opened(seating.tables) - outside).astype(np.int64)
        return out + [(int(rooms[k]), SPLIT, 0, None, int(own[k]))
                      for k in np.flatnonzero(there)]
    out.append((g, VALUES, 0, pack((count - d * total / SAMPLES).astype(np.float32))))
    return out + [(b, ROOMS, g, pack(_steps(rooms[own]), *[t[own].astype(np.float32)
                                                          for t in samples]))
                  for b, own in _dealt(_word_bucket(rooms, n_words))]


def _root_counts(kinds: dict, column: int):
    """(codes, customers) of a bucket of root words."""
    found = [unpack(data) for _, data in kinds[ROOT]]
    codes, of = np.unique(np.concatenate([_sorted_numbers(x[0]) for x in found]),
                          return_inverse=True)
    some = np.concatenate([x[column] for x in found])
    return codes, np.bincount(of, some, len(codes)).astype(np.int64)


def _first_root(g: int, kinds: dict) -> list[tuple]:
    """The root when each pair has one table, and so has each word of the root. Told: customers,
    tables, words with one and with two customers."""
    codes, count = _root_counts(kinds, 2)
    told = (int(count.sum()), len(codes), int((count == 1).sum()), int((count == 2).sum()))
    return [(g, ROOT, 0, pack(_steps(codes), _small(count), np.ones(len(codes), np.uint8)))] + [
        (k, SPLIT, 0, None, n) for k, n in enumerate(told)]


def _seat_root(g: int, kinds: dict, model: Model, number: int) -> list[tuple]:
    """The root's tables for the words of a bucket, SAMPLES times: a word has a customer for each
    pair seen once, and one for each table of the others. Told: customers, and tables per sample."""
    codes, count = _root_counts(kinds, 1)
    rng, d = np.random.default_rng([number, g, 1]), model.root_discount
    weight = (STRENGTH + d * model.root_tables.mean()) / (model.words + 1)

    def mass(tables):
        return np.full(len(tables), weight)

    seating, samples = seated(count, d, rng, mass), []
    for _ in range(SAMPLES):
        reseat(seating, count, mass, ROUNDS)
        samples.append(seating.tables.copy())
    told = (int(count.sum()), *(int(t.sum()) for t in samples))
    return [(g, ROOT, 0, pack(_steps(codes), _small(count), *map(_small, samples)))] + [
        (k, SPLIT, 0, None, n) for k, n in enumerate(told)]


def _chances(g: int, kinds: dict, model: Model) -> list[tuple]:
    """Root probabilities for the buckets that want them."""
    codes, count, *tables = unpack(kinds[ROOT][0][1])
    codes = _sorted_numbers(codes)
    chance = sum(model.root(count, t.astype(float), s) for s, t in enumerate(tables)) / len(tables)
    return [(sub, WANTED, g, pack(chance[np.searchsorted(codes, _sorted_numbers(
        unpack(data)[0]))])) for sub, data in kinds.get(WANTED, [])]


# -- answers ---------------------------------------------------------------------------------


def _word_answers(g: int, kinds: dict, model: Model) -> list[tuple]:
    """To each slice, for its words: training count, and per sample the root probability and the
    open tables of the word's restaurant."""
    words, count = unpack(kinds[WORDS][0][1])
    words = _sorted_numbers(words)
    code, count = words >> _LOW, count.astype(np.int64)
    chance = np.zeros((SAMPLES, len(words)), np.float32)
    if len(words):
        codes, there, *tables = unpack(kinds[ROOT][0][1])
        at = np.searchsorted(_sorted_numbers(codes), code)
        for s, t in enumerate(tables):
            chance[s] = model.root(there, t.astype(float), s)[at]
    unique, of = np.unique(code, return_inverse=True)
    opened, begun = np.zeros((SAMPLES, len(unique)), np.float32), np.zeros(SAMPLES)
    for _, data in kinds.get(ROOMS, []):
        codes, *tables = unpack(data)
        codes = _sorted_numbers(codes)
        here, begin = np.isin(codes, unique, assume_unique=True), codes == BEGIN >> _LOW
        at = np.searchsorted(unique, codes[here])
        for s, t in enumerate(tables):
            opened[s, at] += t[here]
            begun[s] += t[begin].sum()
    opened = opened[:, of]
    out = []
    for sub, data in kinds.get(ASKED, []):
        at = unpack(data)[0]
        known = at >= 0
        at = at[known]
        out.append((sub, WORDS, g, pack(
            known.astype(np.uint8), _small(count[at]), chance[:, at].reshape(-1),
            opened[:, at].reshape(-1), begun)))
    return out


def _pair_answers(g: int, kinds: dict, model: Model) -> list[tuple]:
    """To each slice, for its pairs: the customers less the discount of their tables."""
    values = np.concatenate((np.array([0, 1 - model.discount], np.float32),
                             unpack(kinds[VALUES][0][1])[0]))
    return [(sub, VALUES, g, pack(values[unpack(data)[0] + 1]))
            for sub, data in kinds.get(ASKED, [])]


def _texts_of_slices(docs: DataFrame, schema: T.StructType) -> DataFrame:
    def run(batches):
        for number, ids, texts, _ in _slices(batches):
            raw = np.frombuffer(b"".join(texts), np.uint8)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            row = _rows([(number, TEXTS, 0, pack(raw, lengths))])
            yield from row.append_column(
                "ids", pa.array([ids], pa.list_(pa.string()))).to_batches()

    return docs.mapInArrow(run, schema)


def _scores(rows: list[dict], model: Model, n_words: int, n_pairs: int, split):
    """(ids, tokens, known tokens, base score, score) of the texts of a slice."""
    by: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r["kind"], r["sub"])):
        by.setdefault(row["kind"], []).append((row["sub"], row["data"]))
        if row["kind"] == TEXTS:
            ids, (raw, lengths) = row["ids"], unpack(row["data"])
    ends = np.cumsum(lengths)
    raw = raw.tobytes()
    tokens = Tokens([raw[e - n:e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)])
    code = tokens.words >> _LOW
    count = np.zeros(len(code), np.int64)
    unknown = [model.root(0, 0, s) for s in range(SAMPLES)]
    chance = np.repeat(np.array(unknown)[:, None], len(code), axis=1)
    opened, begun = np.zeros((SAMPLES, len(code))), np.zeros(SAMPLES)
    answers = dict(by.get(WORDS, []))
    for g, own in _dealt(_word_bucket(code, n_words)):
        known, found, p, t, first = unpack(answers[g])
        at = own[known.astype(bool)]
        count[at] = found
        chance[:, at] = p.reshape(SAMPLES, -1)
        opened[:, at] = t.reshape(SAMPLES, -1)
        begun += first
    context, word, of = tokens.pairs()
    value, answers = np.zeros(len(context)), dict(by.get(VALUES, []))
    for g, own in _dealt(_pair_bucket(code[context], code[word], n_pairs, split)):
        value[own] = unpack(answers[g])[0]
    customers = count.astype(float)
    customers[tokens.begin] = model.texts
    opened[:, tokens.begin] = begun
    given = STRENGTH + model.discount * opened[:, context]
    p = (value + (given * chance[:, word]).mean(axis=0)) / (STRENGTH + customers[context])
    base = np.log10((count + 1) / (model.tokens + model.words + 1))
    texts = len(lengths)
    return (ids, tokens.lengths, np.bincount(tokens.text, (count > 0)[tokens.word], texts),
            np.bincount(tokens.text, base[tokens.word], texts),
            np.bincount(tokens.text, np.log10(p)[of], texts))


# -- the whole -------------------------------------------------------------------------------


def _stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to a new shared folder by kind, and read from there."""
    folder = f"{scratch_folder(df.sparkSession, name)}/rows"
    df.write.partitionBy("kind").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder).select(*df.columns)


def _kind(df: DataFrame, *kinds: int) -> DataFrame:
    return df.where(F.col("kind").isin(*kinds))


def _told(df: DataFrame) -> dict[int, int]:
    """Sums of the numbers told under each key, of which there are few."""
    told = _kind(df, SPLIT).groupBy("g").agg(F.sum("n").alias("n")).collect()
    return {row["g"]: row["n"] for row in told}


def _with_root(model: Model, told: dict[int, int], samples: int) -> Model:
    tables = [float(told.get(1 + s, 0)) for s in range(samples)]
    return replace(model, customers=told.get(0, 0), root_tables=np.array(tables))


def scored(docs: DataFrame, learned: Column | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each row (doc_id, text).

    ``learned`` says which rows are learned from; by default those that are not
    :func:`held_out`. Words are parted by tab to carriage return and space, A-Z in lower case; each
    text ends with one mark, which counts as a token. ``n_known`` counts the tokens that occur in
    training texts, ``base_score`` sums log10((c + 1) / (N + V + 1)) with the token's count c, the
    N training tokens and V distinct ones; ``score`` sums log10 of the model's probabilities. A null
    or empty text is its end mark. Every row counts, repeated ones too, and other columns do not.
    Without training texts all tokens have probability 1.

    The rows are read several times and must come in the same partitions each time, as those of a
    table do.
    """
    spark = docs.sparkSession
    learned = F.coalesce(~held_out() if learned is None else learned, F.lit(False))
    ids = docs.schema["doc_id"].dataType
    docs = docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), learned.alias("learned"))
    size, texts = docs.agg(F.sum(F.octet_length("text")), F.count_if("learned")).first()
    n_words, n_pairs = (1 + (size or 0) // n for n in (WORD_BUCKET_BYTES, PAIR_BUCKET_BYTES))

    words = _stored(_grouped(_words_of_slices(docs, n_words), _counted_words), "words")
    tokens, distinct = _kind(words, WORDS).agg(F.sum("n"), F.sum("m")).first()
    model = Model(tokens or 0, distinct or 0, texts)
    # At most a context for each CONTEXT_TOKENS training tokens, and the beginning of texts.
    large = _told(words)
    if texts > CONTEXT_TOKENS:
        large[int(BEGIN >> _LOW)] = texts
    codes = np.array(sorted(large), np.uint64)
    parts = np.array([math.ceil(large[int(c)] / CONTEXT_TOKENS) for c in codes], np.int64)
    split = spark.sparkContext.broadcast((codes, parts))

    pairs = _stored(_grouped(
        _pairs_of_slices(docs, n_pairs, split),
        lambda g, kinds: _counted_pairs(g, kinds, n_words, split.value)), "pairs")
    once, twice = _kind(pairs, PAIRS).agg(F.sum("n"), F.sum("m")).first()
    root = _stored(_grouped(_kind(pairs, ROOT), _first_root), "root")
    told = _told(root)
    model = replace(_with_root(model, told, 1), open_tables=_told(pairs),
                    discount=_discount(once or 0, twice or 0),
                    root_discount=_discount(told.get(2, 0), told.get(3, 0)))
    seats = None
    for number in range(PASSES):
        last = number == PASSES - 1
        chances = _grouped(_kind(pairs, WANTED).union(_kind(root, ROOT)),
                           lambda g, kinds, m=model: _chances(g, kinds, m))
        rows = _kind(pairs, PAIRS).union(chances)
        if seats is not None:
            rows = rows.union(_kind(seats, SEATS))
        seats = _stored(_grouped(rows, lambda g, kinds, m=model, n=number, end=last: _seat_pairs(
            g, kinds, m, n, end, n_words)), f"seats{number}")
        model = replace(model, open_tables=_told(seats))
        root = _stored(_grouped(
            _kind(pairs, ROOT).union(_kind(seats, ROOT)),
            lambda g, kinds, m=model, n=number: _seat_root(g, kinds, m, n)), f"root{number}")
        model = _with_root(model, _told(root), SAMPLES)

    answers = _grouped(
        _kind(words, WORDS, ASKED).union(_kind(root, ROOT)).union(_kind(seats, ROOMS)),
        lambda g, kinds: _word_answers(g, kinds, model)
    ).union(_grouped(_kind(pairs, ASKED).union(_kind(seats, VALUES)),
                     lambda g, kinds: _pair_answers(g, kinds, model)))
    answers = answers.withColumn("ids", F.lit(None).cast("array<string>"))

    def finish(table):
        one, n, known, base, score = _scores(
            table.to_pylist(), model, n_words, n_pairs, split.value)
        return pa.table({
            "doc_id": pa.array(one, pa.string()), "n_tokens": pa.array(n, pa.int64()),
            "n_known": pa.array(known.astype(np.int64), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(score, pa.float64())})

    found = _texts_of_slices(docs, answers.schema).union(answers).groupBy("g").applyInArrow(
        finish, "doc_id string, n_tokens long, n_known long, base_score double, score double")
    return found.select(
        F.col("doc_id").cast(ids).alias("doc_id"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
