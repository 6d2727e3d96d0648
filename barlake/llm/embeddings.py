"""Embedding near-duplicates by spherical-cap filters from structured random product codes.

The filter directions are all pairs of one unit vector out of a random code for the first
half of the dimensions and one out of another for the second half. A vector is stored under its
best direction and looks for partners under all directions that its own scores exceed the bound of.
For a pair at the threshold angle theta, a score s of one becomes s cos(theta) plus a part of the
other's remainder along a random direction, whose standard deviation is sin(theta) /
sqrt(dimensions). The bound takes 5.5 of these off, which misses a pair with a chance below one in
ten million, or the certain bound cos(phi + theta), where that is higher (few dimensions). Of two
vectors, the one with the lower best score looks for the other one: each pair is met once, and the
bound follows from the looking vector's best score. The product structure lists the exceeding
directions without scoring all of them: the halves are scored apart, and a first half is gone into
only if the best second half lifts it over the bound.

A family is the vectors of one label and length. The larger it is, the more directions it has, so
that each holds some thousands; small families share bins. Vectors meet in tiles: a block of the
vectors stored under a family's direction, and a block of those that look there. They are sent in
packed arrays, at most twice as many as there are vectors in one round, and a round's shuffle files
go before the next one: the disk taken grows with the vectors, not with the vectors times the
directions they look under. A tile is compared in parts that are ordered by score, so most pairs
fall to the bounds; the others are screened in single precision with the rounding error taken off,
and what is left is decided in double precision. Equal vectors are one vector with a count.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import cut_clean, written
from barlake.llm.components import components

# Stored vectors of a tile (of up to 256 components; fewer of longer ones), and how many times as
# many may look there.
BLOCK = 8192
LOOKING = 4
# Vectors per family and direction aimed at.
PER_DIRECTION = 4096
# Vectors sent in one round, per vector that there is.
PER_ROUND = 2
# Parts of a tile that are compared at once.
STORED_PART, LOOKING_PART = 512, 4096
MISS_SIGMAS = 5.5


def _code(dims: int, size: int, seed: int) -> np.ndarray:
    code = np.random.default_rng([seed, dims, size]).normal(size=(size, max(dims, 1)))
    return code[:, :dims] / np.linalg.norm(code, axis=1, keepdims=True)


@lru_cache(maxsize=16)
def _codes(dims: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit directions of both halves, scaled so that a pair of them is a unit vector. A vector of
    one dimension has its second half empty."""
    half = (dims + 1) // 2
    a, b = _code(half, size, 1), _code(dims - half, size, 2)
    return (a / math.sqrt(2), b / math.sqrt(2)) if dims > half else (a, b)


def _rows(column) -> np.ndarray:
    """The vectors of an Arrow list column whose rows have the same length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    flat = flat if flat.dtype == np.float32 else flat.astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _units(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1; divided by their largest component first, so that no square is too
    large or too small for a double."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vec: Column, label: Column) -> Column:
    """Vectors that can link: a label, and finite components that are not all zero."""
    vec = vec.cast("array<double>")
    # Whether a null or NaN is in it, without a function per component: null if there is a null.
    odd = F.array_contains(vec, F.lit(float("nan")))
    low, high = F.array_min(vec), F.array_max(vec)
    finite = ~odd & (low > float("-inf")) & (high < float("inf"))
    return label.isNotNull() & F.coalesce(finite & ((low != 0) | (high != 0)), F.lit(False))


def _by_dims(batches):
    """(batch part, dimensions) for the runs of vectors of one length."""
    for batch in batches:
        sizes = batch.column("vec").value_lengths().to_numpy(zero_copy_only=False)
        for dims in np.unique(sizes):
            yield batch.filter(pa.array(sizes == dims)), int(dims)


class Families:
    """The families with directions of their own: per half, and the first of their cells among all.
    All others share ``bins`` bins."""

    def __init__(self, sizes: dict[int, int], small: int):
        self.keys = np.array(sorted(sizes), np.int64)
        counts = np.array([sizes[key] for key in self.keys.tolist()], float)
        self.halves = np.ceil(np.sqrt(counts / PER_DIRECTION)).astype(np.int64)
        self.first = np.cumsum(self.halves ** 2) - self.halves ** 2
        self.cells = int((self.halves ** 2).sum())
        self.bins = max(1, math.ceil(small / PER_DIRECTION))

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(directions per half, first cell) of each family; (0, 0) if it shares bins."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        own = self.keys[at] == keys
        return np.where(own, self.halves[at], 0), np.where(own, self.first[at], 0)


def _families(rows: DataFrame) -> tuple[Families, int, int]:
    """The families of the rows, the number of vectors, and of those in small families."""
    counts = cut_clean(rows.select("family", "node").distinct().groupBy("family").count())
    large = {r["family"]: r["count"]
             for r in counts.where(F.col("count") > PER_DIRECTION).collect()}
    n = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    small = n - sum(large.values())
    return Families(large, small), n, small


# Bytes of the records in one row, and vectors that are gone through at once.
PACKED = 1 << 18
AT_ONCE = 8192


def _record(dims: int, single: bool, *more: tuple[str, str]) -> np.dtype:
    """A vector as it is stored and sent; ``best`` is its best score."""
    return np.dtype([("node", "<i8"), ("family", "<i8"), ("copies", "<i8"), ("best", "<f8"), *more,
                     ("vec", "<f4" if single else "<f8", (dims,))])


def _at_rest(dims: int, single: bool) -> np.dtype:
    """A stored vector, with the direction of its best score, or its bin."""
    return _record(dims, single, ("cell", "<i8"))


def _under_way(dims: int, single: bool) -> np.dtype:
    """A vector sent to a tile, with its score in the tile's direction, and what it is there."""
    return _record(dims, single, ("score", "<f8"), ("role", "u1"))


def _stored(vectors: DataFrame, sent) -> DataFrame:
    """(dims, single, records): the vectors, those of one length packed. Rows of the input arrive
    in batches, so a row has thousands."""
    def run(batches):
        families = sent.value
        for batch, dims in _by_dims(batches):
            vec, family = _rows(batch.column("vec")), batch.column("family").to_numpy()
            x, (half, _) = _units(vec), families.of(family)
            cell, score = family % families.bins, np.zeros(len(x))
            for size in np.unique(half):
                at = np.flatnonzero(half == size)
                a, b = _codes(dims, max(int(size), 1))
                one, two = x[at, :a.shape[1]] @ a.T, x[at, a.shape[1]:] @ b.T
                i, j = one.argmax(axis=1), two.argmax(axis=1)
                score[at] = one.max(axis=1) + two.max(axis=1)
                if size:
                    cell[at] = i * size + j
            single = vec.dtype == np.float32
            records = np.empty(len(x), _at_rest(dims, single))
            for name, column in (
                    ("node", batch.column("node").to_numpy()), ("family", family),
                    ("copies", batch.column("copies").to_numpy()),
                    ("best", np.clip(score, -1, 1)), ("cell", cell), ("vec", vec)):
                records[name] = column
            step = max(1, PACKED // records.itemsize)
            parts = [records[at:at + step].tobytes() for at in range(0, len(records), step)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims] * len(parts), pa.int32()), pa.array([single] * len(parts)),
                 pa.array(parts, pa.binary())], ["dims", "single", "records"])

    return vectors.mapInArrow(run, "dims int, single boolean, records binary")


def _unpacked(batches):
    """(records, dimensions, whether in single precision) for the rows of :func:`_stored`, some
    rows of one kind at once."""
    kept, kind, n = [], None, 0
    for batch in batches:
        for dims, single, packed in zip(*(batch.column(c) for c in (
                "dims", "single", "records")), strict=True):
            this = dims.as_py(), single.as_py()
            if kept and (this != kind or n >= AT_ONCE):
                yield np.concatenate(kept), *kind
                kept, n = [], 0
            kind = this
            kept.append(np.frombuffer(packed.as_buffer(), _at_rest(*kind)))
            n += len(kept[-1])
    if kept:
        yield np.concatenate(kept), *kind


def least_score(score: np.ndarray, threshold: float, dims: int, miss: float) -> np.ndarray:
    """The least score that a partner of a vector with this score has."""
    theta = math.acos(threshold)
    certain = np.cos(np.minimum(np.arccos(np.clip(score, -1, 1)) + theta, math.pi))
    return np.maximum(certain, score * threshold - miss * math.sin(theta) / math.sqrt(dims)) - 1e-9


def listed(x: np.ndarray, codes, bound: np.ndarray, firsts: np.ndarray):
    """(vector, direction, score) for all directions whose score is at least the vector's bound, of
    those with one of ``firsts`` in the first half."""
    a, b = codes
    one, two = x[:, :a.shape[1]] @ a[firsts].T, x[:, a.shape[1]:] @ b.T
    rows, first = np.nonzero(one + two.max(axis=1, keepdims=True) >= bound[:, None])
    found, step = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 1 << 14
    for at in range(0, len(rows), step):
        r, f = rows[at:at + step], first[at:at + step]
        score = one[r, f][:, None] + two[r]
        k, second = np.nonzero(score >= bound[r][:, None])
        found.append((r[k], firsts[f[k]] * b.shape[0] + second, score[k, second]))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _counted(stored: DataFrame, families, threshold: float, miss: float) -> DataFrame:
    """(cell, held, looking, dims): per cell of the families with directions, the vectors stored
    and those that look there."""
    def run(batches):
        known = families.value
        held, looking, length = (np.zeros(known.cells, np.int64) for _ in range(3))
        for all_, dims, _ in _unpacked(batches):
            half, first = known.of(all_["family"])
            for size in np.unique(half[half > 0]):
                at = np.flatnonzero(half == size)
                r, direction, _ = listed(_units(all_["vec"][at]), _codes(dims, int(size)),
                                         least_score(all_["best"][at], threshold, dims, miss),
                                         np.arange(size))
                own = first[at] + all_["cell"][at]
                held += np.bincount(own, minlength=known.cells)
                looking += np.bincount(first[at][r] + direction, minlength=known.cells)
                length[own] = dims
        some = np.flatnonzero(held + looking)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (some, held[some], looking[some], length[some])],
            ["cell", "held", "looking", "dims"])

    counts = stored.mapInArrow(run, "cell long, held long, looking long, dims long")
    return counts.groupBy("cell").agg(
        F.sum("held").alias("held"), F.sum("looking").alias("looking"),
        F.max("dims").alias("dims"))


class Tiles:
    """Per cell: blocks of stored vectors and of those that look there (none where nothing is
    stored), number of the first tile, and where in the sequence of all vectors sent its own begin;
    the bins come last. A round takes ``limit`` of that sequence."""

    def __init__(self, families: Families, counts, n: int, small: int):
        held, looking, dims = (np.zeros(families.cells, np.int64) for _ in range(3))
        for row in counts:
            held[row["cell"]], looking[row["cell"]] = row["held"], row["looking"]
            dims[row["cell"]] = row["dims"]
        block = np.maximum(1, BLOCK * 256 // np.maximum(dims, 256))
        self.stored = -(-held // block)
        self.looking = np.where(held > 0, -(-looking // (LOOKING * block)), 0)
        n_tiles = self.stored * self.looking
        self.tile = np.cumsum(n_tiles) - n_tiles
        # In the order of the first half's direction, so that a round has few of these.
        self.size = np.repeat(families.halves, families.halves ** 2)
        direction = np.arange(families.cells) - np.repeat(families.first, families.halves ** 2)
        self.half = direction // np.maximum(self.size, 1)
        weight = np.where(held > 0, held * self.looking + looking * self.stored, 0)
        order = np.lexsort((self.half, self.size))
        self.begin = np.zeros(families.cells)
        self.begin[order] = np.cumsum(weight[order]) - weight[order]
        self.each = weight / np.maximum(n_tiles, 1)
        self.bins_begin, self.bin = float(weight.sum()), small / families.bins
        self.limit = float(max(1, PER_ROUND * n))
        self.rounds = math.ceil((self.bins_begin + small) / self.limit)

    def round_of(self, cell: np.ndarray, tile: np.ndarray) -> np.ndarray:
        """The round of the tile with this number in the cell."""
        return ((self.begin[cell] + (tile + 0.5) * self.each[cell]) / self.limit).astype(np.int64)

    def round_of_bin(self, number: np.ndarray) -> np.ndarray:
        return ((self.bins_begin + (number + 0.5) * self.bin) / self.limit).astype(np.int64)

    def firsts(self, turn: int) -> dict[int, np.ndarray]:
        """Per number of directions, those of the first half with tiles in a round."""
        end = self.begin + self.each * self.stored * self.looking
        here = (self.begin < (turn + 1) * self.limit) & (end > turn * self.limit)
        return {int(size): np.unique(self.half[here & (self.size == size)])
                for size in np.unique(self.size[here])}


STORED, LOOKS = 1, 2


def _every(rows: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each position of ``rows`` as often as ``times`` says, with a running number."""
    at = np.repeat(np.arange(len(rows)), times)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)


def _met(x, node, cell, best, first, size, tiles, turn, codes, bound, firsts):
    """(vector, tile, score, role): the tiles in which vectors of one length, whose families have
    ``size`` directions per half, meet others in a round."""
    r, direction, score = listed(x, codes, bound, firsts)
    spread = node.view(np.uint64)
    own, there = first + cell, first[r] + direction

    def block(vector, where, parts, shift):
        return ((spread[vector] >> np.uint64(shift)) % np.maximum(parts[where], 1).astype(np.uint64)
                ).astype(np.int64)

    everyone = np.arange(len(x))
    mine, looked = block(everyone, own, tiles.stored, 0), block(everyone, own, tiles.looking, 32)
    # Under its own direction a vector is stored for all that look, and where it looks itself it
    # is both in one.
    at, part = _every(own, tiles.looking[own])
    number = mine[at] * tiles.looking[own[at]] + part
    out = [(at, own[at], number, best[at],
            np.where(part == looked[at], STORED | LOOKS, STORED).astype(np.uint8))]
    at, part = _every(there, tiles.stored[there])
    v, c = r[at], there[at]
    number = part * tiles.looking[c] + block(v, c, tiles.looking, 32)
    other = (c != own[v]) | (part != mine[v])
    out.append((v[other], c[other], number[other], score[at][other],
                np.full(int(other.sum()), LOOKS, np.uint8)))
    v, c, number, score, role = (np.concatenate(part) for part in zip(*out, strict=True))
    now = tiles.round_of(c, number) == turn
    return v[now], (tiles.tile[c] + number)[now], score[now], role[now]


def _sent(stored: DataFrame, families, tiles, turn: int, firsts, threshold: float,
          miss: float) -> DataFrame:
    """(tile, dims, single, records): the vectors of a round, those for one tile packed."""
    def run(batches):
        known, laid = families.value, tiles.value
        for all_, dims, single in _unpacked(batches):
            node, cell, best = (np.ascontiguousarray(all_[c]) for c in ("node", "cell", "best"))
            bound = least_score(best, threshold, dims, miss)
            half, first = known.of(all_["family"])
            binned = np.flatnonzero(half == 0)
            binned = binned[laid.round_of_bin(cell[binned]) == turn]
            met = [(binned, -1 - cell[binned], best[binned],
                    np.full(len(binned), STORED | LOOKS, np.uint8))]
            for size, some in firsts.items():
                at = np.flatnonzero(half == size)
                if len(at):
                    v, *rest = _met(_units(all_["vec"][at]), node[at], cell[at], best[at],
                                    first[at], size, laid, turn, _codes(dims, size), bound[at],
                                    some)
                    met.append((at[v], *rest))
            v, tile, score, role = (np.concatenate(part) for part in zip(*met, strict=True))
            order = np.argsort(tile, kind="stable")
            v, tile, score, role = v[order], tile[order], score[order], role[order]
            kind = _under_way(dims, single)
            step = max(1, 128 * PACKED // kind.itemsize)
            for at in range(0, len(v), step):
                r = v[at:at + step]
                records = np.empty(len(r), kind)
                for name in ("node", "family", "copies", "best", "vec"):
                    records[name] = all_[name][r]
                records["score"], records["role"] = score[at:at + step], role[at:at + step]
                begins = np.flatnonzero(np.diff(tile[at:at + step], prepend=tile[at] - 1))
                ends = (np.append(begins, len(r)) * records.itemsize).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(begins), [
                    None, pa.py_buffer(ends.tobytes()), pa.py_buffer(records.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tile[at:at + step][begins], pa.int64()),
                     pa.array(np.full(len(begins), dims, np.int32)),
                     pa.array(np.full(len(begins), single)), packed],
                    ["tile", "dims", "single", "records"])

    return stored.mapInArrow(run, "tile long, dims int, single boolean, records binary")


def _connected(hit: np.ndarray, one: np.ndarray, two: np.ndarray):
    """The least node that each of ``two`` (rows) and ``one`` (columns) is connected with."""
    p, q, top = one.copy(), two.copy(), np.iinfo(np.int64).max
    while True:
        q2 = np.minimum(q, np.where(hit, p[None, :], top).min(axis=1))
        p2 = np.minimum(p, np.where(hit, q2[:, None], top).min(axis=0))
        if (p2 == p).all() and (q2 == q).all():
            return p, q
        p, q = p2, q2


def _rough(vec: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in single precision."""
    rough = np.empty(vec.shape, np.float32)
    for at in range(0, len(vec), LOOKING_PART):
        rough[at:at + LOOKING_PART] = _units(vec[at:at + LOOKING_PART])
    return rough


def _at_hits(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows and the columns with a hit."""
    hits = np.flatnonzero(near)
    if len(hits) * 8 > near.size:
        return np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    rows, columns = np.divmod(hits, near.shape[1])
    return np.unique(rows), np.unique(columns)


def _linked(all_: np.ndarray, threshold: float, dims: int, miss: float):
    """(node, links, least) of the links among records of one length, a part of the tile at a
    time."""
    rough = _rough(all_["vec"])
    screen = np.float32(threshold - (dims + 4) * 1.2e-7)
    node, family, copies, best, score = (
        np.ascontiguousarray(all_[c]) for c in ("node", "family", "copies", "best", "score"))
    mixed = (family != family[0]).any()
    least = least_score(score, threshold, dims, miss)
    held, looking = (np.flatnonzero(all_["role"] & role) for role in (STORED, LOOKS))
    held = held[np.argsort(best[held], kind="stable")]
    for begin in range(0, len(held), STORED_PART):
        x = held[begin:begin + STORED_PART]
        low, high = best[x[0]], best[x[-1]]
        rows = looking[(score[looking] >= least_score(low, threshold, dims, miss))
                       & (least[looking] <= high) & (best[looking] <= high)]
        for at in range(0, len(rows), LOOKING_PART):
            y = rows[at:at + LOOKING_PART]
            some, other = _at_hits(rough[y] @ rough[x].T >= screen)
            if not len(some):
                continue
            y, x2 = y[some], x[other]
            hit = _units(all_["vec"][y]) @ _units(all_["vec"][x2]).T >= threshold
            hit &= (best[x2] > best[y, None]) | (
                (best[x2] == best[y, None]) & (node[x2] > node[y, None]))
            if mixed:
                hit &= family[x2] == family[y, None]
            some, other = hit.any(axis=1), hit.any(axis=0)
            if not some.any():
                continue
            hit, y, x2 = hit[np.ix_(some, other)], y[some], x2[other]
            p, q = _connected(hit, node[x2], node[y])
            yield node[y], hit @ copies[x2], q
            yield node[x2], copies[y] @ hit, p


def _verified(tile: pa.Table, threshold: float, miss: float) -> pa.Table:
    """Of each vector with a link in the tile: the number of rows linked by it, and the least nodes
    that it is connected with here."""
    found = [(np.zeros(0, np.int64),) * 3]
    kinds = {(d, s) for d, s in zip(tile["dims"].to_pylist(), tile["single"].to_pylist(),
                                    strict=True)}
    for dims, single in sorted(kinds):
        packed = [r.as_buffer() for r, d, s in zip(tile["records"], tile["dims"].to_pylist(),
                  tile["single"].to_pylist(), strict=True) if (d, s) == (dims, single)]
        records = np.concatenate([np.frombuffer(r, _under_way(dims, single)) for r in packed])
        found += _linked(records, threshold, dims, miss)
    node, links, least = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.lexsort((least, node))
    node, links, least = node[order], links[order], least[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (least[1:] != least[:-1])
    begins = np.flatnonzero(new)
    links = np.add.reduceat(links, begins) if len(begins) else links
    return pa.table({"node": node[begins], "links": links, "least": least[begins]})


def _links(stored: DataFrame, known, n: int, small: int, threshold: float,
           miss: float) -> DataFrame:
    """(node, links, least): what all tiles found."""
    spark, families = stored.sparkSession, known.value
    counts = _counted(stored, known, threshold, miss).collect() if families.cells else []
    tiles = Tiles(families, counts, n, small)
    laid = spark.sparkContext.broadcast(tiles)
    found = spark.createDataFrame([], "node long, links long, least long")
    for turn in range(tiles.rounds):
        sent = _sent(stored, known, laid, turn, tiles.firsts(turn), threshold, miss)
        found = found.union(cut_clean(sent.groupBy("tile").applyInArrow(
            lambda tile: _verified(tile, threshold, miss), found.schema)))
    # Many small parts, which are read twice from here on.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return written(found.coalesce(parts), "vector_links")


def near_vectors(
    vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
    vec_col: str = "embedding", label_col: str = "label", miss: float = MISS_SIGMAS,
) -> DataFrame:
    """(id, n_links, component) of each row.

    Rows link if their labels are equal and not null and the cosine of their vectors, in double
    precision, is at least the threshold. A vector that is null, empty, zero, or holds a null or a
    non-finite component links with nothing, and so do vectors of different lengths. Every row
    counts as a vector, repeated ones too. The component is the smallest id reachable, the
    row's own included; a row without an id counts for links, but is nobody's component.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"),
                          F.col(label_col).alias("label"))
    node = F.when(usable(F.col("vec"), F.col("label")), F.xxhash64("label", "vec"))
    rows = rows.select("id", node.alias("node"), F.xxhash64("label", F.size("vec")).alias("family"),
                       "vec")
    ids = written(rows.select("id", "node", "family"), "vector_ids")
    linkable = ids.where("node is not null")
    families, n, small = _families(linkable)
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.first("family").alias("family"), F.first("vec").alias("vec"),
        F.count("*").alias("copies"))
    known = rows.sparkSession.sparkContext.broadcast(families)
    stored = cut_clean(_stored(nodes, known))
    found = _links(stored, known, n, small, threshold, miss)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    placed = written(
        linkable.groupBy("node").agg(F.count("*").alias("copies"), F.min("id").alias("first"))
        .join(links, "node", "left").join(joined, "node", "left")
        .select("node", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
                .alias("n_links"), F.coalesce("component", "node").alias("root")), "vector_places")
    names = placed.groupBy("root").agg(F.min("first").alias("component"))
    placed = placed.join(names, "root").select("node", "n_links", "component")
    return ids.select("id", "node").join(placed, "node", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component"))
