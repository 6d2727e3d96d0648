"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Texts become sets of hashed word shingles; equal sets form one node. All sets are ordered by
one rule: estimated cost of a shingle, then its hash. The estimate comes from a table of
2^18 counters over all texts, so its size is fixed; a shingle that stands out from the mean
counter is costly and comes late.

A set of n shingles that must share c = ceil(t n) with any partner shares at least L of the first
n - c + L with it, for every L. Each set takes the L with the least estimated cost: looking
through the lists of its prefix, and verifying the partners that can be found in L of them.
Two sets are verified only if they share the smaller of their two L.

Partners are counted and verified in tiles: nodes that share rare shingles are put into blocks of
some hundred, and a tile is a pair of blocks with at least one common shingle. So a large group
of near copies makes few rows, and pairs never become rows. A tile keeps the links of a
spanning forest, which is all that components need.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from barlake.llm.common import cut, unwrapped, wrapped
from barlake.llm.components import components
from barlake.llm.tokens import Words, blank_bytes, chunks, mixed_bits, slices, text_bytes

SKETCH_BITS = 18
MOST_MATCHES = 8
VERIFY_COST = 8.0
BLOCK = 256
# Bounds of sixteen ranges of hashes; the last is above all but one hash.
_RANGES = np.append(np.arange(16, dtype=np.uint64) << np.uint64(60), np.uint64(2**64 - 1))


def shingle_sets(texts: list[bytes], width: int):
    """Sorted distinct shingle hashes of each text. A text of fewer words has one shingle, all
    its words; one without words has none."""
    for begin, end in chunks(texts):
        words = Words(texts[begin:end], blank_bytes())
        runs = words.runs(width)
        for k in range(end - begin):
            first, last = int(words.firsts[k]), int(words.firsts[k + 1])
            if last - first >= width:
                yield np.unique(runs[first:last - width + 1])
            elif last > first:
                few = words.hashes[first:last]
                whole = np.uint64(last - first)
                for h in few:
                    whole = mixed_bits(np.array([whole ^ h]))[0]
                yield np.array([whole], dtype=np.uint64)
            else:
                yield np.zeros(0, dtype=np.uint64)


def _node(shingles: np.ndarray) -> int:
    """A 64-bit hash of a set."""
    with np.errstate(over="ignore"):
        total = mixed_bits(shingles + np.uint64(len(shingles))).sum(dtype=np.uint64)
    return int(mixed_bits(np.array([total])).view(np.int64)[0])


def _fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _nodes(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, n, node) of each row; node is null for an empty set. Only texts without
    an id are hashed."""
    def run(batches):
        for batch in slices(batches):
            sets = list(shingle_sets(text_bytes(batch.column("text")), width))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_node(s) if len(s) else None for s in sets], pa.int64())],
                ["doc_id", "text_hash", "n", "node"])

    own = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    return docs.withColumn("text_hash", own).mapInArrow(
        run, T.StructType([docs.schema["doc_id"], *_fields(
            text_hash=T.LongType(), n=T.LongType(), node=T.LongType())]))


def _sketch(docs: DataFrame, width: int) -> np.ndarray:
    """Estimated number of sets that hold a shingle, by counter.

    Only shingles that stand in several sets of the same batch are counted: the many that are
    rare leave the counters to those that are costly.
    """
    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            sets = [s for part in slices([batch])
                    for s in shingle_sets(text_bytes(part.column("text")), width)]
            # The sets are sorted, so that a range of hashes is a slice of each.
            cuts = [np.searchsorted(s, _RANGES).tolist() for s in sets]
            for k in range(len(_RANGES) - 1 if sets else 0):
                every = np.concatenate([s[c[k]:c[k + 1]] for s, c in zip(sets, cuts, strict=True)])
                every.sort()
                again = every[1:][every[1:] == every[:-1]]
                np.add.at(counts, again >> np.uint64(64 - SKETCH_BITS), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at])],
                                         ["counter", "n"])

    counted = docs.select("text").mapInArrow(run, _fields(counter=T.LongType(), n=T.LongType()))
    # At most 2^18 rows, whatever the number of texts.
    rows = counted.groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SKETCH_BITS)
    out[rows["counter"].to_numpy()] = rows["n"].to_numpy()
    return out


def prefix(shingles: np.ndarray, repeats: np.ndarray, num: int, den: int):
    """The set's prefix and the number L of matches that a partner must have in it."""
    n = len(shingles)
    cost = 1.0 + repeats[shingles >> np.uint64(64 - SKETCH_BITS)]
    order = np.lexsort((shingles, np.floor(np.log2(cost))))
    short = n - (num * n + den - 1) // den
    longest = min(MOST_MATCHES, n - short)
    sums = np.cumsum(cost[order[:short + longest]])[short:]
    matches = np.arange(1, longest + 1)
    best = int(np.argmin(sums + VERIFY_COST * sums / matches)) + 1
    return shingles[order[:short + best]], best


def _postings(docs: DataFrame, width: int, repeats, num: int, den: int) -> DataFrame:
    def run(batches):
        seen: set[int] = set()
        for batch in slices(batches):
            tokens, nodes, sizes, least = [], [], [], []
            for s in shingle_sets(text_bytes(batch.column("text")), width):
                n = len(s)
                # Smaller sets reach the threshold with no other set.
                if not n or den * n < num * (n + 1) and den * (n - 1) < num * n:
                    continue
                node = _node(s)
                if node in seen:
                    continue
                if len(seen) < 100_000:
                    seen.add(node)
                first, best = prefix(s, repeats.value, num, den)
                tokens.append(first)
                nodes.append(np.full(len(first), node))
                sizes.append(np.full(len(first), n, dtype=np.int32))
                least.append(np.full(len(first), best, dtype=np.int16))
            if tokens:
                columns = [np.concatenate(c) for c in (tokens, nodes, sizes, least)]
                columns[0] = columns[0].view(np.int64)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)),
                                                 ["token", "node", "n", "matches"])

    return docs.select("text").mapInArrow(run, _fields(
        token=T.LongType(), node=T.LongType(), n=T.IntegerType(), matches=T.ShortType()))


def _side(lists) -> tuple:
    """Nodes of one side of a tile: ids, sizes, matches, and members of each shingle's list."""
    flat = lists.flatten()
    ids, first, at = np.unique(flat.field("node").to_numpy(), return_index=True,
                               return_inverse=True)
    sizes = flat.field("n").to_numpy()[first].astype(np.int64)
    return ids, sizes, flat.field("matches").to_numpy()[first], np.split(
        at, np.cumsum(lists.value_lengths().to_numpy())[:-1])


def _pairs(lists, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a tile that share enough prefix shingles and may be similar by size."""
    a, na, la, ins_a = _side(lists.field("left_nodes"))
    b, nb, lb, ins_b = _side(lists.field("right_nodes"))
    shared = np.zeros((len(a), len(b)), dtype=np.int32)
    for x, y in zip(ins_a, ins_b, strict=True):
        shared[x[:, None], y] += 1
    enough = shared >= np.minimum.outer(la, lb)
    enough &= den * np.minimum.outer(na, nb) >= num * np.maximum.outer(na, nb)
    # Within a block both orders of a pair occur.
    enough &= a[:, None] < b[None, :] if np.array_equal(a, b) else a[:, None] != b[None, :]
    x, y = np.nonzero(enough)
    return a[x], b[y]


def _candidates(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (xs[i], ys[i]) of each tile, one row per tile that has any."""
    def run(batches):
        for batch in batches:
            lists = batch.column("lists")
            found = [_pairs(lists[i].values, num, den) for i in range(len(batch))]
            some = [i for i, (x, _) in enumerate(found) if len(x)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("left").take(pa.array(some, pa.int64())),
                 batch.column("right").take(pa.array(some, pa.int64())),
                 pa.array([found[i][0] for i in some], pa.list_(pa.int64())),
                 pa.array([found[i][1] for i in some], pa.list_(pa.int64()))],
                ["left", "right", "xs", "ys"])

    return tiles.select("left", "right", "lists").mapInArrow(
        run, "left long, right long, xs array<long>, ys array<long>")


def _forest(pairs) -> list[tuple[int, int]]:
    """The pairs that join two trees."""
    root: dict[int, int] = {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    out = []
    for x, y in pairs:
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _links(key, tiles: pa.Table, sets: pa.Table, num: int, den: int) -> pa.Table:
    """The verified links of a tile, as a forest."""
    own = {}
    for node, packed in zip(sets["node"].to_pylist(), sets["shingles"].to_pylist(), strict=True):
        own[node] = np.frombuffer(packed, dtype=np.uint64)

    def linked():
        for xs, ys in zip(tiles["xs"].to_pylist(), tiles["ys"].to_pylist(), strict=True):
            for x, y in zip(xs, ys, strict=True):
                p, q = own[x], own[y]
                both = np.concatenate((p, q))
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                if den * common >= num * (len(p) + len(q) - common):
                    yield x, y

    found = _forest(linked())
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()),
                     "b": pa.array([y for _, y in found], pa.int64())})


def linked_nodes(docs: DataFrame, nodes: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Links (a, b) between nodes whose Jaccard similarity is num / den at least; per component
    enough of them to connect it."""
    sc = docs.sparkSession.sparkContext
    repeats = sc.broadcast(_sketch(docs, width))
    postings = _postings(docs, width, repeats, num, den)
    token = Window.partitionBy("token")
    # A shingle that stands in one prefix only finds nobody.
    shared = cut(
        postings.withColumn("pivot", F.min("node").over(token))
        .withColumn("last", F.max("node").over(token))
        .where("pivot <> last").drop("last")
    )
    # Nodes with a common pivot go to blocks side by side.
    labels = shared.groupBy("node").agg(F.min("pivot").alias("label"))
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK).cast("long"))
    blocks = labels.join(sizes, "label").select(
        "node", F.xxhash64("label", part).alias("block"))
    lists = (
        shared.drop("pivot").distinct().join(blocks, "node").groupBy("token", "block")
        .agg(F.collect_list(F.struct("node", "n", "matches")).alias("nodes"),
             F.min("matches").alias("least"))
    )
    left = lists.select("token", F.col("block").alias("left"), F.col("nodes").alias("left_nodes"),
                        F.col("least").alias("left_least"))
    right = lists.select("token", F.col("block").alias("right"),
                         F.col("nodes").alias("right_nodes"), F.col("least").alias("right_least"))
    alone = (F.col("left") == F.col("right")) & (F.size("left_nodes") < 2)
    tiles = (
        left.join(right, "token").where("left <= right").where(~alone)
        .groupBy("left", "right")
        .agg(F.collect_list(F.struct("left_nodes", "right_nodes")).alias("lists"),
             F.min(F.least("left_least", "right_least")).alias("least"))
        # A tile with fewer common shingles than any of its nodes asks for has no pair.
        .where(F.size("lists") >= F.col("least"))
    )
    tiles = cut(_candidates(tiles, num, den))
    wanted = tiles.select("left", "right", F.explode(
        F.array_distinct(F.concat("xs", "ys"))).alias("node"))
    sets = _sets(docs, nodes.join(wanted.select("node").distinct(), "node", "left_semi"), width)
    placed = wanted.join(sets, "node").select(
        F.col("left").alias("l"), F.col("right").alias("r"), "node", "shingles")
    return tiles.groupBy("left", "right").cogroup(placed.groupBy("l", "r")).applyInArrow(
        lambda key, some, own: _links(key, some, own, num, den), "a long, b long")


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the wanted nodes, from the text of one document of each."""
    def run(batches):
        for batch in slices(batches):
            sets = list(shingle_sets(text_bytes(batch.column("text")), width))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    one = nodes.groupBy("node").agg(F.min("doc_id").alias("doc_id"),
                                    F.min("text_hash").alias("text_hash"))
    # Sets that only texts without an id have are found by the hash of one of those.
    bare = docs.where("doc_id is null").select("text", F.xxhash64("text").alias("text_hash"))
    texts = docs.join(one.where("doc_id is not null"), "doc_id").select("text").union(
        bare.dropDuplicates(["text_hash"])
        .join(one.where("doc_id is null").select("text_hash"), "text_hash", "left_semi")
        .select("text"))
    found = texts.mapInArrow(
        run, _fields(node=T.LongType(), shingles=T.BinaryType()))
    return found.dropDuplicates(["node"])


def _place(doc_id: Column, node: Column) -> Column:
    """What a document is called among components: its id, or else its set."""
    none = doc_id.isNull()
    return F.struct(none.alias("none"), doc_id.alias("id"),
                    F.when(none, node).otherwise(0).alias("node"))


def near_duplicates(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, n, component) of each row of ``docs`` (doc_id, text).

    Two documents link when den * common shingles >= num * all of theirs. The component is the
    smallest doc_id reachable by links, the document's own included. A text without words has n
    0 and links with nothing. Rows with the same id are one document. A row without an id links
    like any other but is nobody's component; if no document it reaches has an id, it has none.
    """
    docs = docs.select("doc_id", "text")
    nodes = cut(_nodes(docs, width))
    links = linked_nodes(docs, nodes.where("node is not null"), width, num, den)
    # Sets are chained to each other by links, and to ids by their rows.
    owners = nodes.where("node is not null and doc_id is not null")
    firsts = nodes.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("id"))
    # A set without an id stands for itself, after all ids.
    ids = cut(firsts.select("node", _place(F.col("id"), F.col("node")).alias("first")))
    pairs = (
        links.join(ids.select(F.col("node").alias("a"), F.col("first").alias("p")), "a")
        .join(ids.select(F.col("node").alias("b"), F.col("first").alias("q")), "b")
        .select(F.col("p").alias("a"), F.col("q").alias("b"))
    )
    # An id with several texts stands in several classes and chains them.
    chained = owners.join(ids, "node").select(
        "doc_id", _place(F.col("doc_id"), F.col("node")).alias("a"), F.col("first").alias("b"))
    repeated = owners.groupBy("doc_id").agg(
        F.min("node").alias("p"), F.max("node").alias("q")).where("p <> q").select("doc_id")
    chained = chained.join(repeated, "doc_id", "left_semi").select("a", "b")
    found = components(pairs.union(chained))
    return (
        nodes.join(ids, "node", "left")
        .join(found.withColumnRenamed("node", "first"), "first", "left")
        .select("doc_id", "n", F.coalesce(
            F.coalesce("component", "first")["id"], "doc_id").alias("component"))
    )


def without_duplicates(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """One document of each group, that with the smallest id, as it came.

    Documents without an id come first, those with the same id in the order of a hash of their
    texts; of rows equal in both one stays. Texts without words stay.
    """
    key = F.struct(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("id"),
        F.xxhash64("text").alias("hash"))
    found = near_duplicates(docs.select(key.alias("doc_id"), "text"), width, num, den)
    kept = found.where(F.col("doc_id") == F.col("component")).select(
        F.col("doc_id.id").alias("__id"), F.col("doc_id.hash").alias("__hash")).distinct()
    same = Window.partitionBy("__id", "__hash").orderBy(F.lit(1))
    rows = (
        wrapped(docs, "doc_id", "text")
        .withColumn("__id", key["id"]).withColumn("__hash", key["hash"])
        .join(kept, ["__id", "__hash"], "left_semi")
        .withColumn("__number", F.row_number().over(same)).where("__number = 1")
    )
    return unwrapped(rows, docs.columns)
