"""Sharding and mixing."""

import struct
import zlib

import duckdb
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import BLANK, no_documents, odd_documents, rows_of, words
from pyspark.sql import functions as F

from barlake.llm import mixing, oracle, queries, sharding

FOLDER = "/root/testdata/sf0.001"


def plain_place(x, n, seed=0):
    a = max(int(-(-n ** 0.5 // 1)), 1)
    b = max(-(-n // a), 1)

    def hashed(value, key):
        first = xxhash.xxh64(struct.pack("<q", value), seed=42).intdigest()
        both = xxhash.xxh64(struct.pack("<q", key), seed=first).intdigest()
        return both - (1 << 64) if both >= 1 << 63 else both

    while True:
        left, right = divmod(x, b)
        for i, key in enumerate(sharding.KEYS):
            if i % 2 == 0:
                left = (left + hashed(right, seed * 1000 + key) % a) % a
            else:
                right = (right + hashed(left, seed * 1000 + key) % b) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1000, 4099])
def test_the_permutation_is_one_and_turns_back(spark, n):
    rows = spark.range(n).select("id", sharding.permuted(F.col("id"), F.lit(n), 5).alias("p"))
    rows = rows.select("id", "p", sharding.permuted(F.col("p"), F.lit(n), 5, True).alias("back"))
    got = rows_of(rows)
    assert sorted(p for _, p, _ in got) == list(range(n)) and all(i == b for i, _, b in got)
    assert all(p == plain_place(i, n, 5) for i, p, _ in got[:200])


def test_shards_are_even_and_slots_have_no_gap(spark):
    got = rows_of(queries.op8_sharding(spark, FOLDER).select(
        "doc_id", "size", "text_crc32", "shard", "slot"))
    texts = dict(rows_of(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")))
    assert all(s == len(texts[d].encode()) + 1 and c == zlib.crc32(texts[d].encode())
               for d, s, c, _, _ in got) and len(got) == len(texts)
    slots = {k: sorted(s for *_, shard, s in got if shard == k) for k in range(16)}
    assert all(s == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    again = rows_of(queries.op8_sharding(spark, FOLDER).repartition(7).select(
        "doc_id", "size", "text_crc32", "shard", "slot"))
    assert sorted(got) == sorted(again)


def test_sharding_odd_documents(spark):
    docs = odd_documents(spark)
    out = sharding.shard_documents(docs, 4)
    kept = [c for c in docs.columns if c != "shard"]
    assert out.columns == [*kept, "shard", "slot"]
    assert sorted(map(str, rows_of(out.select(*[f"`{c}`" for c in kept])))) == sorted(
        map(str, rows_of(docs.select(*[f"`{c}`" for c in kept]))))
    places = sorted(r["slot"] * 4 + r["shard"] for r in out.collect())
    assert places == list(range(docs.count()))
    assert sharding.shard_documents(no_documents(spark)).count() == 0


def filled(words_of, weights, ratio, most):
    """Reshare the excess until no source is above its cap."""
    goal, capped = sum(words_of) * ratio, set()
    while True:
        rest = goal - sum(words_of[i] * most for i in capped)
        open_weight = sum(w for i, w in enumerate(weights) if i not in capped)
        share = [words_of[i] * most if i in capped else rest * weights[i] / open_weight
                 for i in range(len(weights))]
        over = {i for i in range(len(weights)) if share[i] > words_of[i] * most} - capped
        if not over or len(capped | over) == len(weights):
            return [min(s, n * most) for s, n in zip(share, words_of, strict=True)]
        capped |= over


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.sampled_from((5, 2, 1))), min_size=1, max_size=9))
def test_water_filling_equals_resharing(spark, sources):
    rows = [(f"s{i}", n, w) for i, (n, w) in enumerate(sources)]
    df = spark.createDataFrame(rows, "key string, words long, weight int")
    got = {r["key"]: r["target"] for r in mixing.water_filled(df, 1.5, 2.0).collect()}
    expected = filled([n for n, _ in sources], [w for _, w in sources], 1.5, 2.0)
    assert [got[k] for k, _, _ in rows] == pytest.approx(expected)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_mixing_equals_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    df = queries.op7_mixing(spark, folder)
    expected = con.execute(f"SELECT {', '.join(df.columns)} FROM ({oracle.MIXING})").fetchall()
    got = rows_of(df)
    assert sorted(got) == sorted(expected)
    assert all(taken <= 2 * size for _, size, _, _, taken in got)


def test_sources_come_near_their_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), f"s{min(i % 9, 5)}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixed(docs, "source", [F.col("doc_id")], mixing.n_words(F.col("text")))
    sums = found.groupBy("source", "__source_size", "__target").agg(
        F.sum(F.col("__copies") * F.col("__size")).alias("taken")).collect()
    assert len(sums) == 6 and all(abs(r["taken"] - r["__target"]) <= 50 for r in sums)
    mix = mixing.mix_documents(docs)
    sums = dict(rows_of(mix.groupBy("source").agg(F.sum(mixing.n_words(F.col("text"))))))
    targets = dict(rows_of(found.select("source", "__target").distinct()))
    assert all(abs(sums[s] - t) <= 50 for s, t in targets.items())


def test_mixing_odd_documents(spark):
    docs = odd_documents(spark)
    found = mixing.mixed(docs, "source", [F.col("doc_id")], mixing.n_words(F.col("text")))
    got = found.select("text", "__size", "__source_size", "__target", "__copies").collect()
    assert len(got) == docs.count()
    assert all(r["__size"] == len(words(r["text"], BLANK)) and r["__copies"] <= 2 for r in got)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    assert {str(r) for r in out.collect()} <= {str(r) for r in docs.collect()}
    assert mixing.mix_documents(no_documents(spark)).count() == 0
    blank = docs.where("text IS NULL OR trim(text) = ''")
    assert all(r["__target"] == 0 for r in mixing.mixed(
        blank, "source", [F.col("doc_id")], mixing.n_words(F.col("text"))).collect())
