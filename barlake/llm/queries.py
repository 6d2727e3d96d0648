"""One query per operator over its whole table, and the SQL texts for those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import (
    decontamination,
    embeddings,
    html,
    jaccard,
    licences,
    mixing,
    negatives,
    periods,
    pii,
    pitmanyor,
    sharding,
    suffixes,
    toxicity,
)
from barlake.llm.common import n_bytes, table, text_crc


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.deduplicated(docs).select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
        .alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs, machine)
    return found.select(
        "doc_id", toxicity.held_out().alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.with_surrogates(docs, key="op5").select(
        "doc_id", "text", F.col("__entities").alias("n_entities"))


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard.near_duplicates(docs, width=3, num=90, den=100).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    slim = docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    order = [F.col("doc_id"), F.col("size")]
    return mixing.mixed(slim, "source", order, F.col("size")).select(
        "doc_id", "size", F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__copies") * F.col("size")).cast("long").alias("taken"),
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: counts differ by one at most. Copies of a text are spread like any rows."""
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    slim = docs.select(
        "doc_id", (n_bytes(text) + 1).alias("size"), text_crc(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    order = [F.col(c) for c in ("doc_id", "size", "text_crc32", "text_hash")]
    return sharding.placed(slim, order).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scanned(docs).select(
        "doc_id", F.col("__n_words").alias("n_words"),
        F.size("__places").cast("long").alias("n_base"),
        F.array_min("__places").cast("long").alias("first_word"),
        F.array_max("__places").cast("long").alias("last_word"),
        F.array_join("__base", ",").alias("base_labels"),
        F.array_join("__labels", ",").alias("labels"),
        F.col("__score").alias("score"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.marked(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("__words").alias("n_words"),
        decontamination.n_hit().alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("__items"), ","), 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pitmanyor.scored(docs).select(
        "doc_id", pitmanyor.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(negatives.shifted_labels(table(spark, sf_dir, "embeddings")))


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    best = F.col("__best")
    return periods.with_runs(periods.planted(docs)).withColumn("__best", periods.longest()).select(
        "doc_id", F.size("__runs").cast("long").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * __best.length div __best.period").alias("exponent_milli"),
        F.sha2(periods.runs_text(), 256).alias("runs_sha256"),
        F.sha2("__collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_embeddings": op1_embeddings,
    "op2_html": op2_html,
    "op3_suffixes": op3_suffixes,
    "op4_toxicity": op4_toxicity,
    "op5_pii": op5_pii,
    "op6_jaccard": op6_jaccard,
    "op7_mixing": op7_mixing,
    "op8_sharding": op8_sharding,
    "op9_licences": op9_licences,
    "op10_decontamination": op10_decontamination,
    "op11_language_model": op11_language_model,
    "op12_negatives": op12_negatives,
    "op13_periods": op13_periods,
}
