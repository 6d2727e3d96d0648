"""A training corpus from raw documents: five stages over the operators of ``barlake.llm``.

Each stage takes the documents that the one before kept, as written to Parquet, and returns
documents with the same columns; the last adds each one's shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import decontamination, jaccard, mixing, sharding, toxicity
from barlake.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 over five-word shingles, the document
    with the smallest id."""
    return jaccard.without_duplicates(docs, width=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than one word in 20 inside a benchmark window."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in shuffled order, with shard and slot."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
    ("sharding", shard),
]

# A fitted classifier, component labels and seeded hashes are beyond SQL; the tests compare every
# stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
