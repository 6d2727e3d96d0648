"""The corpus pipeline, stage by stage, and the registration."""

import corpus_pipeline
import duckdb
import __spark_entry__ as entry_point
import pytest
from llm_cases import ALNUM, BLANK, counted, near_groups, no_documents, odd_documents, rows_of, words
from test_texts import plain_hits

from barlake.llm import oracle, toxicity
from barlake.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = list(entry_point.queries())
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))
    assert set(entry_point.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = entry_point.queries()[name](spark, FOLDER)
    expected = con.execute(f"SELECT {', '.join(df.columns)} FROM ({oracle.SQL[name]})").fetchall()
    assert sorted(map(str, rows_of(df))) == sorted(map(str, expected)) and expected


def test_stages_equal_plain_versions(spark):
    docs = table(spark, FOLDER, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)

    kept = stages["toxicity"](spark, docs, FOLDER)
    machine = toxicity.learned(docs, table(spark, FOLDER, "labels"))
    scores = {d: machine.score(toxicity.text_terms([t.encode()])[0])
              for d, t in rows_of(docs.select("doc_id", "text"))}
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, s in scores.items() if s < 0.3}

    rows = rows_of(docs.select("doc_id", "text"))
    kept = stages["near_duplicates"](spark, docs, FOLDER)
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.collect()} == {
        c for _, c in near_groups(rows, 5, 80, 100).values()}

    items = rows_of(table(spark, FOLDER, "benchmark").select("item_id", "text"))
    kept = stages["decontamination"](spark, docs, FOLDER)
    grams = {tuple(words(t, ALNUM)[i:i + 13]) for _, t in items
             for i in range(len(words(t, ALNUM)) - 12)}
    clean = set()
    for d, t in rows:
        w = words(t, ALNUM)
        held = [(d, " ".join(g)) for g in {tuple(w[i:i + 13]) for i in range(len(w) - 12)} & grams]
        n, hit, _ = plain_hits(t, held)
        if not hit or 20 * hit < n:
            clean.add(d)
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == clean

    mix = stages["mixing"](spark, docs, FOLDER)
    assert mix.columns == columns and set(counted(mix).values()) <= {1, 2}
    total = sum(len(words(t, BLANK)) for _, t in rows)
    assert abs(sum(len(words(r["text"], BLANK)) for r in mix.collect()) / total - 1.5) < 0.25

    shards = stages["sharding"](spark, docs, FOLDER)
    assert shards.columns == [*columns, "shard", "slot"]
    assert counted(shards.select(*columns)) == counted(docs)


def test_the_run_is_all_stages_and_repeats(spark):
    once, twice = (corpus_pipeline.run(spark, FOLDER) for _ in range(2))
    assert counted(once) == counted(twice) and once.count() > 0
    docs = table(spark, FOLDER, "documents")
    assert set(counted(once.select(*docs.columns))) <= set(counted(docs))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_stages_bear_odd_and_no_documents(spark, tmp_path):
    labels = spark.createDataFrame([(1, 0), (None, 1)], "doc_id long, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench = spark.createDataFrame([(1, "x y z"), (None, None)], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for docs in (odd_documents(spark), no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            kept = [c for c in docs.columns if name != "sharding" or c != "shard"]
            assert out.columns[:len(kept)] == kept
            got = counted(out.select(*[f"`{c}`" for c in kept]))
            assert set(got) <= set(counted(docs.select(*[f"`{c}`" for c in kept])))
