"""Decontamination, toxicity and licences."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from llm_cases import ALNUM, no_documents, odd_documents, rows_of, words
from pyspark.sql import functions as F

from barlake.llm import decontamination, licences, oracle, queries, toxicity

FOLDER = "/root/testdata/sf0.001"


def benchmark(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_decontamination_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.01/{name}.parquet'")
    df = queries.op10_decontamination(spark, "/root/testdata/sf0.01")
    expected = con.execute(
        f"SELECT {', '.join(df.columns)} FROM ({oracle.DECONTAMINATION})").fetchall()
    assert sorted(rows_of(df)) == sorted(expected)
    assert any(r["contaminated"] for r in df.collect())


def plain_hits(text, items, n=13):
    w, hit, found = words(text, ALNUM), set(), set()
    for item, t in items:
        b = words(t, ALNUM)
        size = min(n, len(b))
        for k in range(len(b) - size + 1) if size else ():
            for i in range(len(w) - size + 1):
                if w[i:i + size] == b[k:k + size]:
                    hit.update(range(i, i + size))
                    found |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(found)


def test_decontamination_in_blocks_equals_brute_force(spark):
    rng = random.Random(3)
    text = [" ".join(rng.choice("abcde") for _ in range(40)) for _ in range(30)]
    items = [(i, " ".join(rng.choice("abcde") for _ in range(n)))
             for i, n in enumerate((14, 3, 2, 15, 1, 4, 0, 5))]
    items += [(8, text[3][10:50]), (8, text[3][10:50]), (None, text[4][:40]), (9, None)]
    docs = odd_documents(spark, [*text, "x " + text[3].upper().replace(" ", "--") + "! y"])
    bench = benchmark(spark, *items)
    expected = sorted((str(r["text"]), *map(str, plain_hits(r["text"], items)))
                      for r in docs.collect())
    for block in (200_000, 10):
        found = decontamination.marked(docs, bench, block_windows=block).select(
            "text", "__words", decontamination.n_hit(), "__items")
        assert sorted(tuple(map(str, r)) for r in rows_of(found)) == expected


def test_contaminated_documents_and_spans_go(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    docs = odd_documents(spark, [
        f"Before. {passage.title()}! After", " ".join(f"w{i}" for i in range(400)) + " " + passage])
    bench = benchmark(spark, (1, passage))
    kept = decontamination.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    clean = decontamination.without_spans(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[100] == "Before. ! After" and texts[101].endswith("w399 ")
    for empty in (benchmark(spark).where("false"), benchmark(spark, (1, None), (2, "..."))):
        assert decontamination.without_contaminated(docs, empty).count() == docs.count()
    assert decontamination.without_contaminated(no_documents(spark), bench).count() == 0
    assert decontamination.without_spans(no_documents(spark), bench).count() == 0


def test_items_digest(spark):
    got = queries.op10_decontamination(spark, FOLDER).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert all((r["items_sha256"] == none) == (r["n_items"] == 0) for r in got)


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    labels = dict(rows_of(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")))
    got = [r for r in queries.op4_toxicity(spark, folder).collect() if r["doc_id"] in labels]
    held = [(r["score"], labels[r["doc_id"]]) for r in got if r["held_out"]]
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    order = np.argsort(np.argsort([s for s, _ in held]))
    y = np.array([t for _, t in held])
    auc = (order[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))
    hit = np.array([s >= 0.3 for s, _ in held])
    assert auc > 0.95 and (hit & (y == 1)).sum() / y.sum() > 0.8
    assert (hit & (y == 0)).sum() / (y == 0).sum() < 0.03


def test_pairs_count_for_more_than_their_words():
    """Either word alone is harmless in half of its texts; both together are toxic."""
    rng = random.Random(1)
    texts, labels = [], []
    for _ in range(4000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        filler = [f"f{rng.randrange(40)}" for _ in range(6)]
        texts.append(" ".join(filler + ["insultword"] * insult + ["groupname"] * group).encode())
        labels.append(float(insult and group))
    terms = toxicity.text_terms(texts)
    machine = toxicity.fit(terms[:3000], np.array(labels[:3000]))
    scores = np.array([machine.score(t) for t in terms[3000:]])
    assert ((scores >= 0.5) == (np.array(labels[3000:]) == 1)).mean() > 0.95


def test_toxicity_of_odd_documents(spark):
    docs = odd_documents(spark, [f"clean words number{i}" for i in range(60)] +
                         [f"awful trash number{i}" for i in range(60)])
    ids = [r["doc_id"] for r in docs.collect() if r["doc_id"] is not None]
    marks = [(i, int(160 <= i < 220)) for i in set(ids)] + [(1, None), (None, 1), (999, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    out = toxicity.without_toxic(docs, labels)
    left = {r["doc_id"] for r in out.collect()}
    assert out.columns == docs.columns and not left & set(range(160, 220))
    assert set(range(100, 160)) <= left
    scored = toxicity.scored(docs.select("doc_id", "text"), toxicity.learned(docs, labels))
    assert all(0 <= r["__score"] <= 1 for r in scored.collect()) and scored.count() == docs.count()
    for none in (labels.where("false"), labels.where("toxic = 0")):
        assert toxicity.without_toxic(docs, none).count() in (0, docs.count())
    assert toxicity.without_toxic(no_documents(spark), labels).count() == 0


def test_held_out_rows_and_other_columns_teach_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic"))
                               .otherwise(F.col("toxic")))
    one, two = toxicity.learned(docs, labels), toxicity.learned(docs, turned)
    assert (one.weights == two.weights).all() and one.bias == two.bias
    assert toxicity.learned(docs.withColumn("source", F.lit("x")), labels).shift == one.shift


def plain_places(text):
    w, places, labels = words(text, ALNUM), [], set()
    for phrase, label in licences.BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), \
        ",".join(sorted(labels))


def test_base_phrases_equal_brute_force(spark):
    texts = dict(rows_of(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")))
    got = queries.op9_licences(spark, FOLDER).collect()
    assert len(got) == len(texts) and any(r["n_base"] for r in got)
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"],
                r["base_labels"]) == plain_places(texts[r["doc_id"]])
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_a_word_before_the_rarest_ones_hides_no_template(spark):
    begin = "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    texts = [f"{begin}FONT software and associated documentation files",
             *[f"{begin}software and"] * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["__labels"], r["__score"]) for r in licences.scanned(docs).collect()}
    own = next(t.split() for _, t, k in licences.TEMPLATES if k.startswith("permission is"))
    assert got[0] == (["mit"], own.index("software") / len(own))
    assert got[1] == got[2] == got[3] == (["mit"], (own.index("software") + 2) / len(own))


def test_templates_are_found_by_their_rare_words(spark):
    texts = [
        ("Some code.\nReleased under the MIT License. All rights reserved", "mit,reserved", 1.0),
        ("Licensed under CC-BY-NC 4.0, and CC BY", "cc-by,cc-by-nc", 1.0),
        ("redistribution or use in source and binary forms, with or without modification are "
         "permitted if the following conditions are met", "bsd", None),
        ("the license of the public, of the general, under the mit", "", 0.0),
        ("licensed under the apache license version 2 0 x cc by", "apache,cc-by", 1.0),
        ("mit license mit license", "", 0.0),
    ]
    docs = odd_documents(spark, [t for t, _, _ in texts])
    got = {r["doc_id"]: r for r in licences.scanned(docs.select("doc_id", "text")).collect()}
    for i, (text, labels, score) in enumerate(texts):
        row = got[100 + i]
        assert ",".join(row["__labels"]) == labels, (text, row)
        assert row["__score"] == score if score is not None else 0.6 <= row["__score"] < 1


def test_licences_of_odd_documents(spark):
    docs = odd_documents(spark, ["cc by"]).select("doc_id", "text")
    got = licences.scanned(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        n, places, *_ = plain_places(r["text"])
        assert (r["__n_words"], len(r["__places"])) == (n, places)
    assert licences.scanned(no_documents(spark)).count() == 0


@pytest.mark.parametrize("name", ["op7_mixing", "op8_sharding", "op9_licences"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def _texts_of_two_marks(rng, n, toxic):
    """Texts of common words, half of them with one marked word, half with the other."""
    rows = []
    for k in range(n):
        marks = [rng.random() < 0.5 for _ in range(2)]
        w = [f"word{rng.randrange(300)}" for _ in range(rng.randrange(8, 30))]
        w += [m for m, there in zip(("insult", "people"), marks, strict=True) if there]
        rng.shuffle(w)
        rows.append((k, " ".join(w), int(toxic(*marks))))
    return rows


@pytest.mark.parametrize("name, toxic", [("one of two", lambda a, b: a != b),
                                         ("both", lambda a, b: a and b)])
def test_words_that_tell_only_together_are_learned(spark, name, toxic):
    """Of two marked words neither says anything alone, or only a part."""
    rows = _texts_of_two_marks(random.Random(5), 4000, toxic)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    machine = toxicity.learned(docs, labels)
    truth = {i: t for i, _, t in rows}
    scored = toxicity.scored(docs, machine).where(toxicity.held_out()).select("doc_id", "__score")
    score = {1: [], 0: []}
    for i, s in rows_of(scored):
        score[truth[i]].append(s)
    assert len(score[1]) > 150 and min(score[1]) > max(score[0])
    assert sum(s >= toxicity.THRESHOLD for s in score[1]) > 0.95 * len(score[1])


def test_no_pair_is_found_among_words_without_meaning():
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 200, 40)).encode() for _ in range(3000)]
    rows = toxicity.text_terms(texts)
    labels = (rng.random(len(rows)) < 0.2).astype(float)
    assert not len(toxicity._paired(rows, labels, np.full(len(rows), -1.4)))
