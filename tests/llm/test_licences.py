"""Licence labels and scores against a comparison at every offset."""

import random

from llm_cases import ALNUM, rows_of, words

from barlake.llm import licences
from barlake.llm.common import table


def plain(text):
    """(labels, score): every template at every offset, every base phrase at every place."""
    w = words(text, ALNUM)
    labels, best = set(), 0.0
    for label, template, phrase in licences.TEMPLATES:
        own, key = template.split(), phrase.split()
        at = next(i for i in range(len(own)) if own[i:i + len(key)] == key)
        starts = [i for i in range(len(w)) if w[i:i + len(key)] == key]
        for s in starts:
            o = s - at
            share = sum(0 <= o + i < len(w) and w[o + i] == x for i, x in enumerate(own)) / len(own)
            if share >= licences.MIN_SHARE:
                labels.add(label)
                best = max(best, share)
    for phrase, label in licences.BASE.items():
        p = phrase.split()
        if any(w[i:i + len(p)] == p for i in range(len(w))):
            labels.add(label)
            best = 1.0
    return sorted(labels), best


def _edited(rng):
    """Templates with one word or some inserted, missing or replaced, among other words."""
    out = []
    for _, template, _ in licences.TEMPLATES:
        for edits in (0, 1, 1, 1, 2, 3, 4):
            w = template.split()
            for _ in range(edits):
                k = rng.randrange(len(w))
                rng.choice((lambda: w.insert(k, "font"), lambda: w.pop(k) if len(w) > 1 else None,
                            lambda: w.__setitem__(k, "other")))()
            noise = [rng.choice(["the", "of", "license", "cc", "by", "and", "word", "software"])
                     for _ in range(rng.randrange(30))]
            out.append(" ".join(noise[:12] + w + noise[12:]))
    return out


def scanned(docs):
    return [(r["doc_id"], r["__labels"], round(r["__score"], 9))
            for r in licences.scanned(docs).collect()]


def expected(rows):
    return sorted(str((i, labels, round(score, 9))) for i, labels, score in (
        (i, *plain(t)) for i, t in rows))


def test_edited_templates_equal_every_offset(spark):
    rows = list(enumerate(_edited(random.Random(6))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, scanned(docs))) == expected(rows)
    assert sum(bool(plain(t)[0]) for _, t in rows) > 60


def test_documents_equal_every_offset(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    rows = rows_of(docs)
    got = scanned(docs)
    assert sorted(map(str, got)) == expected(rows)
    assert any(labels for _, labels, _ in got)


def test_any_ranking_finds_the_same(spark, monkeypatch):
    """The words that a text is looked up by follow from the files; its labels must not."""
    rows = list(enumerate(_edited(random.Random(9))))[:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for seed in range(2):
        def shuffled(*_, seed=seed):
            found = licences.vocabulary()
            random.Random(seed).shuffle(found)
            return found

        monkeypatch.setattr(licences, "ranked_vocabulary", shuffled)
        assert sorted(map(str, scanned(docs))) == expected(rows)


def test_a_text_is_looked_up_by_enough_words():
    ranked = licences.vocabulary()
    for known in [*licences.KNOWN, *licences.PHRASES]:
        n = len(known.words)
        assert known.need / n >= licences.MIN_SHARE > (known.need - 1) / n or known.need == n == 2 \
            or known in licences.PHRASES
        # With need words in place, two of the looked-up ones are.
        assert len(known.rarest(ranked)) - (n - known.need) >= 2
