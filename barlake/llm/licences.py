"""Licence scan by a positional index of rare words, in DataFrame functions only.

The words of the licence templates and base phrases are ranked by document frequency over all
files. A text of n words that needs k of them at their places is looked up by its n - k + 2 rarest
words: wherever it stands, at least two of these do. The index lists for each such word the texts
and the places in them. A file's places of these words, less the places in the texts, give offsets;
those on which two words or more agree are the candidates. There the mandatory phrase is verified
word by word, and the share of template words that stand at theirs is the score, of which
MIN_SHARE is enough. Nothing that counts is missed, whatever the frequencies.

Base phrases are counted wherever their words stand consecutively.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import NO_ALNUM, ascii_lower, words

# The base phrases of the contract and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Label, template (opening words of public licence notices), mandatory phrase.
TEMPLATES = (
    ("agpl", "licensed under the gnu affero general public license version 3",
     "affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "you may not use this file except in compliance with the license you may obtain "
     "a copy of the license at http www apache org licenses license 2 0", "apache org licenses"),
    ("bsd", "redistribution and use in source and binary forms with or without modification "
     "are permitted provided that the following conditions are met",
     "source and binary forms"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("cc-by", "licensed under cc by", "cc by"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related "
     "rights to this work under cc0 1 0", "waived all copyright"),
    ("gpl", "this work is licensed under the gnu general public license version 3",
     "general public license"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation", "general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with "
     "or without fee is hereby granted", "with or without fee"),
    ("lgpl", "licensed under the gnu lesser general public license version 3",
     "lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files", "permission is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
    ("reserved", "all rights reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software"),
)
MIN_SHARE = 0.6


@dataclass(frozen=True)
class Known:
    """A template or base phrase: its words, those that must stand, where these begin in it, and
    how many words have to stand at their places."""

    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    key_at: int
    need: int

    def rarest(self, ranked: list[str]) -> list[int]:
        """Places of the words that it is looked up by."""
        order = sorted(range(len(self.words)), key=lambda i: (ranked.index(self.words[i]), i))
        return order[:len(self.words) - self.need + 2]


def _template(label: str, text: str, phrase: str) -> Known:
    own, key = tuple(text.split()), tuple(phrase.split())
    at = next(i for i in range(len(own)) if own[i:i + len(key)] == key)
    need = next(k for k in range(2, len(own) + 1) if k / len(own) >= MIN_SHARE)
    return Known(label, own, key, at, need)


KNOWN = [_template(*t) for t in TEMPLATES]
PHRASES = [Known(label, tuple(p.split()), tuple(p.split()), 0, len(p.split()))
           for p, label in BASE.items()]


def vocabulary() -> list[str]:
    return sorted({w for k in [*KNOWN, *PHRASES] for w in k.words})


def file_words(text: Column) -> Column:
    return words(ascii_lower(text), NO_ALNUM)


def _texts(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def ranked_vocabulary(files: DataFrame, text_col: str) -> list[str]:
    """The licence words, rarest first, by the number of files that hold them. Their number is
    that of the templates' words, whatever the number of files."""
    known = F.array_intersect(_texts(vocabulary()), file_words(F.col(text_col)))
    counts = files.select(F.explode(known).alias("word")).groupBy("word").count().collect()
    held = {r["word"]: r["count"] for r in counts}
    return sorted(vocabulary(), key=lambda w: (held.get(w, 0), w))


def _stands(at: Column, phrase: tuple[str, ...], skip: int = 0) -> Column:
    """The words of the phrase stand from place ``at`` + skip on."""
    return reduce(and_, [F.get("__w", (at + skip + i).cast("int")).eqNullSafe(F.lit(w))
                         for i, w in enumerate(phrase)])


def _candidates() -> Column:
    """(text, offset) of the texts in [*KNOWN, *PHRASES] on which two looked-up words of a file
    agree at least; ``__hits`` are the sorted offsets that each of them gives."""
    return F.array_distinct(F.filter(
        "__hits", lambda hit, i: hit == F.get("__hits", (i + 1).cast("int"))))


def _postings(ranked: list[str]) -> dict[str, list[tuple[int, int]]]:
    """Per looked-up word the texts and the places in them."""
    out = defaultdict(list)
    for e, known in enumerate([*KNOWN, *PHRASES]):
        for place in known.rarest(ranked):
            out[known.words[place]].append((e, place))
    return dict(out)


def _hits(postings: dict[str, list[tuple[int, int]]]) -> Column:
    index = F.create_map(*[x for word, own in sorted(postings.items()) for x in (
        F.lit(word), F.array(*[F.struct(F.lit(e).alias("e"), F.lit(p).alias("p"))
                               for e, p in own]))])
    each = F.transform("__at", lambda spot: F.transform(
        F.element_at(index, spot["w"]),
        lambda own: F.struct(own["e"].alias("e"), (spot["i"] - own["p"]).alias("o"))))
    return F.array_sort(F.flatten(each))


def _offsets(e: int, known: Known) -> Column:
    """Offsets at which a text is a candidate and its mandatory words stand."""
    own = F.transform(F.filter("__found", lambda c: c["e"] == e), lambda c: c["o"])
    return F.filter(own, lambda o: _stands(o, known.key, known.key_at))


def _template_score(e: int, known: Known) -> Column:
    """Best share of template words at their places; null if it is too small."""
    def share(o: Column) -> Column:
        equal = [F.when(F.get("__w", (o + i).cast("int")).eqNullSafe(F.lit(w)), 1).otherwise(0)
                 for i, w in enumerate(known.words)]
        return reduce(lambda a, b: a + b, equal) / F.lit(float(len(known.words)))

    best = F.array_max(F.transform(_offsets(e, known), share))
    return F.when(best >= MIN_SHARE, best)


def scanned(files: DataFrame, text_col: str = "text") -> DataFrame:
    """``files`` with __n_words, __places (starts of base phrases), __base and __labels (sorted,
    distinct) and __score (1.0 for a base phrase, else the best template score, else 0).

    A null or empty text has no words, places or labels. Repeated rows are scanned each for
    itself.
    """
    ranked = ranked_vocabulary(files, text_col)
    found = (
        files.withColumn("__w", file_words(F.col(text_col)))
        .withColumn("__n_words", F.size("__w").cast("long"))
        .withColumn("__rare", F.array_intersect(_texts(ranked), F.col("__w")))
    )
    texts, postings = [*KNOWN, *PHRASES], _postings(ranked)
    wanted = reduce(lambda a, b: a | b, [
        reduce(and_, [F.array_contains("__rare", w) for w in key])
        for key in dict.fromkeys(tuple(dict.fromkeys(t.key)) for t in texts)])
    spots = F.filter(F.transform("__w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                     lambda o: o["w"].isin(sorted(postings)))
    # All other files go on without their words.
    found = (
        found.withColumn("__wanted", wanted)
        .withColumn("__w", F.when(F.col("__wanted"), F.col("__w")))
        .withColumn("__at", F.when(F.col("__wanted"), spots))
        .withColumn("__hits", F.when(F.col("__wanted"), _hits(postings)))
        .withColumn("__found", F.when(F.col("__wanted"), _candidates()))
    )
    starts = F.when(F.col("__wanted"), F.array(*[
        F.struct(F.lit(known.label).alias("label"), _offsets(e, known).alias("at"))
        for e, known in enumerate(texts) if e >= len(KNOWN)]))
    matched = F.when(F.col("__wanted"), F.array(*[
        F.struct(F.lit(known.label).alias("label"), _template_score(e, known).alias("score"))
        for e, known in enumerate(KNOWN)]))
    found = found.withColumn("__starts", starts).withColumn("__matched", matched)
    nothing = F.array().cast("array<string>")
    places = F.coalesce(F.flatten(F.transform("__starts", lambda s: s["at"])),
                        F.array().cast("array<int>"))
    base = F.transform(F.filter("__starts", lambda s: F.size(s["at"]) > 0), lambda s: s["label"])
    more = F.transform(F.filter("__matched", lambda m: m["score"].isNotNull()),
                       lambda m: m["label"])
    base, more = F.coalesce(base, nothing), F.coalesce(more, nothing)
    best = F.array_max(F.transform("__matched", lambda m: m["score"]))
    return (
        found.withColumn("__places", places)
        .withColumn("__base", F.array_sort(F.array_distinct(base)))
        .withColumn("__labels", F.array_sort(F.array_distinct(F.concat(base, more))))
        .withColumn("__score", F.when(F.size("__places") > 0, F.lit(1.0))
                    .otherwise(F.coalesce(best, F.lit(0.0))))
        .drop("__w", "__rare", "__wanted", "__at", "__hits", "__found", "__starts", "__matched")
    )
