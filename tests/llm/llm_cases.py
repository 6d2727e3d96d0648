"""Rows that any operator has to bear, and plain versions to compare with."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, shard int, "
          "`__rest` string, `__score` double, n long, `odd name` string")


def odd_documents(spark, texts=()):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing columns."""
    long = " ".join(f"word{i % 997} Größe{i % 13}" for i in range(30_000))
    rows = [
        (1, "a plain text of some words", "en", "s1"), (1, "a plain text of some words", "en", "s1"),
        (1, "another text with the same id", "en", "s2"), (None, "a text without an id", "en", "s1"),
        (None, "a text without an id", "en", "s1"), (None, None, None, None), (2, None, "en", "s1"),
        (3, "", "en", "s2"), (4, " \t\n", None, "s2"), (5, long, "de", None), (6, long, "de", "s3"),
        (7, "\x00\x1f ÅÉ日本語 \U0001f600 end", "xx", ""), (8, "Word", "en", "s2"),
        (9, "a plain text of some words", "en", "s3"),
    ]
    rows += [(100 + i, t, "en", f"s{i % 3}") for i, t in enumerate(texts)]
    return spark.createDataFrame(
        [(*r, i, 7, "rest", 0.5, None, "x") for i, r in enumerate(rows)], SCHEMA)


def no_documents(spark):
    return odd_documents(spark).where("false")


def words(text, pattern):
    return pattern.findall((text or "").translate(ASCII_LOWER))


def shingles(text, width):
    w = words(text, BLANK)
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


class Groups:
    def __init__(self):
        self.root = {}

    def find(self, x):
        while self.root.get(x, x) != x:
            x = self.root[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.root[max(a, b)] = min(a, b)


def near_groups(rows, width, num, den):
    """doc_id -> (size of the set, smallest id reachable), for rows with distinct ids."""
    sets = {i: shingles(t, width) for i, t in rows}
    groups, holders = Groups(), defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if den * n >= num * (len(sets[i]) + len(sets[j]) - n):
                groups.join(i, j)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(sets[i]), groups.find(i)) for i in sets}


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def counted(df):
    return Counter(map(str, rows_of(df)))
