"""Surrogates of persons who are named again, and of further forms."""

import re

from barlake.llm import pii

PROBE = ("Mrs Anna Smith. Anna Smith said hi. Ms Smith left. Dr John Doe. Call (555) 123-4567 or "
         "555-987-6543. password: p@ss!word9 and DE89 3704 0044 0532 0130 00 at "
         "2001:db8:85a3:0:0:8a2e:370:7334, fe80::1ff:fe23:4567:890a. Smith and Doe, Anna.")


def replaced(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in pii.with_surrogates(df, "k").orderBy("doc_id").collect()]


def test_no_original_part_is_left(spark):
    (out,) = replaced(spark, PROBE)
    for part in ("Anna", "Smith", "John", "Doe", "123", "4567", "987", "6543", "p@ss", "word9",
                 "3704", "0532", "85a3", "7334", "fe23", "890a"):
        assert part not in out, part
    for kept in ("said hi.", "left.", "Call (", " or ", "password: ", " at ", " and "):
        assert kept in out


def test_mentions_of_one_person_agree(spark):
    (out,) = replaced(spark, PROBE)
    given, family = re.match(r"Mrs (\w+) (\w+)\. ", out).groups()
    assert f". {given} {family} said hi. Ms {family} left." in out
    doe = re.search(r"Dr \w+ (\w+)\.", out)[1]
    assert out.endswith(f" {family} and {doe}, {given}.")
    assert given.endswith("a") and len({given, family, doe}) == 3


def test_persons_of_one_family_name_differ(spark):
    out = replaced(spark, "Herr Müller und Frau Müller", "Frau Anna Müller", "Frau Müller",
                   "Müller ohne Titel", "Mrs Mary Jane Watson-Parker, Mary")
    man, woman = re.fullmatch(r"Herr (\w+) und Frau (\w+)", out[0]).groups()
    assert man != woman
    assert out[1].split()[2] == woman == out[2].split()[1]
    # Without a titled mention in the document a word is no name.
    assert out[3] == "Müller ohne Titel"
    parts = re.fullmatch(r"Mrs (\w+) (\w+) (\w+)-(\w+), (\w+)", out[4]) or \
        re.fullmatch(r"Mrs (\w+) (\w+) (\w+)-Parker, (\w+)", out[4])
    assert parts and parts[1] == parts[parts.lastindex] and "Mary" not in out[4]


def test_formats_are_kept(spark):
    old = ["PASSWORD=Abc123XYZ", "call 555.123.4567", "IBAN GB29NWBK60161331926819",
           "host 1:2:3:4:5:6:7:8", "at 12:30:45 or 1:2"]
    new = replaced(spark, *old)
    assert re.fullmatch(r"PASSWORD=[A-Z][a-z]{2}\d{3}[A-Z]{3}", new[0]) and new[0] != old[0]
    assert re.fullmatch(r"call \d{3}\.\d{3}\.\d{4}", new[1]) and new[1] != old[1]
    assert re.fullmatch(r"IBAN GB\d{2}[A-Z]{4}\d{14}", new[2]) and new[2] != old[2]
    assert re.fullmatch(r"host ([0-9a-f]{4}:){7}[0-9a-f]{4}", new[3])
    assert new[4] == old[4]


def test_long_texts_are_read_whole(spark):
    filler = "plain words without any number. " * 20_000
    (out,) = replaced(spark, f"Dr Ada Lovelace. {filler}Lovelace at 8.8.8.8 ends")
    name = re.match(r"Dr \w+ (\w+)\. ", out)[1]
    assert filler in out and re.search(rf"{name} at [0-9.]+ ends$", out) and "8.8.8.8" not in out
