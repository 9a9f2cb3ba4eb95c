"""Phrase counts and ranks against counting every phrase of every text."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from gridlake.llm import collocations as co

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def pieces_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n\v\f\r]", lower)]


def counts_of(rows):
    counts = {}
    for text, lang in rows:
        own = counts.setdefault(lang or "und", Counter())
        for words in pieces_of(text):
            for n in range(1, 5):
                own.update(" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
    return counts


def expected(rows, min_count, per_lang):
    out = []
    for lang, f in counts_of(rows).items():
        total = sum(c for p, c in f.items() if " " not in p)
        found = []
        candidates = {p: c for p, c in f.items() if " " in p and c >= min_count}
        for phrase, a in candidates.items():
            words = phrase.split(" ")
            if any(f" {phrase} " in f" {p} " and p != phrase and 100 * c >= 80 * a for p, c in candidates.items()):
                continue
            cuts = []
            for k in range(1, len(words)):
                left, right = f[" ".join(words[:k])], f[" ".join(words[k:])]
                cuts.append((2000000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, phrase.encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:per_lang], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out)


def rows_of(kind):
    rng = random.Random(13)
    vocabulary = ["the", "The", "of", "new", "york", "élan", "ß", "x\x00y", "a\xa0b", "日本", "q" * 40, "times"]
    if kind == "edges":
        return ([(None, "en"), ("", "en"), (" \t ", None), ("one", None), ("A a A a, a. a\ta", None)] * 3
                + [("New York Times! new york times", "en")] * 4 + [("new york\ntimes new york", "und")] * 3)
    if kind == "periodic":
        return [("so it goes " * 4000, "en"), ("no " * 3000 + "yes", "en"), ("b;" * 500, "en")]
    rows = []
    shared = " ".join(rng.choice(vocabulary) for _ in range(70))
    for _ in range(40):
        text = "".join(rng.choice(vocabulary) + rng.choice([" "] * 8 + ["  ", "\t", ", ", ".", "\n", " ! "])
                       for _ in range(rng.choice([3, 30, 300])))
        rows.append((text + rng.choice(["", shared]), rng.choice(["en", "de", None, "und"])))
    return rows + rows[:5]


@pytest.mark.parametrize("kind", ["random", "edges", "periodic"])
def test_against_brute_force(spark, kind):
    rows = rows_of(kind)
    docs = spark.createDataFrame(rows, "text string, lang string").selectExpr(
        "*", "1 as chunk", "'w' as weight", "2 as own", "'p' as phrase").repartition(3)
    found = co.collocations(docs, min_count=3, per_lang=25)
    assert found.columns == COLUMNS
    assert sorted(tuple(r) for r in found.collect()) == expected(rows, 3, 25)


def test_empty_table(spark):
    assert co.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_dictionary_covers_every_word_once(spark):
    rows = rows_of("random")
    docs = spark.createDataFrame(rows, "text string, lang string")
    chunks = co.chunk_dictionary(docs).collect()
    assert sum(c.own * c.weight for c in chunks) == sum(len(p) for text, _ in rows for p in pieces_of(text))
    assert max(c.weight for c in chunks) > 5  # the shared passage is cut alike
    assert all(0 <= len(re.split("[ \n]", c.chunk)) - c.own <= co.LONGEST - 1 for c in chunks)


def test_counts_beyond_64_bits_are_scored_exactly(spark):
    big = 4 * 10 ** 18
    counts = spark.createDataFrame([("en", "a", big), ("en", "b", big + 7), ("en", "a b", big - 1)],
                                   "lang string, phrase string, f long")
    found = co.scored(counts).first()
    assert found.score == 2000000 * (big - 1) // (2 * big + 7)


def test_words_of_long_texts_hash_alike(monkeypatch):
    """A text above the slab size is hashed in parts."""
    text = b" ".join(b"w%d" % (i % 999) for i in range(5000))
    whole = co.Words([text]).hash
    monkeypatch.setattr(co, "SLAB", 100)
    assert np.array_equal(co.Words([text]).hash, whole)
