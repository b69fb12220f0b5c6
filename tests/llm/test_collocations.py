"""Collocations against a plain count of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingpanel.llm import collocations

DOCS = "doc_id long, text string, lang string"


def brute(rows, least, longest, keep, share):
    counts, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    scored = []
    for (lang, words), a in counts.items():
        if len(words) > 1 and a >= least:
            cuts = [(10**6 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
            score, _, l, r = min(cuts)
            scored.append((lang, words, a, l, r, score))
    hidden = set()
    for (lang, words), f in counts.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if f >= least and 100 * f >= share * counts[lang, words[i : i + k]]:
                    hidden.add((lang, words[i : i + k]))
    out = []
    for lang in sorted({x[0] for x in scored}):
        own = [x for x in scored if x[0] == lang and (lang, x[1]) not in hidden]
        own.sort(key=lambda x: (-x[5], -x[2], " ".join(x[1]).encode()))
        out += [(lang, rank, " ".join(w), a, l, r, total[lang], s) for rank, (_, w, a, l, r, s) in enumerate(own[:keep], 1)]
    return out


def texts(seed, n=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "état", "x_y", "a\x1cb", " ", "日本", "k", "of", "the"]
    marks = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "! ", "\x0b", " \r\n"]
    rows = []
    for i in range(n):
        made = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 60)))
        if rng.random() < 0.3:
            made += "New York City of New York state " * rng.randint(1, 3)
        rows.append((i, made, rng.choice(["en", "en", "fr", None, "und"])))
    return rows + [(None, None, "en"), (7, "", None), (8, "the the the the the the the the the the the the", "en")] * 2 + rows[:5] * 10


@pytest.mark.parametrize("seed, least, longest, shards", [(1, 10, 3, 3), (2, 4, 3, 2), (3, 5, 4, 4), (4, 3, 2, 1)])
def test_collocations_equal_brute_force(spark, monkeypatch, seed, least, longest, shards):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 700)
    rows = texts(seed)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found = collocations.collocations(docs, least, longest, 40, 50, shards)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, least, longest, 40, 50)


def test_shared_slots_and_many_words_change_no_count(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLOT_BITS", 1)
    monkeypatch.setattr(collocations, "FREQUENT_BITS", 2)
    rows = texts(9, 60)
    found = collocations.collocations(spark.createDataFrame(rows, DOCS).repartition(6), 3, 4, 30, 50, 3)
    assert sorted(map(tuple, found.collect())) == brute(rows, 3, 4, 30, 50)


def test_keys_beyond_a_long_are_renumbered():
    whole = [f"w{i}" for i in range(3000)] * 2
    vocabulary, places, n = collocations.numbered([" ".join(whole).encode()])
    frequent = {k: np.ones(16, bool) for k in range(1, 8)}
    batches = collocations.spelled("en", collocations.Chunk("en", vocabulary, places), frequent)
    rows = [(b.column(1)[i].as_py(), b.column(2)[i].as_py(), b.column(3)[i].as_py()) for b in batches for i in range(b.num_rows)]
    assert n == 6000
    for k in range(1, 8):
        expected = Counter(" ".join(whole[i : i + k]).encode() for i in range(len(whole) - k + 1))
        assert {p: n for length, p, n in rows if length == k} == expected


def test_a_phrase_is_counted_once_in_every_shard(spark):
    """What becomes active late is counted in its own cycle, and no longer."""
    rows = [(i, "alpha beta gamma", "en") for i in range(30)]
    docs = spark.createDataFrame(rows, DOCS).repartition(8).withColumns({c: F.lit(1) for c in ("words", "n", "f", "shard", "hash", "scan", "phrase")})
    found, totals = collocations.phrase_counts(docs, least=10, shards=4)
    assert {(r["words"], r["phrase"], r["f"]) for r in found.collect()} == {
        (1, "alpha", 30), (1, "beta", 30), (1, "gamma", 30), (2, "alpha beta", 30), (2, "beta gamma", 30), (3, "alpha beta gamma", 30)
    }
    assert [tuple(r) for r in totals.collect()] == [("en", 90)]


def test_one_very_long_text_and_no_rows(spark):
    text = "one two three four, " * 100_000
    found = collocations.collocations(spark.createDataFrame([(1, text, "en")], DOCS)).collect()
    assert [(r["phrase"], r["a"], r["n"]) for r in found] == [("one two three", 100_000, 400_000), ("two three four", 100_000, 400_000)]
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
