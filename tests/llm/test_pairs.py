"""Search, near duplicates and repeated strings against brute force."""

import hashlib

import brute
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from filingpanel.llm import jaccard_join, norm_search, suffix_dedup
from filingpanel.llm.components import components

DOCS = "doc_id long, text string"


@pytest.mark.parametrize("words, num, den", [(3, 90, 100), (5, 80, 100)])
def test_jaccard_join_equals_brute_force(spark, words, num, den):
    rows = brute.edited_texts(words)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found = jaccard_join.linked_documents(docs, jaccard_join.Rule(words, num, den)).collect()
    assert sorted(map(tuple, found)) == brute.components(rows, words, num, den)


def test_jaccard_join_with_frequent_ngrams_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SAMPLED", 2)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 4)
    rows = brute.edited_texts(11, families=20)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    found = jaccard_join.linked_documents(docs, jaccard_join.Rule(3, 80, 100)).collect()
    assert sorted(map(tuple, found)) == brute.components(rows, 3, 80, 100)


def test_candidates_of_two_labels_come_together():
    rule, rng = jaccard_join.Rule(5, 80, 100), np.random.default_rng(6)
    base = rng.integers(0, 2**63, 4000, np.uint64)
    points = [jaccard_join.point_of(base[: 4000 - k]).tobytes() for k in range(6)]
    for order in (range(6), range(5, -1, -1), rng.permutation(6)):
        batch = pd.DataFrame({"node": np.arange(6), "label": [0, 0, 0, 3, 3, 3], "point": points, "block": 0, "i": 0, "j": 0}).iloc[list(order)]
        found = jaccard_join._searched(batch, rule, None)
        assert len(found) == 5 and set(found["a"]) | set(found["b"]) == set(range(6))


def test_jaccard_join_of_long_documents_in_linked_components(spark):
    rule, rows = jaccard_join.Rule(5, 80, 100), brute.linked_families()
    expected = brute.components(rows, 5, 80, 100)
    assert len({c for _, _, c in expected}) == len(rows) // 8
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert sorted(map(tuple, jaccard_join.linked_documents(docs, rule).collect())) == expected


def test_bound_of_the_tree_never_misses(spark):
    rule, rng = jaccard_join.Rule(3, 80, 100), np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(300)]
    points = np.stack([jaccard_join.point_of(s) for s in sets])
    tree = jaccard_join.CountTree(points, rule)
    for i, own in enumerate(sets):
        found = set(tree.search(points[i]).tolist())
        assert {j for j, s in enumerate(sets) if jaccard_join.linked(own, s, rule)} <= found


def test_keys_meet_for_every_linked_pair():
    rng = np.random.default_rng(2)
    for rule in (jaccard_join.Rule(3, 90, 100), jaccard_join.Rule(5, 80, 100)):
        frequent = np.sort(rng.integers(0, 2**63, 40, np.uint64))
        for size in (5, 9, 10, 12, 19, 33, 80, 400):
            for _ in range(30):
                a = np.unique(np.concatenate([rng.integers(0, 2**63, size, np.uint64), rng.choice(frequent, rng.integers(0, 20))]))
                b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.06], rng.integers(0, 2**63, rng.integers(0, 1 + size // 12), np.uint64)]))
                if len(b) and jaccard_join.linked(a, b, rule) and not np.array_equal(a, b):
                    keys = [jaccard_join.keys_of(s, rule, frequent) for s in (a, b)]
                    assert np.intersect1d(*keys).size


def test_rows_of_one_id_are_one_document(spark):
    long = " ".join(f"x{i}" for i in range(50))
    rows = [(5, long), (5, "other words here"), (7, "other words here"), (9, long), (None, long), (8, None)]
    found = jaccard_join.linked_documents(spark.createDataFrame(rows, DOCS), jaccard_join.Rule(3, 90, 100)).collect()
    assert sorted((r[0] or -1, r[1], r[2]) for r in found) == [(-1, 48, None), (5, 1, 5), (5, 48, 5), (7, 1, 5), (8, 0, 8), (9, 48, 5)]


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 200)], "a long, b long")
    assert sorted(map(tuple, components(links).collect())) == [(i, 0) for i in range(61)] + [(100, 100), (200, 100)]


@pytest.mark.parametrize("frequent", [1, 4])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    rows = brute.repeating_texts(frequent)
    found = suffix_dedup.without_repeats(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    got = sorted((r[0], r[1], r[2], r[3], hashlib.sha256(r[4]).hexdigest()) for r in found)
    assert got == brute.without_repeats(rows)


def test_near_copies_over_many_buckets(spark):
    """One family of near copies, edited in different places, spread over far more buckets than it has anchors."""
    rng = np.random.default_rng(11)
    base = bytes(rng.integers(97, 123, 700, np.uint8))
    rows = []
    for i in range(60):
        text = bytearray(base)
        for at in rng.integers(0, len(text), rng.integers(0, 4)).tolist():
            text[at] = 65 + i % 3
        rows.append((i, text.decode()))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = suffix_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        corpus = suffix_dedup.Corpus(spark.createDataFrame(rows, "doc_id long, text string"))
        open_runs = corpus.compared(corpus.met().where("not repeat").select("k", "sub", "a", "s", "e")).where("span IS NOT NULL")
        n, strings = open_runs.agg(F.count("*"), F.sum(F.expr("e - s + 1"))).first()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    got = sorted((r[0], r[1], r[2], r[3], hashlib.sha256(r[4]).hexdigest()) for r in found)
    assert got == brute.without_repeats(rows)
    assert n > 0 and strings > 2 * n  # a row for each run between edits, not for each string


def test_blocks_cut_long_documents(monkeypatch):
    suffix_dedup._tables.cache_clear()
    blob = bytes(np.random.default_rng(3).integers(97, 101, 5000, np.uint8))
    whole = suffix_dedup.anchors_of([blob])
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    cut = suffix_dedup.anchors_of([blob])

    def starts(x):
        return {(s, a, h) for _, first, last, a, h, _ in zip(*map(np.ndarray.tolist, x)) for s in range(first, last + 1)}

    assert {s for s, _, _ in starts(whole)} == set(range(len(blob) - 99)) and starts(whole) == starts(cut)
    monkeypatch.undo()
    suffix_dedup._tables.cache_clear()


def test_multikey_quicksort_orders_rows():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3, (500, 6)).astype(np.uint64)
    order = suffix_dedup.multikey_order(words)
    assert words[order].tolist() == sorted(words.tolist())


def test_repeated_rows_are_removed_but_one(spark):
    text = "".join(f"{i:04d}" for i in range(40))
    rows = [(3, text), (3, text), (None, text), (3, text[:120]), (4, "short")]
    found = suffix_dedup.without_repeats(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r[0] or -1, r[1], r[2], r[3]) for r in found) == [(-1, 160, 0, 0), (3, 120, 120, 1), (3, 160, 160, 1), (3, 160, 160, 1), (4, 5, 0, 0)]


def _products(rows, queries, k):
    out = []
    for q, a in queries:
        scored = sorted((-sum(int(x) * int(y) for x, y in zip(a, v)), i) for i, v in rows if i != q and len(v) == len(a))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed, spread, common", [(1, 0.0, 0), (2, 1.5, 0), (3, 0.3, 60)])
def test_search_equals_brute_force(spark, monkeypatch, seed, spread, common):
    monkeypatch.setattr(norm_search, "BLOCK_NUMBERS", 8 * 50)
    monkeypatch.setattr(norm_search, "SEED_ROWS", 30)
    rng = np.random.default_rng(seed)
    vectors = np.floor(rng.normal(size=(260, 8)) * 100 * np.exp(rng.normal(size=(260, 1)) * spread))
    vectors[:common] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, [0.0] * 8), (901, [1.0, 2.0]), (902, [3.0, 4.0]), (903, [])]
    everything = rows + [(904, None), (905, [1.0, None] + [0.0] * 6), (906, [float("nan")] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(everything, "vec_id long, vector array<double>").repartition(4)
    found = norm_search.top_products(df, df.where("vec_id % 10 = 0 or vec_id > 899"), 3)
    assert sorted(map(tuple, found.collect())) == _products(rows, [r for r in rows if r[0] % 10 == 0 or r[0] > 899], 3)


def test_coordinate_pruning_keeps_every_hit():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 6)) * np.array([5, 3, 1, 1, 1, 1])
    bucket = norm_search.Bucket(np.arange(400), vectors)
    for query in rng.normal(size=(50, 6)):
        length = float(np.sqrt((query**2).sum()))
        scores = bucket.vectors @ query
        threshold = float(np.sort(scores)[-5])
        kept = np.zeros(400, bool)
        kept[bucket.candidates(query, length, threshold)] = True
        assert kept[scores >= threshold].all()


def test_products_beyond_exact_doubles(spark):
    big = 2.0**40
    rows = [(0, [big, 1.0]), (1, [big, 3.0]), (2, [big, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    found = norm_search.top_products(df, df.where("vec_id = 0"), 2).collect()
    assert [tuple(r) for r in sorted(found)] == [(0, 1, 1, 2**63 - 1), (0, 2, 2, 2**63 - 1)]


def test_words_that_polynomials_take_for_one_another_stay_apart(spark):
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(i, f"{w[:n]} x y z") for n in (512, 1024, 2048) for i, w in ((n, word), (n + 1, word.translate(str.maketrans("ab", "ba"))))]
    found = jaccard_join.linked_documents(spark.createDataFrame(rows, DOCS), jaccard_join.Rule(3, 90, 100)).collect()
    assert sorted(map(tuple, found)) == brute.components(rows, 3, 90, 100)
    assert all(r["component_id"] == r["doc_id"] for r in found)
