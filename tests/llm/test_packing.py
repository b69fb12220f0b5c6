"""Packing against best-fit decreasing one piece at a time, and against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingpanel.llm import packing, queries
from filingpanel.llm.tokenizer_file import read_file

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizer_text():
    return read_file(queries.tokenizer_path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library(tokenizer_text):
    return pytest.importorskip("tokenizers").Tokenizer.from_str(tokenizer_text)


def fills(lengths, window):
    """How full the windows are that best-fit decreasing opens, one piece after another."""
    left = []
    for n in sorted(lengths, reverse=True):
        fitting = [c for c in left if c >= n]
        if fitting:
            left.remove(min(fitting))
            left.append(min(fitting) - n)
        else:
            left.append(window - n)
    return sorted(window - c for c in left)


def assert_packed(rows, window):
    """Every document's pieces follow each other, and so do every sequence's."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))
    return documents, sequences


@pytest.mark.parametrize("seed", range(6))
def test_plan_over_counts_equals_one_piece_at_a_time(seed):
    rng = random.Random(seed)
    window = rng.choice([7, 16, 64, 100])
    lengths = [min(window, 1 + int(rng.expovariate(rng.choice([0.05, 0.3])))) for _ in range(400)] + [window // 2 + 1] * rng.choice([0, 200])
    plan = packing.best_fit_decreasing(Counter(lengths), window)
    cells, held = set(), defaultdict(int)
    for n, count in Counter(lengths).items():
        sequence, offset = plan.places(np.full(count, n), np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            held[s] += n
            new = {(s, o + k) for k in range(n)}
            assert not new & cells and o + n <= window
            cells |= new
    assert sorted(held.values()) == fills(lengths, window)
    assert sorted(held) == list(range(plan.sequences))
    assert all((s, k) in cells for s, n in held.items() for k in range(n))


def test_tree_finds_the_tightest_window():
    rng, tree, held = random.Random(2), packing.OpenWindows(37), defaultdict(list)
    for step in range(500):
        least = rng.randint(1, 37)
        assert tree.tightest(least) == min((c for c, runs in held.items() if runs and c >= least), default=None)
        if rng.random() < 0.6:
            c = rng.randint(1, 37)
            tree.put(c, step, 1)
            held[c].append((step, 1))
        elif (c := tree.tightest(least)) is not None:
            assert tree.take(c) == held[c].pop(0)


def test_encoder_equals_the_library(tokenizer_text, library):
    encoder = packing.Encoder(tokenizer_text)
    assert encoder.fast is not None
    rng = random.Random(4)
    letters = [chr(c) for c in range(0x250)] + list(" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0　​🙂é中") * 20
    texts = ["", "<|endoftext|>", "a <|endoftext|><|endoftext|> b", " " * 300_000, "ab" * 50_000, "\n" * 3000 + "x", "<|endoftext|"]
    texts += ["".join(rng.choices(letters, k=80)) for _ in range(500)]
    for text in texts:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_files_are_left_to_the_library():
    text = read_file(queries.tokenizer_path("word_bpe_49k.json"))
    encoder = packing.Encoder(text)
    assert encoder.fast is None
    assert encoder.ids("Hello there, World").tolist() == encoder.plain.encode("Hello there, World", add_special_tokens=False).ids


def test_query_against_the_library(spark, library):
    path = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_packing"](spark, path).collect()
    documents, sequences = assert_packed(rows, 2048)
    crc = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in rows}
    rests = []
    for doc_id, text in texts.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        at = 0
        for start, length, total in sorted(documents.pop(doc_id)):
            assert (start, total) == (at, len(ids))
            assert crc[doc_id, start] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at : at + length]))
            at += length
            rests.append(length)
        assert at == len(ids)
    assert not documents
    held = [sum(n for _, n in parts) for parts in sequences.values()]
    assert sorted(held) == fills(rests, 2048)
    assert packing.share_of_padding(held) < 0.02


def test_packed_sequences_hold_the_documents(spark, tokenizer_text, library):
    words = random.Random(5)
    rows = [(i, " ".join(words.choices(["alpha", "be", "gamma ray", "d"], k=words.randint(0, 40)))) for i in range(120)]
    rows += [(1000 + i, "one and the same text") for i in range(60)]  # a third has one length, over several parts
    rows += [(None, "no id"), (5000, None), (5001, ""), (5002, "long " * 3000)]
    docs = spark.createDataFrame(rows, DOCS).repartition(6).withColumns({c: F.lit("x") for c in ("length", "row", "place", "part", "turn", "ids", "at")})
    parts = packing.packed(docs, tokenizer_text, window=64).cache()
    documents, _ = assert_packed(parts.collect(), 64)
    assert set(documents) == {r[0] for r in rows} and documents[5000] == documents[5001] == [(0, 1, 1)]
    made = {r["sequence_id"]: r for r in packing.sequences(parts, window=64, pad=9).collect()}
    for r in parts.collect():
        whole = made[r["sequence_id"]]["ids"]
        assert whole[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == r["ids"]
    for r in made.values():
        n = r["n_tokens"]
        size = n if n & (n - 1) == 0 else 64
        assert len(r["ids"]) == 4 * size and bytes(r["ids"][4 * n :]) == (9).to_bytes(4, "little") * (size - n)


def test_columns_of_pieces_stay(spark):
    parts = spark.range(300).select(*[F.lit(k).alias(c) for k, c in enumerate(("row", "part", "place", "turn", "before", "at", "n"))], (F.col("id") % 5 + 1).cast("int").alias("length"))
    found = packing.placed(parts.repartition(7), window=8)
    assert found.columns == [*parts.columns, "sequence_id", "offset"]
    rows = found.collect()
    held = Counter()
    for r in rows:
        held[r["sequence_id"]] += r["length"]
    assert len(rows) == 300 and sorted(held.values()) == fills([r["length"] for r in rows], 8)


def test_no_pieces_and_wrong_lengths(spark, tokenizer_text):
    assert packing.packed(spark.createDataFrame([], DOCS), tokenizer_text).collect() == []
    with pytest.raises(ValueError):
        packing.placed(spark.createDataFrame([(9,)], "length long"), window=8)
