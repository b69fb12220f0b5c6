"""Document fingerprints by a quartile bucket digest.

Byte triplets within a sliding window of five are hashed into 128 buckets. The digest writes, for each
bucket, in which quarter of all bucket counts its count lies (two bits), behind a head with the
logarithm of the length and how far the quartiles lie apart. Two digests are compared by a difference
score: steps between quarters, with the farthest counting double, and weighted steps in the head.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingpanel.llm.common import partitions, prepare, text_or_empty

BUCKETS = 128

#: Places of the three bytes in the window, and the odd factors that mix them (fixed by choice).
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 4))
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)

#: Length classes grow by this factor.
LENGTH_STEP = 1.25

#: A difference of this much, or more, is no likeness at all. Texts without anything in common lie near 200.
BOUND = 240

#: Bytes that are counted at once.
BLOCK_BYTES = 1 << 20

#: Stands for a null doc_id when documents are put in order: null comes first.
FIRST_KEY = -(2**63)


def _counted(blobs: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(blobs), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(blobs), dtype=np.int64) * BUCKETS, [len(b) for b in blobs])
    total = np.zeros(len(blobs) * BUCKETS, np.int64)
    for salt, places in enumerate(TRIPLETS, 1):
        n = len(data) - places[2]
        if n <= 0:
            continue
        mixed = np.full(n, salt, np.uint32)
        for place, factor in zip(places, FACTORS):
            mixed += data[place : place + n]
            mixed *= np.uint32(factor)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(FACTORS[0])
        bucket = owner[:n] + (mixed >> np.uint32(25))
        total += np.bincount(bucket[owner[:n] == owner[places[2] :]], minlength=len(total))
    return total.reshape(len(blobs), BUCKETS)


def digests(blobs: list[bytes]) -> np.ndarray:
    """A row for each byte string: length class, two quartile ratios, and the quarter of each bucket."""
    parts, block, size = [], [], 0
    for blob in blobs:
        if block and size + len(blob) > BLOCK_BYTES:
            parts.append(_counted(block))
            block, size = [], 0
        block.append(blob)
        size += len(blob)
    if block:
        parts.append(_counted(block))
    counts = np.concatenate(parts) if parts else np.zeros((0, BUCKETS), np.int64)
    cuts = np.sort(counts, axis=1)[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, BUCKETS * 3 // 4 - 1]]
    quarters = (counts[:, :, None] > cuts[:, None, :]).sum(axis=2)
    head = np.zeros((len(blobs), 3), np.int64)
    head[:, 0] = [min(255, round(math.log(len(b) + 1) / math.log(LENGTH_STEP))) for b in blobs]
    third = np.maximum(cuts[:, 2], 1)
    head[:, 1], head[:, 2] = cuts[:, 0] * 15 // third, cuts[:, 1] * 15 // third
    return np.concatenate([head, quarters], axis=1).astype(np.int16)


def written(digest: np.ndarray) -> list[str]:
    """Digests as text: two hexadecimal digits of length, two of ratios, 64 of quarters."""
    body = digest[:, 3:].reshape(len(digest), -1, 4).astype(np.int64) @ np.array([64, 16, 4, 1])
    head = np.stack([digest[:, 0], digest[:, 1] * 16 + digest[:, 2]], axis=1)
    packed = np.concatenate([head, body], axis=1).astype(np.uint8)
    return [row.tobytes().hex() for row in packed]


def read(text: str) -> np.ndarray:
    """A digest from its written form."""
    packed = np.frombuffer(bytes.fromhex(text), np.uint8).astype(np.int16)
    body = packed[2:, None] >> np.array([6, 4, 2, 0], np.int16) & 3
    return np.concatenate([[packed[0], packed[1] >> 4, packed[1] & 15], body.reshape(-1)]).astype(np.int16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests down to 0, row by row."""
    steps = np.abs(a - b).astype(np.int64)
    body = steps[:, 3:]
    difference = (body + 3 * (body == 3)).sum(axis=1) + 4 * steps[:, 0] + 2 * (steps[:, 1] + steps[:, 2])
    return 1 - np.minimum(difference, BOUND) / BOUND


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every row, where it lies. Null counts as the empty text."""
    prepare(docs.sparkSession)

    def marked(batches):
        for rows in batches:
            blobs = [t.encode("utf-8", "surrogatepass") for t in text_or_empty(rows["text"])]
            yield pd.DataFrame({"doc_id": rows["doc_id"], "fingerprint": written(digests(blobs))})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(marked, "doc_id long, fingerprint string")


def with_next(rows: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Rows dealt into ranges of the whole-number column ``key``, each range followed by the next one's first key.

    Adds ``part`` and ``tail``: rows with ``tail`` are copies that only tell what comes after the range;
    after the last range comes the first key of all. Ranges begin at quantiles that are keys themselves,
    so the copies are the rows of as many keys as there are ranges. Returns the number of ranges too.
    """
    spark = rows.sparkSession
    n = max(1, partitions(spark))
    shares = [i / n for i in range(n)]
    found = rows.agg(F.min(key).alias("first"), F.percentile_approx(key, shares, 100 * n).alias("cuts")).first()
    if found["first"] is None:
        return rows.withColumns({"part": F.lit(0), "tail": F.lit(False)}), 1
    first, starts = found["first"], np.array(sorted({c for c in found["cuts"] if c > found["first"]}), np.int64)

    @F.pandas_udf("int")
    def part(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, k.to_numpy(np.int64), "right").astype(np.int32))

    begins = F.col(key) == first
    dealt = rows.withColumn("part", part(F.col(key)))
    # The first key of a range is one of the starts: a small join-free test in the same worker pass.

    @F.pandas_udf("int")
    def told(k: pd.Series) -> pd.Series:
        values = k.to_numpy(np.int64)
        place = np.searchsorted(starts, values, "left")
        hit = (place < len(starts)) & (starts[np.minimum(place, len(starts) - 1)] == values) if len(starts) else values != values
        return pd.Series(np.where(hit, place, -1).astype(np.int32))

    dealt = dealt.withColumn("told", F.when(begins, F.lit(len(starts))).otherwise(told(F.col(key))))
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("tail"))
    copy = F.struct(F.col("told").alias("part"), F.lit(True).alias("tail"))
    places = F.when(F.col("told") >= 0, F.array(own, copy)).otherwise(F.array(own))
    spread = dealt.select(*rows.columns, F.explode(places).alias("place"))
    return spread.select(*rows.columns, "place.part", "place.tail"), len(starts) + 1


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Every document's digest beside those of its edited text and of the next document.

    The edited text has the last half (rounded down) of the code points replaced by as many from the
    beginning of the next document by ascending ``doc_id``; after the last comes the first. Null texts
    are empty. Null ids come first; rows with one id are ordered by text, and equal rows stay apart, each
    followed by the next. A single row is followed by itself. No rows give no rows. Other columns are
    not looked at. Every task holds one batch of rows and one row of the batch before.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_KEY)).alias("k"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    spread, n = with_next(rows, "k")
    dealt = spread.repartitionById(n, F.col("part")).sortWithinPartitions("part", "tail", "k", "text")

    def compared(batches):
        held = None  # the last row so far, whose next is not known yet
        for batch in batches:
            batch = batch[~(batch["tail"] & batch["tail"].shift(fill_value=False))]  # one tail is enough
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            held = batch.iloc[-1:]
            if len(batch) < 2 or (batch["tail"].iloc[0] and len(batch) < 2):
                continue
            texts, ids = batch["text"].tolist(), batch["doc_id"]
            same = (batch["part"].to_numpy()[:-1] == batch["part"].to_numpy()[1:]) & ~batch["tail"].to_numpy()[:-1]
            at = np.flatnonzero(same)
            if not at.size:
                continue
            edited = [texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][: len(texts[i]) // 2] for i in at]
            blobs = [t.encode("utf-8", "surrogatepass") for t in edited]
            own = digests([t.encode("utf-8", "surrogatepass") for t in texts])
            changed = digests(blobs)
            yield pd.DataFrame(
                {
                    "doc_id": ids.iloc[at].array,
                    "n_chars": [len(texts[i]) for i in at],
                    "edited_sha256": [hashlib.sha256(b).hexdigest() for b in blobs],
                    "fingerprint": written(own[at]),
                    "edited_fingerprint": written(changed),
                    "near_edited": likeness(own[at], changed),
                    "near_next": likeness(own[at], own[at + 1]),
                }
            )

    return dealt.mapInPandas(
        compared,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
