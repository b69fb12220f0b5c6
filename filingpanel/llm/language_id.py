"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A run of three letters is bound into one vector: the
product of its letters' vectors, each permuted (rotated) by its place. A text is the bundle (sum) of its
runs, a language the bundle of its learning texts; a text gets the language with the largest cosine.
All sums are of integers, so the profiles do not depend on how the rows are spread.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingpanel.llm.common import prepare, text_or_empty

DIMENSIONS = 1024
SEED = 20_011

#: Texts and characters that are bundled at once.
BLOCK_TEXTS, BLOCK_CHARS = 128, 1 << 20

#: More languages than this in the learning rows are an error: their profiles are broadcast.
MAX_LANGUAGES = 1000

#: Largest table of letter triples that is indexed directly.
DIRECT_TRIPLES = 1 << 22

UNDETERMINED = "und"


@functools.cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter or a mark on one."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), bool, 0x110000)


@functools.lru_cache(maxsize=1 << 14)
def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    bits = np.random.default_rng([SEED, code]).integers(0, 2, dimensions, np.int8)
    return bits * 2 - 1


def _triples(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letter runs of three, edges of words included, as code points; and the text of each."""
    spaced = [" " + t.lower() + " " for t in texts]
    points = np.frombuffer("".join(spaced).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in spaced])
    letter = _letters()[points]
    kept = letter.copy()
    kept[0] = True
    kept[1:] |= letter[:-1] | (owner[1:] != owner[:-1])  # one edge after a word, one before the text
    points, owner = np.where(letter, points, 0)[kept], owner[kept]
    whole = owner[2:] == owner[:-2]
    return np.stack([points[:-2][whole], points[1:-1][whole], points[2:][whole]]), owner[:-2][whole]


def _bundled(texts: list[str], dimensions: int) -> np.ndarray:
    runs, owner = _triples(texts)
    if not owner.size:
        return np.zeros((len(texts), dimensions), np.float32)
    letters = np.unique(runs)
    place = np.zeros(int(letters[-1]) + 1, np.int64)
    place[letters] = np.arange(len(letters))
    a, b, c = place[runs]
    size = len(letters)
    codes = (a * size + b) * size + c
    if size**3 <= DIRECT_TRIPLES:
        seen = np.zeros(size**3, np.int64)
        seen[codes] = 1
        distinct = np.flatnonzero(seen)
        seen[distinct] = np.arange(len(distinct))
        index = seen[codes]
    else:
        distinct, index = np.unique(codes, return_inverse=True)
    counts = np.bincount(owner * len(distinct) + index, minlength=len(texts) * len(distinct))
    table = np.stack([letter_vector(int(x), dimensions) for x in letters])
    bound = table[distinct // (size * size)] * np.roll(table, 1, 1)[distinct // size % size]
    bound *= np.roll(table, 2, 1)[distinct % size]
    return counts.reshape(len(texts), -1).astype(np.float32) @ bound.astype(np.float32)


def bundles(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """One profile a text, in blocks of bounded size; all zero for a text without letters."""
    out, block, chars = [], [], 0
    for text in texts:
        if block and (len(block) >= BLOCK_TEXTS or chars + len(text) > BLOCK_CHARS):
            out.append(_bundled(block, dimensions))
            block, chars = [], 0
        block.append(text)
        chars += len(text)
    if block:
        out.append(_bundled(block, dimensions))
    return np.concatenate(out) if out else np.zeros((0, dimensions), np.float32)


def learn_profiles(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The profile of each non-null ``lang`` of ``docs``, from every text that has one.

    A task sums its texts into one vector a language; those sums meet by (language, dimension), so the
    shuffle is as small as the number of tasks, and the driver gets one vector a language.
    """
    prepare(docs.sparkSession)

    def sums(batches):
        total: dict[str, np.ndarray] = {}
        for rows in batches:
            found = bundles(text_or_empty(rows["text"]), dimensions).astype(np.int64)
            languages = rows["lang"].to_numpy()
            for language in pd.unique(languages):
                part = found[languages == language].sum(axis=0)
                total[language] = total[language] + part if language in total else part
            if len(total) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for language, vector in total.items():
            place = np.flatnonzero(vector)
            yield pd.DataFrame({"lang": language, "place": place.astype(np.int32), "value": vector[place]})

    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = known.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    parts = rows.mapInPandas(sums, "lang string, place int, value long")
    summed = parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    vectors = summed.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("place", "value"))).alias("v"))
    found = vectors.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    profiles = {}
    for row in sorted(found, key=lambda r: r["lang"]):
        profiles[row["lang"]] = np.zeros(dimensions)
        profiles[row["lang"]][list(row["v"])] = list(row["v"].values())
    return profiles


def predict_languages(docs: DataFrame, profiles: dict[str, np.ndarray], *keep: str | Column) -> DataFrame:
    """``doc_id``, the columns ``keep``, ``lang_pred`` and ``score`` (the cosine, 0 where negative).

    Only ``text`` decides. Null texts, texts without a letter, and every text where nothing was learnt
    are ``und`` with score 0; a tie goes to the language that sorts first. Repeated rows and ids give
    a row each; columns that are not named are not looked at. No shuffle.
    """
    spark = docs.sparkSession
    prepare(spark)
    names = sorted(profiles)
    dimensions = len(profiles[names[0]]) if names else DIMENSIONS
    table = np.stack([profiles[n] / max(np.linalg.norm(profiles[n]), 1e-12) for n in names]) if names else None
    shared = spark.sparkContext.broadcast((names, table))

    def predicted(batches):
        names, table = shared.value
        for rows in batches:
            texts = text_or_empty(rows["text"])
            if names:
                found = bundles(texts, dimensions).astype(np.float64)
                cosine = found @ table.T / np.maximum(np.linalg.norm(found, axis=1), 1e-12)[:, None]
                best = cosine.argmax(axis=1)
                lettered = np.array([any(map(str.isalpha, t)) for t in texts], bool)
                label = np.where(lettered, np.array(names, object)[best], UNDETERMINED)
                score = np.where(lettered, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0)
            else:
                label, score = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            yield rows.drop(columns="text").assign(lang_pred=label, score=score)

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text")
    return kept.mapInPandas(predicted, schema + ", lang_pred string, score double")
