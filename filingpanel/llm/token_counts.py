"""Token counts by heap-and-linked-list byte-pair merging.

The pairs of a word's symbols wait in a heap by merge rank and place; the lowest is merged, its two
neighbours in the linked list make new pairs, and entries that no longer hold are passed over. A
word has as many tokens as it had symbols, less the merges made. No identifiers are emitted.
"""

from __future__ import annotations

import heapq

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingpanel.llm.common import Memo, digest, kept, prepare, text_or_empty
from filingpanel.llm.tokenizer_file import SPACES, TokenizerFile

#: Distinct words, and distinct runs between two spaces, that a worker remembers the counts of.
KEPT_WORDS = 600_000

#: A space next to other white space (by any reading of white space), or at an end of the text:
#: there the plain cut at spaces does not hold.
_UNEVEN_SPACE = regex.compile(rf"[{SPACES}\x1c-\x1f] | [{SPACES}\x1c-\x1f]|^ | $")


def merges_made(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> int:
    """How many merges byte-pair encoding makes in a sequence of symbols."""
    n = len(symbols)
    heap = []
    for i in range(n - 1):
        found = ranks.get((symbols[i], symbols[i + 1]))
        if found is not None:
            heap.append((found[0], i, found[1]))
    if not heap:
        return 0
    heapq.heapify(heap)
    symbol = list(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    pop, push, get = heapq.heappop, heapq.heappush, ranks.get
    merges = 0
    while heap:
        _, i, made = pop(heap)
        left = symbol[i]
        if left < 0:
            continue
        j = after[i]
        if j >= n:
            continue
        found = get((left, symbol[j]))
        if found is None or found[1] != made:
            continue
        merges += 1
        symbol[i] = made
        symbol[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = get((made, symbol[k]))
            if found is not None:
                push(heap, (found[0], i, found[1]))
        h = before[i]
        if h >= 0:
            found = get((symbol[h], made))
            if found is not None:
                push(heap, (found[0], h, found[1]))
    return merges


class TokenCounter:
    """Counts the tokens of texts under one tokenizer file, special strings included."""

    def __init__(self, tokenizer: TokenizerFile, kept_words: int = KEPT_WORDS):
        if tokenizer.steps or tokenizer.drops_spaces:
            raise ValueError("counting knows byte-level files without normalisation")
        self.tokenizer = tokenizer
        self.words = Memo(self._word, kept_words)
        self.runs = Memo(self._run, kept_words)

    def _word(self, word: str) -> int:
        symbols = self.tokenizer.symbols(word)
        return len(symbols) - merges_made(symbols, self.tokenizer.ranks)

    def _run(self, run: str) -> int:
        """Tokens of a run without spaces inside that follows a space."""
        return sum(map(self.words.__getitem__, self.tokenizer.pattern.findall(" " + run)))

    def _plain(self, text: str) -> int:
        pattern, words = self.tokenizer.pattern, self.words
        if _UNEVEN_SPACE.search(text):
            return sum(words[m.group()] for m in pattern.finditer(text))
        # A space between two other characters always begins a token.
        first, *rest = text.split(" ")
        return sum(map(words.__getitem__, pattern.findall(first))) + sum(map(self.runs.__getitem__, rest))

    def count(self, text: str) -> int:
        special = self.tokenizer.special
        if special is None or special.search(text) is None:
            return self._plain(text) if text else 0
        parts = special.split(text)  # every second part is a special string: one token
        return len(parts) // 2 + sum(self._plain(p) for p in parts[::2] if p)


def _counter(text: str) -> TokenCounter:
    return kept(("counter", digest(text)), lambda: TokenCounter(TokenizerFile(text)))


def token_counts(docs: DataFrame, tokenizer_text: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``tokenizer_text`` is the content of the tokenizer file; it is broadcast (its size is checked
    where it is read). Null counts as the empty text: no bytes and no tokens. Repeated rows and ids
    give a row each, null ids stay null; other columns of ``docs`` are not looked at, whatever their
    names. A row is counted where it lies: no shuffle. A text without any space is cut by the
    vocabulary's own pattern, and merging takes n log n steps in its longest piece.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(tokenizer_text)

    def counted(batches):
        counter = _counter(shared.value)
        for rows in batches:
            texts = text_or_empty(rows["text"])
            yield pd.DataFrame(
                {
                    "doc_id": rows["doc_id"],
                    "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
                    "n_tokens": [counter.count(t) for t in texts],
                }
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInPandas(counted, "doc_id long, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
