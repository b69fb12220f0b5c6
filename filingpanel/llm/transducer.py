"""BPE encoding as a streaming transducer with bounded lookahead, and incremental decoding.

Tokens of a merge list can depend on what follows, but only so far. Between two texts that agree up
to a place, every disagreement enters at that place, and moves left only by a merge ``(u, v)`` that
one of the two makes: past ``u``. The next such merge has a higher rank and a right part that begins
with that ``u``. The longest chain of such steps, summed over ``|u|``, is the sufficient lookahead: it
follows from the merge list alone, in one pass. A token that ends that far before the end of what
has been read is stable and is emitted; the transducer holds no more than a block and the lookahead.

This needs a proper merge list (both parts of a merge are single symbols or made by earlier merges),
which is checked; for any other list a word is read whole before its tokens are emitted.
"""

from __future__ import annotations

import codecs
import struct
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingpanel.llm.common import Memo, digest, kept, prepare, text_or_empty, tidy
from filingpanel.llm.tokenizer_file import SPACES, TokenizerFile, tokenizer_of

#: Symbols read beyond the lookahead before stable tokens are emitted.
BLOCK = 256

#: Distinct words, and distinct runs between white space, that a worker remembers the tokens of.
KEPT_WORDS = 400_000

#: Symbols up to which the pairs of a sequence are kept in a list, not sought anew for each merge.
FEW_SYMBOLS = 256

#: Stands for the rank of a pair that no merge takes.
_NO_MERGE = sys.maxsize, -1

#: Identifiers that the decoder takes at once.
DECODED_AT_ONCE = 65_536

_SPACE_RUN = regex.compile(f"[{SPACES}]+")


def sufficient_lookahead(tokenizer: TokenizerFile) -> int | None:
    """Symbols after a place that can decide the tokens before it; None if the list is not proper."""
    suffix, names = tokenizer.suffix, {i: t for t, i in tokenizer.vocab.items()}
    made = {x for x in (*tokenizer.inner, *tokenizer.last) if x is not None}
    reach: dict[str, int] = {}  # by left part: the longest chain that ends with a merge of it
    longest = 0
    for (left, right), (_, merged) in sorted(tokenizer.ranks.items(), key=lambda x: x[1][0]):
        if left not in made or right not in made:
            return None
        made.add(merged)
        u, v = names[left], names[right]
        v = v.removesuffix(suffix) if suffix else v
        chain = len(u) + max((reach.get(v[:k], 0) for k in range(1, len(v) + 1)), default=0)
        if chain > reach.get(u, 0):
            reach[u] = chain
            longest = max(longest, chain)
    return longest


def merged(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The tokens of a short sequence: the lowest-ranked pair is merged throughout, again and again."""
    get = ranks.get
    if 1 < len(symbols) <= FEW_SYMBOLS:
        symbols = list(symbols)
        found = [get(pair, _NO_MERGE) for pair in zip(symbols, symbols[1:])]
        while found and (best := min(found)) is not _NO_MERGE:
            at = found.index(best)
            symbols[at : at + 2] = [best[1]]
            del found[at]  # only the pairs beside the new token are others now
            if at:
                found[at - 1] = get((symbols[at - 1], best[1]), _NO_MERGE)
            if at < len(found):
                found[at] = get((best[1], symbols[at + 1]), _NO_MERGE)
        return symbols
    while len(symbols) > 1:
        best, at = None, None
        for pair in zip(symbols, symbols[1:]):
            found = get(pair)
            if found is not None and (best is None or found < best):
                best, at = found, pair
        if best is None:
            break
        left, right = at
        new, i, n = [], 0, len(symbols)
        while i < n:
            if i + 1 < n and symbols[i] == left and symbols[i + 1] == right:
                new.append(best[1])
                i += 2
            else:
                new.append(symbols[i])
                i += 1
        symbols = new
    return symbols


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Transducer:
    """Encodes words and texts under one tokenizer file."""

    def __init__(self, tokenizer: TokenizerFile, block: int = BLOCK, kept_words: int = KEPT_WORDS):
        self.tokenizer = tokenizer
        self.lookahead = sufficient_lookahead(tokenizer)
        self.block = block
        self.widths = {}  # symbols that a token covers
        for token, i in tokenizer.vocab.items():
            self.widths[i] = len(token.removesuffix(tokenizer.suffix) if tokenizer.suffix else token) or 1
        self.words = Memo(self._word, kept_words)
        self.runs = Memo(self._run, kept_words)

    def stream(self, symbols: Iterable[int]) -> Iterator[int]:
        """The tokens of a word whose symbols arrive one after the other, each as soon as it is stable."""
        ranks, widths, held = self.tokenizer.ranks, self.widths, []
        limit = None if self.lookahead is None else self.lookahead + self.block
        for symbol in symbols:
            held.append(symbol)
            if limit is not None and len(held) >= limit:
                end, stable = 0, len(held) - self.lookahead
                for token in merged(held, ranks):
                    if end + widths[token] > stable:
                        break
                    end += widths[token]
                    yield token
                held = held[end:]
                limit = max(limit, len(held) + self.block)
        yield from merged(held, ranks)

    def _word(self, word: str) -> bytes:
        symbols = self.tokenizer.symbols(word)
        if self.lookahead is None or len(symbols) < self.lookahead + self.block:
            found = merged(symbols, self.tokenizer.ranks)
        else:
            found = list(self.stream(symbols))
        return _packed(found)

    def _run(self, run: str) -> bytes:
        return b"".join([self.words[match.group()] for match in self.tokenizer.pattern.finditer(self.tokenizer.normalized(run))])

    def _plain(self, text: str) -> bytes:
        if not self.tokenizer.drops_spaces:  # white space belongs to tokens: no cut at it
            return self._run(text)
        return b"".join(map(self.runs.__getitem__, filter(None, _SPACE_RUN.split(text))))

    def encode(self, text: str) -> bytes:
        """The identifiers of a text, packed as little-endian unsigned 32-bit integers."""
        special = self.tokenizer.special
        if special is None or special.search(text) is None:
            return self._plain(text)
        return b"".join([_packed([self.tokenizer.added[part]]) if k % 2 else self._plain(part) for k, part in enumerate(special.split(text))])


class IncrementalDecoder:
    """Turns identifiers into text as they come; its state is the beginning of one character."""

    def __init__(self, tokenizer: TokenizerFile):
        self.tokenizer = tokenizer
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = False

    def feed(self, ids: Iterable[int], final: bool = False) -> str:
        names = self.tokenizer.names
        if not self.tokenizer.byte_decoder:  # a file without a decoder: the tokens, spaces between them
            text = " ".join([names[i] for i in ids if i in names])
            lead, self.begun = " " if self.begun and text else "", self.begun or bool(text)
            return lead + text
        return self.state.decode(b"".join(map(self.tokenizer.bytes_of, ids)), final)

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        parts = [self.feed(ids[k : k + DECODED_AT_ONCE].tolist()) for k in range(0, len(ids), DECODED_AT_ONCE)]
        return "".join([*parts, self.feed((), final=True)])


def transducer_of(text: str) -> Transducer:
    return kept(("transducer", digest(text)), lambda: Transducer(TokenizerFile(text)))


def encode(docs: DataFrame, tokenizer_text: str, decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` for every row, and with ``decoded`` the text that the identifiers give back.

    ``ids`` is binary: little-endian unsigned 32-bit integers. The file's content is broadcast. Null
    and empty texts have no identifiers and decode to the empty text. Repeated rows and ids give a
    row each, null ids stay null, other columns are not looked at. No shuffle: rows stay where they
    are. Strings of special tokens in a text become those tokens, as the file's library does.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(tokenizer_text)

    def encoded(batches):
        machine = transducer_of(shared.value)
        for rows in batches:
            ids = [machine.encode(t) for t in text_or_empty(rows["text"])]
            out = {"doc_id": rows["doc_id"], "ids": ids}
            if decoded:
                out["decoded"] = [IncrementalDecoder(machine.tokenizer).decode(x) for x in ids]
            yield pd.DataFrame(out)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(tidy(encoded), "doc_id long, ids binary" + ", decoded string" * decoded)


def decode(rows: DataFrame, tokenizer_text: str) -> DataFrame:
    """``doc_id, decoded`` from rows with ``doc_id, ids``; null identifiers decode to the empty text."""
    spark = rows.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(tokenizer_text)

    def texts(batches):
        tokenizer = tokenizer_of(shared.value)
        for part in batches:
            found = [IncrementalDecoder(tokenizer).decode(bytes(x) if x is not None else b"") for x in part["ids"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "decoded": found})

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInPandas(tidy(texts), "doc_id long, decoded string")
