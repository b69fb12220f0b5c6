"""Packing documents into token windows by best-fit decreasing.

Overlong documents are first cut into full windows; what is left of them, and all shorter documents, are
placed by falling length into the tightest open window, which a segment tree over remaining capacities
finds. Pieces of one length are alike to that rule, so it runs over the number of pieces of each length,
and places whole runs of equal pieces into whole runs of equal windows: the outcome is that of placing all
pieces of the corpus one by one, while the driver sees one number a length. Pieces find their places by
their number among those of their length, which is counted by Spark.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingpanel.llm.common import digest, kept, prepare
from filingpanel.llm.tokenizer_file import BYTE_LEVEL_SPLIT, TokenizerFile
from filingpanel.session import staged

WINDOW = 2048

#: The identifier after each document.
END = 1

#: Bytes of identifiers that leave a worker at once.
OUT_BYTES = 4 << 20

_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())])


class Encoder:
    """Identifiers of whole texts as the tokenizers library gives them, without added special tokens.

    A byte-level file without normalisation, whose merges make ascending identifiers, is the same thing to
    tiktoken, which is four times as fast; other files, and texts that its pattern engine refuses (a million spaces
    in a row), go to the library itself.
    """

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_str(text)
        self.plain.no_truncation()
        self.plain.no_padding()
        self.fast = self._ranked(text)

    @staticmethod
    def _ranked(text: str):
        import tiktoken

        try:
            spec = TokenizerFile(text)
        except ValueError:
            return None
        made = [m for _, (_, m) in sorted((rank, (pair, m)) for pair, (rank, m) in spec.ranks.items())]
        if spec.steps or spec.drops_spaces or spec.suffix or made != sorted(made) or made and len(made) + 256 != len(set(spec.vocab) - set(spec.added)):
            return None
        ranks = {spec.bytes_of(i): i for t, i in spec.vocab.items() if t not in spec.added}
        return tiktoken.Encoding("file", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=spec.added)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:
                pass
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(docs: DataFrame, tokenizer_text: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens``: every document's identifiers, and ``end``, cut into full windows and a rest.

    ``ids`` are little-endian unsigned 32-bit numbers. Null counts as the empty text, whose only piece is ``end``.
    Repeated rows and ids give pieces each, null ids stay; other columns of ``docs`` are not looked at. Rows
    are encoded where they lie, one text at a time.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(tokenizer_text)

    def cut(batches):
        encoder = kept(("encoder", digest(shared.value)), lambda: Encoder(shared.value))
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.ids(text.as_py()), end).astype("<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    rows.append((doc_id, start, len(part), part.tobytes(), len(ids)))
                    size += 4 * len(part)
                if size >= OUT_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return rows.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long")


class OpenWindows:
    """Open windows by remaining capacity: runs of successive windows at the leaves of a segment tree."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.runs: list[deque] = [deque() for _ in range(window + 1)]
        self.holds = np.zeros(2 * self.size, bool)  # whether a node has a window below

    def _mark(self, capacity: int) -> None:
        node = self.size + capacity
        self.holds[node] = bool(self.runs[capacity])
        while node > 1:
            node //= 2
            self.holds[node] = self.holds[2 * node] or self.holds[2 * node + 1]

    def put(self, capacity: int, first: int, count: int) -> None:
        if capacity and count:
            self.runs[capacity].append((first, count))
            self._mark(capacity)

    def take(self, capacity: int) -> tuple[int, int]:
        run = self.runs[capacity].popleft()
        self._mark(capacity)
        return run

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open window has."""
        node = self.size + least
        while not self.holds[node]:
            while node & 1:  # a right child: everything from here on is right of its parent
                node //= 2
            if not node:
                return None
            node += 1
        while node < self.size:
            node = 2 * node if self.holds[2 * node] else 2 * node + 1
        return node - self.size


@dataclass
class Plan:
    """Runs of equal pieces in equal windows, by piece length and number; ``sequences`` windows in all.

    Pieces ``rank`` to ``rank + count`` of a length go to the windows from ``first`` on, ``each`` to a window, from ``offset`` on.
    """

    length: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and offset of pieces, given by length and number among the pieces of that length."""
        run = np.empty(len(lengths), np.int64)
        for n in np.unique(lengths):
            own = lengths == n
            a, b = np.searchsorted(self.length, [n, n + 1])
            run[own] = a + np.searchsorted(self.rank[a:b], ranks[own], "right") - 1
        turn = ranks - self.rank[run]
        return self.first[run] + turn // self.each[run], self.offset[run] + turn % self.each[run] * lengths


def best_fit_decreasing(counts: Mapping[int, int], window: int = WINDOW) -> Plan:
    """Where best-fit decreasing puts ``counts[n]`` pieces of each length n.

    While the tightest window that takes a piece can take another one as long, it stays the tightest; so
    each window of a run takes as many as it can before the next one does.
    """
    opened = OpenWindows(window)
    found: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    for length in sorted(counts, reverse=True):
        rank = 0
        while left := counts[length] - rank:
            capacity = opened.tightest(length)
            if capacity is None:
                capacity = window
                first, count = sequences, -(-left // (window // length))
                sequences += count
            else:
                first, count = opened.take(capacity)
            each = capacity // length
            whole = min(count, left // each)
            rest = left - whole * each if whole < count else 0
            found.append((length, rank, first, each, window - capacity))
            opened.put(capacity - each * length, first, whole)
            if rest:
                opened.put(capacity - rest * length, first + whole, 1)
            used = whole + (rest > 0)
            opened.put(capacity, first + used, count - used)
            rank += whole * each + rest
    found.sort()
    columns = np.array(found, np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences)


def placed(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``; its column ``length`` (1 to ``window``, a long) says how long they are.

    All further columns stay as they are, whatever their names; repeated rows have places each; no rows
    give no rows. ``parts`` is written first, so that every piece keeps its number when a task is repeated. Pieces
    are numbered by length within each part of the written rows, and the numbers of earlier parts are added:
    a length that a third of all pieces have is counted by all tasks. The plan depends on the window, not on
    the number of pieces, and is broadcast.
    """
    spark = parts.sparkSession
    prepare(spark)
    row = F.struct(*[F.col(f"`{c}`") for c in parts.columns])
    place = F.monotonically_increasing_id()
    rows = staged(parts.select(row.alias("row"), place.alias("place")), "pieces")
    length = F.col("row.length").cast("long")
    rows = rows.select("row", length.alias("length"), "place", F.expr("shiftright(place, 33)").alias("part"))
    counts = staged(rows.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if totals and not 1 <= min(totals) <= max(totals) <= window:
        raise ValueError(f"pieces have 1 to {window} identifiers")
    shared = spark.sparkContext.broadcast(best_fit_decreasing(totals, window))

    @F.pandas_udf("sequence_id long, offset long")
    def found(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = shared.value.places(lengths.to_numpy(np.int64), ranks.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    turn = F.row_number().over(Window.partitionBy("part", "length").orderBy("place")) - 1
    numbered = rows.withColumn("turn", turn).join(before, ["part", "length"])
    at = numbered.select("row", found("length", F.col("before") + F.col("turn")).alias("at"))
    return at.select(*[F.col(f"row.`{c}`").alias(c) for c in parts.columns if c not in ("sequence_id", "offset")], "at.sequence_id", "at.offset")


def padded_to(n: Column, window: int = WINDOW) -> Column:
    """How long a sequence of ``n`` identifiers gets: a power of two stays, everything else fills the window."""
    return F.when(F.bit_count(n) == 1, n).otherwise(F.lit(window))


def sequences(packed: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids`` from placed pieces with ``ids``: the identifiers in order, padded with ``pad``."""
    piece = F.struct("offset", "ids")
    joined = packed.groupBy("sequence_id").agg(F.sum("length").cast("long").alias("n_tokens"), F.array_sort(F.collect_list(piece)).alias("list"))
    whole = F.aggregate("list", F.lit(b"").cast("binary"), lambda all_, x: F.concat(all_, x["ids"]))
    filler = F.unhex(F.repeat(F.lit(pad.to_bytes(4, "little").hex()), (padded_to(F.col("n_tokens"), window) - F.col("n_tokens")).cast("int")))
    return joined.select("sequence_id", "n_tokens", F.concat(whole, filler).alias("ids"))


def packed(docs: DataFrame, tokenizer_text: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Pieces of all documents with their identifiers and places; ``pieces`` and ``placed`` say how."""
    return placed(pieces(docs, tokenizer_text, window, end), window)


def share_of_padding(lengths: Iterable[int], window: int = WINDOW) -> float:
    """Padding as a share of all that the sequences with these lengths hold."""
    held = np.fromiter(lengths, np.int64)
    full = np.where(held & (held - 1) == 0, held, window)
    return float((full - held).sum() / max(1, full.sum()))
