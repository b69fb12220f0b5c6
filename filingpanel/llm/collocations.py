"""Collocations by dynamic itemset counting over word sequences.

The corpus lies in shards that are scanned in a cycle. Words are counted from the first scan on. As soon as
both subphrases of a longer phrase (all but its last, all but its first word) have been seen often enough, the
phrase is active: from the next scan on it is counted, until every shard has been scanned once since. So
lengths are interleaved, and most long phrases need no cycle of their own. Scans end when nothing that is
active lacks a shard.

The scans count phrases by 64-bit hash, so that the many rare ones travel as numbers, in blocks of one range of
hashes: the state of a range is merged with the new counts for it by one task. Which phrases are active
is told to the tasks by two small tables: for each slot of hashes, the earliest and the latest scan from
which any phrase there counts. They say "surely not yet", "surely done" or "maybe"; a phrase in doubt is counted, and counts
are kept by shard and once for each. Shared hashes and slots only make phrases active that need not be. At
last the phrases that reached the threshold are spelled out and counted once more as words, which is exact.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingpanel.llm.common import prepare, shuffles_removed
from filingpanel.session import recorded, remove, staged

#: Parts of the corpus, each scanned by a job of its own.
SHARDS = 3

#: Most slots of the tables of active phrases, and of frequent ones: powers of two, two bytes and one byte each for every length.
SLOT_BITS, FREQUENT_BITS = 25, 25

#: Slots that tasks are given for each one taken, up to those: chance hits stay rare however much text there is.
SPARE_SLOTS = 16

#: Bytes of text that are counted together before they leave a worker, and rows of one batch.
CHUNK_BYTES, OUT_ROWS = 8 << 20, 1 << 16

#: Counts that a worker holds before it sends them on, and words of the corpus for each range of hashes.
HELD_COUNTS, RANGE_WORDS = 2_000_000, 1 << 19

#: Parts of a language that are ranked apart before the language is.
RANK_PARTS = 64

NEVER = 255

_BREAKS = b".,;:!?\n\x0b\x0c\r"

#: Letters A to Z in lower case, tabs as spaces, and ends of pieces as a byte that no text has.
_CLEANED = bytes(0xFF if b in _BREAKS else 0x20 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

_CHUNKS = pa.schema([("lang", pa.string()), ("vocabulary", pa.binary()), ("places", pa.binary()), ("n", pa.int64()), ("shard", pa.int32())])
_BLOCKS = pa.schema([("words", pa.int32()), ("part", pa.int32()), ("old", pa.bool_()), ("hashes", pa.binary()), ("totals", pa.binary()), ("shards", pa.binary()), ("reached", pa.binary())])
_BLOCKS_SQL = "words int, part int, old boolean, hashes binary, totals binary, shards binary, reached binary"
_PHRASES = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.binary()), ("n", pa.int64())])


class _Vocabulary(dict):
    """Words by number; 0 ends a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def numbered(texts: list[bytes]) -> tuple[bytes, bytes, int]:
    """The words of some texts, each once and ended by a line end; their numbers in order as 32-bit integers; how many.

    Numbers begin at 1, and 0 parts pieces.
    """
    data = b"\n".join(texts).translate(_CLEANED).replace(b"\xff", b" \xff ")
    numbers = _Vocabulary({b"\xff": 0})
    places = np.fromiter(map(numbers.__getitem__, data.split()), np.int32)
    return b"".join(w + b"\n" for w in list(numbers)[1:]), places.tobytes(), int(np.count_nonzero(places))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _slots(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where hashes stand in a table with a power of two of slots: their leading bits."""
    return (hashes >> np.uint64(65 - len(table).bit_length())).astype(np.int64)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of a phrase and the word after it."""
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(0x632BE59BD9B4E019))
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Active:
    """From which scan on the phrases of one length let longer ones count: by slot, the earliest and the latest."""

    def __init__(self, bits: int):
        self.earliest = np.full(1 << bits, NEVER, np.uint8)
        self.latest = np.zeros(1 << bits, np.uint8)
        self.last = -1  # the latest of all

    def add(self, slots: np.ndarray, scan: int) -> None:
        self.earliest[slots] = np.minimum(self.earliest[slots], scan)
        self.latest[slots] = self.last = scan

    def folded(self, most: int) -> Active:
        """The same with neighbouring slots as one: no more bits than ``most``, nor than the taken slots ask for."""
        bits = len(self.earliest).bit_length() - 1
        small = Active(min(bits, most, (SPARE_SLOTS * int(np.count_nonzero(self.earliest < NEVER))).bit_length()))
        small.earliest = self.earliest.reshape(len(small.earliest), -1).min(axis=1)
        small.latest = self.latest.reshape(len(small.latest), -1).max(axis=1)
        small.last = self.last
        return small


class Chunk:
    """Words of a chunk by place, and the hashes of the phrases that begin there, longer from step to step."""

    def __init__(self, lang: str, vocabulary: bytes, places: bytes):
        self.w = np.frombuffer(places, np.int32).astype(np.int64)
        self.words = [b"", *vocabulary.split(b"\n")[:-1]]
        self.hashes = _word_hashes(lang, self.words)
        self.length, self.valid, self.sub = 1, self.w > 0, self.hashes[self.w]

    def longer(self) -> None:
        after = self.w[self.length :]
        self.sub = _joined(self.sub[:-1], self.hashes[after])
        self.valid = self.valid[:-1] & (after > 0)
        self.length += 1


def counted(chunk: Chunk, scan: int, shards: int, longest: int, active: dict[int, Active]):
    """``length, hashes, counts`` of all phrases of a chunk that may be active in this scan and not counted in this shard."""
    if scan < shards:
        yield 1, *np.unique(chunk.sub[chunk.valid], return_counts=True)
    while chunk.length < longest and chunk.length in active and len(chunk.sub) > 1:
        state = active[chunk.length]
        slots = _slots(chunk.sub, state.earliest)
        early, late = state.earliest[slots], state.latest[slots].astype(np.int16)
        chunk.longer()
        may = chunk.valid & (np.maximum(early[:-1], early[1:]) <= scan)
        if not may.any():
            return
        yield chunk.length, *np.unique(chunk.sub[may & (np.maximum(late[:-1], late[1:]) + shards > scan)], return_counts=True)


def spelled(lang: str, chunk: Chunk, frequent: dict[int, np.ndarray]):
    """Batches of exact counts of the phrases of a chunk whose hashes are in the tables of frequent ones."""
    w, size, table = chunk.w, len(chunk.words), pa.array(chunk.words, pa.binary())
    key, bound, unpack, may = w, size, [], chunk.valid
    while chunk.length in frequent:
        chosen = may & frequent[chunk.length][_slots(chunk.sub, frequent[chunk.length])]
        keys, n = np.unique(key[chosen], return_counts=True)
        for k in range(0, len(keys), OUT_ROWS):
            columns, left = [], keys[k : k + OUT_ROWS]
            for at in range(chunk.length, 0, -1):
                for place, known in unpack:
                    if place == at < chunk.length:
                        left = known[left]
                columns.insert(0, table.take(pa.array(left % size if at > 1 else left)))
                left = left // size
            phrase = columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, b" ")
            rows = len(phrase)
            arrays = [pa.array([lang] * rows, pa.string()), pa.array(np.full(rows, chunk.length, np.int32)), phrase, pa.array(n[k : k + OUT_ROWS])]
            yield pa.RecordBatch.from_arrays(arrays, schema=_PHRASES)
        if len(chunk.sub) < 2:
            return
        if bound > 2**62 // size:  # the phrases so far get numbers of their own
            known = np.unique(key[chunk.valid])
            unpack.append((chunk.length, known))
            key, bound = np.searchsorted(known, key), len(known) + 1
        chunk.longer()
        may = chunk.valid & chosen[:-1] & chosen[1:]  # parts of a frequent phrase are frequent
        key = key[:-1] * size + w[chunk.length - 1 :]
        bound *= size


def _chunks(docs: DataFrame, shards: int) -> DataFrame:
    """The corpus as chunks of one language, dealt to shards, written."""

    def cut(batches):
        held: dict[str, list[bytes]] = defaultdict(list)
        sizes: dict[str, int] = defaultdict(int)
        turn = TaskContext.get().partitionId()

        def chunk(lang: str) -> pa.RecordBatch:
            nonlocal turn
            turn += 1
            sizes.pop(lang)
            return pa.RecordBatch.from_pylist([dict(zip(_CHUNKS.names, (lang, *numbered(held.pop(lang)), turn % shards)))], schema=_CHUNKS)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held[lang].append(text.as_py())
                sizes[lang] += len(held[lang][-1]) + 1
                if sizes[lang] >= CHUNK_BYTES:
                    yield chunk(lang)
                elif sum(sizes.values()) >= 4 * CHUNK_BYTES:
                    yield chunk(max(sizes, key=sizes.get))
        for lang in list(held):
            yield chunk(lang)

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(lang, text).mapInArrow(cut, "lang string, vocabulary binary, places binary, n long, shard int")
    return staged(rows, "corpus", ("shard",))


def _planes(numbers: np.ndarray) -> bytes:
    """64-bit numbers with their first bytes first, then their second bytes and so on: small ones compress well."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _block(words: int, part: int, old: bool, hashes: np.ndarray, totals: np.ndarray, shards: np.ndarray, reached: np.ndarray | None = None) -> dict:
    """A row of counts. ``hashes`` are in order and travel as differences."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    values = words, part, old, _planes(steps), _planes(totals), shards.tobytes(), b"" if reached is None else reached.astype("<u4").tobytes()
    return dict(zip(_BLOCKS.names, values))


def _counts(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """``hashes, totals`` of a block."""
    return np.cumsum(_numbers(row["hashes"]), dtype=np.uint64), _numbers(row["totals"]).astype(np.int64)


def merged(rows: list[dict], shard: int, least: int, bits: int) -> dict:
    """The state of one length and range of hashes after a scan: hashes in order, totals, and the shards in them as bits.

    ``rows`` are the state before, if any, and blocks of new counts. What a shard has been counted for before stays as it
    is. ``reached`` are the slots of hashes that have come to ``least``.
    """
    h, t, m = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    new = []
    for r in rows:
        if r["old"]:
            h, t = _counts(r)
            m = np.frombuffer(r["shards"], np.uint8).copy()
        else:
            new.append(_counts(r))
    bit = np.uint8(1 << shard)
    hashes, n = _summed(new)
    at = np.searchsorted(h, hashes)
    known = np.zeros(len(hashes), bool)
    known[at < len(h)] = h[at[at < len(h)]] == hashes[at < len(h)]
    place, more = at[known], np.where(m[at[known]] & bit, 0, n[known])
    fresh = (t[place] < least) & (t[place] + more >= least)
    t[place] += more
    m[place] |= bit
    first = ~known
    reached = np.concatenate([hashes[known][fresh], hashes[first & (n >= least)]])
    h, t, m = np.insert(h, at[first], hashes[first]), np.insert(t, at[first], n[first]), np.insert(m, at[first], bit)
    slots = np.unique(reached >> np.uint64(64 - bits))
    return _block(rows[0]["words"], rows[0]["part"], True, h, t, m, slots)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, place = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
    return hashes, np.bincount(place, np.concatenate([n for _, n in parts]), len(hashes)).astype(np.int64)


def _scanned(shard: DataFrame, scan: int, shards: int, longest: int, least: int, bits: int, active: dict[int, Active], states: dict[int, DataFrame]) -> DataFrame:
    """The states of the lengths that one scan counts, merged with ``states`` and written."""
    shared = shard.sparkSession.sparkContext.broadcast({k: a.folded(SLOT_BITS) for k, a in active.items() if k < longest})
    slot_bits = SLOT_BITS

    def count(batches):
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)

        def blocks():
            for words, parts in held.items():
                hashes, n = _summed(parts)
                part = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
                starts = np.flatnonzero(np.diff(part, prepend=-1))
                ends = np.append(starts[1:], len(part))
                rows = [_block(words, int(part[a]), False, hashes[a:b], n[a:b], np.zeros(0, np.uint8)) for a, b in zip(starts, ends)]
                for k in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_pylist(rows[k : k + 256], schema=_BLOCKS)
            held.clear()

        for batch in batches:
            for row in batch.to_pylist():
                for length, *found in counted(Chunk(row["lang"], row["vocabulary"], row["places"]), scan, shards, longest, shared.value):
                    held[length].append(found)
                if sum(len(h) for parts in held.values() for h, _ in parts) >= HELD_COUNTS:
                    yield from blocks()
        yield from blocks()

    def merge(rows: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([merged(rows.to_pylist(), scan % shards, least, slot_bits)], schema=_BLOCKS)

    found = shard.select("lang", "vocabulary", "places").mapInArrow(count, _BLOCKS_SQL)
    for length, state in states.items():
        found = found.unionByName(state)
    written = staged(found.groupBy("words", "part").applyInArrow(merge, _BLOCKS_SQL), f"scan-{scan}", ("words",)).select(*_BLOCKS.names)
    shared.destroy()
    return written


def phrase_counts(docs: DataFrame, least: int = 10, longest: int = 3, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """``lang, words, phrase, f`` of all phrases with at least ``least`` occurrences, and ``lang, n`` of all words.

    Phrases have 1 to ``longest`` words; ``words`` says how many. Both results are written. The driver gets the slots
    of what became active or frequent, at most a power of two a length; counts stay in tables. Hashes are dealt to
    ranges of like size, as many as the corpus asks for, and a frequent phrase is one number of its range.
    """
    if not 1 <= shards <= 8:
        raise ValueError("a phrase keeps its shards as the bits of a byte: 1 to 8")
    spark = docs.sparkSession
    prepare(spark)
    with recorded() as folders, shuffles_removed(spark):
        corpus = _chunks(docs, shards)
        size = corpus.agg(F.sum("n")).first()[0] or 0
        bits = min(SLOT_BITS, (size // RANGE_WORDS).bit_length())
        states: dict[int, DataFrame] = {}
        active: dict[int, Active] = {}
        written_for: list[tuple[list[str], set[int]]] = []  # folders of states, and the lengths read from them
        scan = 0
        while scan < shards or any(a.last + shards > scan for k, a in active.items() if k < longest):
            # The lengths that this scan counts; the states of the others stay where they are.
            open_ = [k for k in range(1, longest + 1) if (scan < shards if k == 1 else k - 1 in active and active[k - 1].last + shards > scan)]
            own = {k: states[k] for k in open_ if k in states}
            with recorded() as new:
                written = _scanned(corpus.where(F.col("shard") == scan % shards), scan, shards, longest, least, bits, active, own)
            scan += 1
            for length in open_:
                states[length] = written.where(F.col("words") == length)
            for paths, lengths in written_for:
                if lengths and not lengths - set(open_):
                    remove(spark, paths)
                lengths -= set(open_)
            written_for.append((new, set(open_)))
            for r in written.where(F.length("reached") > 0).select("words", "reached").toLocalIterator():
                if r["words"] not in active:
                    active[r["words"]] = Active(SLOT_BITS)
                active[r["words"]].add(np.frombuffer(r["reached"], "<u4").astype(np.int64), scan)
        # What has reached the threshold is frequent; a state is not read again to see that.
        frequent = {length: a.folded(FREQUENT_BITS).earliest < NEVER for length, a in active.items()}
        active.clear()
        for paths, lengths in written_for:
            if lengths:
                remove(spark, paths)
    shared = spark.sparkContext.broadcast(frequent)

    def spell(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from spelled(row["lang"], Chunk(row["lang"], row["vocabulary"], row["places"]), shared.value)

    phrases = corpus.select("lang", "vocabulary", "places").mapInArrow(spell, "lang string, words int, phrase binary, n long")
    sums = phrases.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    with shuffles_removed(spark):
        found = staged(sums.select("lang", F.col("phrase").cast("string").alias("phrase"), "f", "words"), "phrases", ("words",))
        totals = staged(corpus.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"), "totals")
    shared.destroy()
    remove(spark, folders)
    return found, totals


def _part(first: int, last: int):
    """Words ``first`` to ``last`` (from 1, inclusive) of a phrase."""
    return F.concat_ws(" ", F.slice(F.split("phrase", " "), first, last - first + 1))


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, keep: int = 2000, share: int = 50, shards: int = SHARDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the phrases of each language whose words belong together most.

    Words are runs of anything but spaces and tabs, with A to Z in lower case, within pieces that end at
    ``. , ; : ! ?`` and line ends. A phrase of 2 to ``longest`` words that occurs ``a >= least`` times is scored at each cut into a
    first part, which occurs ``l`` times, and a rest, ``r`` times: ``floor(1000000 a a / (l r))``; its lowest score counts, of equal ones that
    of the shortest first part. Phrases whose words lie in a longer one with ``100 f >= share * a`` are dropped. The first
    ``keep`` by score, ``a`` and phrase (as bytes) of each language are returned; ``n`` is its number of words.

    Null texts are empty and a null language is ``und``; ids are not looked at, repeated rows count as often as they
    occur, no rows give no rows, and other columns are ignored. Numbers are exact up to ``a`` of 10^15.
    """
    found, totals = phrase_counts(docs, least, longest, shards)

    def of(words: int, key: str, value: str) -> DataFrame:
        rows = found.where(F.col("words") == words)
        return rows.select("lang", F.col("phrase").alias(key), F.col("f").alias(value))

    scored = None
    for length in range(2, longest + 1):
        cuts = of(length, "phrase", "a")
        names = []
        for k in range(1, length):
            cuts = cuts.withColumns({"first": _part(1, k), "rest": _part(k + 1, length)})
            cuts = cuts.join(of(k, "first", f"l{k}"), ["lang", "first"]).join(of(length - k, "rest", f"r{k}"), ["lang", "rest"])
            wide = {x: f"cast({x} as decimal(15,0))" for x in ("a", f"l{k}", f"r{k}")}
            score = F.expr(f"({wide['a']} * {wide['a']} * cast(1000000 as decimal(7,0))) div ({wide[f'l{k}']} * {wide[f'r{k}']})")
            cuts = cuts.withColumn(f"cut{k}", F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
            names.append(f"cut{k}")
        lowest = F.array_min(F.array(*names))
        rows = cuts.select("lang", "phrase", "a", F.lit(length).alias("words"), lowest.alias("cut")).select("lang", "phrase", "a", "words", "cut.l", "cut.r", "cut.score")
        scored = rows if scored is None else scored.unionByName(rows)
    if scored is None:
        raise ValueError("phrases have two words at least")

    inside = []
    for length in range(3, longest + 1):
        parts = [_part(i, i + k - 1) for k in range(2, length) for i in range(1, length - k + 2)]
        inside.append(of(length, "phrase", "f").select("lang", "f", F.explode(F.array(*parts)).alias("phrase")))
    if inside:
        around = reduce(DataFrame.unionByName, inside).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
        scored = scored.join(around, ["lang", "phrase"], "left").where(F.col("f").isNull() | (100 * F.col("f") < share * F.col("a")))

    # The first of each part of a language, then the first of those: no task gets a whole language.
    best = F.desc("score"), F.desc("a"), "phrase"
    parted = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    first = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))
    ranked = parted.withColumn("rank", first).where(F.col("rank") <= keep).drop("part")
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= keep)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
