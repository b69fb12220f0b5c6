"""Suffix-array dedup: removes every byte of a string of a given length that also starts earlier.

A string of 100 bytes can only recur where its anchor recurs: of its 77 runs of 24 bytes, the one with the
smallest hash, the leftmost of equals. Neighbouring strings mostly share their anchor, so the suffixes that
begin at anchors stand for all suffixes, about one for 38 bytes.

1. Anchors meet by hash. One that occurs once ends there; of those whose whole surroundings are equal all
   but the first are repeats as they are. Only the first of each, where surroundings differ, go on.
2. Their suffixes (100 bytes from the anchor, with the bytes before it) are range-partitioned by leading
   bytes with splitters from a sample, so a bucket is a piece of the suffix array, however often one
   beginning occurs. Each bucket is sorted by multikey quicksort. Strings at one distance before the anchor
   are equal if their suffixes share enough leading bytes (neighbours in the sorted bucket) and the
   bytes before are equal.
3. A string can have an equal in another bucket only if it shares what it needs of its suffix with its
   bucket's first or last row: the first of such strings in each bucket are open. Neighbouring ones of an
   anchor travel as one run of bytes. Equal strings lie equally far before their anchors, so their distances fall
   into one segment of a fixed grid, and the bytes that all strings of that segment cover are equal too:
   only segments whose common bytes occur again are spelled out as strings and meet by the least place of each.

Nothing is capped: a sample of documents only tells which anchors are so frequent that their rows are
spread over several tasks, each of which passes its own first on to step 2.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingpanel.llm.common import partitions, prepare, text_or_empty
from filingpanel.session import staged

LENGTH = 100
ANCHOR = 24
REACH = LENGTH - ANCHOR  # the farthest that an anchor lies behind a string's start

#: Bytes that are hashed at once.
BLOCK = 1 << 20

#: One document of so many is read for frequent anchors, what is frequent there, and how many are told.
SAMPLED, FREQUENT, MOST_FREQUENT = 32, 4, 200_000
SALTS = 64

#: Distances in one segment of the grid on which open strings meet.
SEGMENT = 11

#: Stands for a null doc_id: null comes first.
FIRST_KEY = -(2**63)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _BASE
    return x ^ (x >> np.uint64(32))


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, and the powers of the base and of its inverse."""
    size = BLOCK + LENGTH + 1
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    powers = [np.concatenate([[np.uint64(1)], np.full(size - 1, x, np.uint64)]) for x in (_BASE, inverse)]
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, 257, dtype=np.uint64) * _BASE), np.multiply.accumulate(powers[0]), np.multiply.accumulate(powers[1])


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any span."""
    letters, powers, _ = _tables()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letters[data] * powers[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((sums[end] - sums[start]) * _tables()[2][start])


def anchors(data: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of string starts with one anchor: first and last start, anchor, its hash, and the hash of all their bytes.

    ``owner`` tells the document of each byte; strings lie within one document.
    """
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    sums = prefix_sums(data)
    at = np.arange(len(data) - ANCHOR + 1)
    grams = mixed((sums[ANCHOR:] - sums[: len(sums) - ANCHOR]) * _tables()[2][: len(at)])
    low = np.uint64((1 << 21) - 1)
    least = (grams & ~low) | at.astype(np.uint64)  # smallest hash, then leftmost
    width = 1
    while width * 2 <= REACH + 1:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = REACH + 1 - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    place = (least & low).astype(np.int64)[:n]
    valid = owner[:n] == owner[LENGTH - 1 :]
    starts = valid.copy()
    starts[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    ends = valid.copy()
    ends[:-1] &= ~valid[1:] | (place[1:] != place[:-1])
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    a = place[s]
    whole = mixed(span_hash(sums, s, e + LENGTH) + (a - s).astype(np.uint64) * _BASE + (e - s).astype(np.uint64))
    return s, e, a, grams[a], whole


def _pieces(blobs: list[bytes]):
    """Blocks of documents' bytes; a longer document is cut with as much overlap as strings need."""
    block, size = [], 0
    for i, blob in enumerate(blobs):
        for begin in range(0, max(1, len(blob) - LENGTH + 1), BLOCK - LENGTH + 1):
            part = blob[begin : begin + BLOCK]
            if block and size + len(part) > BLOCK:
                yield block
                block, size = [], 0
            block.append((i, begin, part))
            size += len(part)
    if block:
        yield block


def anchors_of(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """For all documents: whose it is, first and last start, anchor (places within the document), two hashes."""
    found = []
    for block in _pieces([b for b in blobs]):
        data = np.frombuffer(b"".join(p for _, _, p in block), np.uint8)
        lengths = [len(p) for _, _, p in block]
        owner = np.repeat(np.arange(len(block)), lengths)
        s, e, a, h, w = anchors(data, owner)
        piece = owner[s] if len(s) else np.zeros(0, np.int64)
        shift = np.array([b for _, b, _ in block], np.int64) - np.concatenate([[0], np.cumsum(lengths)[:-1]])
        whose = np.array([i for i, _, _ in block], np.int64)
        found.append((whose[piece], s + shift[piece], e + shift[piece], a + shift[piece], h, w))
    if not found:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    return tuple(np.concatenate(x) for x in zip(*found))


def multikey_order(words: np.ndarray) -> np.ndarray:
    """The order of rows by their columns, by multikey quicksort: a column is only looked at within rows equal before it."""
    order = np.argsort(words[:, 0], kind="stable")
    sorted_words = words[order, 0]
    group = np.concatenate([[0], np.cumsum(sorted_words[1:] != sorted_words[:-1])]) if len(order) else order
    for column in range(1, words.shape[1]):
        sizes = np.bincount(group)
        active = np.flatnonzero(sizes[group] > 1)
        if not len(active):
            break
        keys = words[order[active], column]
        inside = np.lexsort((keys, group[active]))
        order[active] = order[active[inside]]
        keys, owner = keys[inside], group[active][inside]
        step = np.zeros(len(order), np.int64)
        step[active[1:]] = (owner[1:] == owner[:-1]) & (keys[1:] != keys[:-1])
        step[1:] |= group[1:] != group[:-1]
        group = np.cumsum(step)
    return order


def _padded(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), np.uint8).reshape(len(parts), width)
    return data, lengths


def _words(data: np.ndarray) -> np.ndarray:
    """Rows of bytes as columns of eight each, whose order as numbers is that of the bytes."""
    return data.reshape(len(data), -1, 8)[:, :, ::-1].copy().view(np.uint64)[:, :, 0]


def _common(data: np.ndarray) -> np.ndarray:
    """How many leading bytes each row shares with the one before it."""
    differ = data[1:] != data[:-1]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), data.shape[1])


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each run of marks."""
    edge = np.zeros((len(marks), marks.shape[1] + 2), np.int8)
    edge[:, 1:-1] = marks
    change = np.diff(edge, axis=1)
    row, first = np.nonzero(change == 1)
    _, last = np.nonzero(change == -1)
    return row, first, last - 1


class Bucket:
    """A piece of the suffix array: suffixes at anchors in order, with the bytes before each anchor."""

    def __init__(self, rows: pd.DataFrame):
        right, rl = _padded(list(rows["right"]), 104)
        order = multikey_order(np.concatenate([_words(right), rl[:, None].astype(np.uint64)], axis=1))
        self.rows = rows.iloc[order].reset_index(drop=True)
        self.right, self.rl = right[order], rl[order]
        self.left, _ = _padded([bytes(x)[::-1] for x in self.rows["left"]], 80)  # from the anchor backwards
        a, s, e = (self.rows[c].to_numpy() for c in "ase")
        self.low, self.high = a - e, a - s  # distances of the strings' starts before the anchor
        self.common = np.minimum(_common(self.right), np.minimum(self.rl[1:], self.rl[:-1]))
        self.by_left = multikey_order(_words(self.left))
        self.left_common = _common(self.left[self.by_left])
        k, sub = self.rows["k"].to_numpy(), self.rows["sub"].to_numpy()
        self.first = np.empty(len(rows), np.int64)  # place in the order of occurrence
        self.first[np.lexsort((a, sub, k))] = np.arange(len(rows))

    def compared(self) -> tuple[np.ndarray, np.ndarray]:
        """For each row and distance: whether the string there has an earlier equal in this bucket, and whether it
        can have an equal in a neighbouring one: if what it needs of its suffix is that of the first or last row."""
        marks = np.zeros((len(self.first), REACH + 1), bool)
        edges, before = np.zeros_like(marks), np.zeros(len(self.first), np.int64)
        for o in range(REACH + 1):
            whole = np.concatenate([[0], np.cumsum(self.common < LENGTH - o)])
            own = (self.low <= o) & (o <= self.high)
            edges[:, o] = own & ((whole == 0) | (whole == whole[-1]))
            at = np.flatnonzero(own)
            if len(at) < 2:
                continue
            before[self.by_left[1:]] = np.cumsum(self.left_common < o)  # equal where the bytes before the anchor are
            before[self.by_left[0]] = 0
            group, prior = whole[at], before[at]
            order = np.lexsort((self.first[at], prior, group))
            equal = (group[order[1:]] == group[order[:-1]]) & (prior[order[1:]] == prior[order[:-1]])
            marks[at[order[1:][equal]], o] = True
        return marks, edges

    def open_runs(self, chosen: np.ndarray) -> pd.DataFrame:
        """The chosen strings (by row and distance) for comparison across buckets, a row for each run of distances:
        its bytes, the distance of its first string, and a hash for each segment of the grid that it touches."""
        row, near, far = _runs(chosen)
        picked = self.rows.iloc[row]
        a, spans, cores = picked["a"].to_numpy(), [], []
        for r, n, f in zip(row.tolist(), near.tolist(), far.tolist()):
            span = self.left[r, :f][::-1].tobytes() + self.right[r, : LENGTH - n].tobytes()
            spans.append(span)
            cores.append([_core(span, f, j) for j in range(n // SEGMENT, f // SEGMENT + 1)])
        places = {"k": picked["k"].to_numpy(), "sub": picked["sub"].to_numpy(), "s": a - far, "e": a - near}
        return pd.DataFrame({**places, "o": far, "span": spans, "cores": cores})


def _core(span: bytes, far: int, segment: int) -> int:
    """A hash of the bytes that strings at all distances of a segment cover; ``span`` begins ``far`` before the anchor."""
    first, last = segment * SEGMENT, min((segment + 1) * SEGMENT - 1, REACH)
    return xxhash.xxh64_intdigest(span[far - first : far + LENGTH - last], segment) - (1 << 63)


_RANGE = "k long, sub long, s long, e long"


class Corpus:
    """Documents as bytes in order: by ``k`` (the id, null first) and, where an id repeats, by ``sub``."""

    def __init__(self, docs: DataFrame):
        self.spark = docs.sparkSession
        prepare(self.spark)
        k = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST_KEY))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), k.alias("k"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        repeated = staged(rows.groupBy("k").count().where("count > 1").select("k"), "repeated")
        self.repeats = repeated.limit(1).count() > 0
        if self.repeats:
            rows = rows.join(repeated.withColumn("again", F.lit(True)), "k", "left")
            rows = rows.withColumn("sub", F.when(F.col("again"), F.xxhash64("text")).otherwise(F.lit(0))).drop("again")
        else:
            rows = rows.withColumn("sub", F.lit(0).cast("long"))
        self.rows = rows.select("doc_id", "k", "sub", "text")

    def anchors(self, rows: DataFrame, hot: np.ndarray) -> DataFrame:
        shared = self.spark.sparkContext.broadcast(hot)

        def found(batches):
            hot = shared.value
            for part in batches:
                blobs = [t.encode("utf-8", "surrogatepass") for t in text_or_empty(part["text"])]
                whose, s, e, a, h, w = anchors_of(blobs)
                if not len(s):
                    continue
                k, sub = part["k"].to_numpy()[whose], part["sub"].to_numpy()[whose]
                salt = np.zeros(len(s), np.int16)
                if len(hot):
                    place = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
                    spread = mixed(w ^ k.astype(np.uint64) ^ sub.astype(np.uint64)) % np.uint64(SALTS)
                    salt = np.where(hot[place] == h, 1 + spread.astype(np.int64), 0).astype(np.int16)
                packed = a << 14 | (a - s) << 7 | (e - s)
                yield pd.DataFrame({"h": h.view(np.int64), "salt": salt, "w": w.view(np.int64), "k": k, "sub": sub, "p": packed})

        return rows.mapInPandas(found, "h long, salt short, w long, k long, sub long, p long")

    def hot_anchors(self) -> np.ndarray:
        sample = self.rows.where(F.pmod(F.xxhash64("k", F.lit(1)), F.lit(SAMPLED)) == 0)
        counts = self.anchors(sample, np.zeros(0, np.uint64)).groupBy("h").agg(F.count("*").alias("n"))
        top = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "h").limit(MOST_FREQUENT)
        return np.sort(np.array([r["h"] for r in top.collect()], np.int64).view(np.uint64))

    def met(self) -> DataFrame:
        """``repeat`` rows: starts s to e that repeat as they are; the others go on to the suffix array, with anchor a."""
        rows = self.anchors(self.rows, self.hot_anchors())
        dealt = rows.repartition(partitions(self.spark), "h", "salt")

        def resolved(batches):
            parts = [b for b in batches]
            if not parts:
                return
            names = ("h", "w", "k", "sub", "p", "salt")
            h, w, k, sub, p, salt = (np.concatenate([b[c].to_numpy() for b in parts]) for c in names)
            del parts
            order = np.lexsort((p, sub, k, w, h))
            h, w, k, sub, p, salt = (x[order] for x in (h, w, k, sub, p, salt))
            new_h = np.ones(len(h), bool)
            new_h[1:] = h[1:] != h[:-1]
            new_w = new_h.copy()
            new_w[1:] |= w[1:] != w[:-1]
            same = np.zeros(len(h), bool)  # a row repeated as a whole is one place
            same[1:] = ~new_w[1:] & (k[1:] == k[:-1]) & (sub[1:] == sub[:-1]) & (p[1:] == p[:-1])
            group = np.cumsum(new_h) - 1
            kinds = np.bincount(group, weights=new_w)[group]
            lead = np.cumsum(new_w) - 1  # a place that equals the first one as a whole is the first one
            at_first = np.flatnonzero(new_w)[lead]
            own = (k == k[at_first]) & (sub == sub[at_first]) & (p == p[at_first])
            repeat = ~new_w & ~own & ~same
            on = new_w & ((kinds > 1) | (salt > 0))
            chosen = repeat | on
            a = p >> 14
            s = a - (p >> 7 & 127)
            yield pd.DataFrame(
                {"repeat": repeat[chosen], "k": k[chosen], "sub": sub[chosen], "a": a[chosen], "s": s[chosen], "e": (s + (p & 127))[chosen]}
            )

        return dealt.mapInPandas(resolved, "repeat boolean, k long, sub long, a long, s long, e long")

    def suffixes(self, places: DataFrame) -> DataFrame:
        """The anchors' suffixes and the bytes before them, cut from their texts."""
        listed = places.groupBy("k", "sub").agg(F.collect_list(F.struct("a", "s", "e")).alias("places"))
        rows = self.rows.select("k", "sub", "text")
        if self.repeats:
            rows = rows.dropDuplicates(["k", "sub"])
        joined = rows.join(listed, ["k", "sub"])

        def cut(batches):
            for part in batches:
                out = {c: [] for c in ("k", "sub", "a", "s", "e", "left", "right")}
                for k, sub, text, found in zip(part["k"], part["sub"], part["text"], part["places"]):
                    blob = text.encode("utf-8", "surrogatepass")
                    for x in found:
                        a, s = x["a"], x["s"]
                        for name, value in (("k", k), ("sub", sub), ("a", a), ("s", s), ("e", x["e"])):
                            out[name].append(value)
                        out["left"].append(blob[s:a])
                        out["right"].append(blob[a : a + LENGTH])
                yield pd.DataFrame(out)

        return joined.mapInPandas(cut, "k long, sub long, a long, s long, e long, left binary, right binary")

    def compared(self, places: DataFrame) -> DataFrame:
        """Starts that repeat (``span`` null), and runs of strings still to be compared across buckets."""
        cut = self.suffixes(places)
        ranged = cut.repartitionByRange(partitions(self.spark), "right", "k", "sub", "a")

        def searched(batches):
            parts = [b for b in batches if len(b)]
            if not parts:
                return
            bucket = Bucket(pd.concat(parts, ignore_index=True))
            del parts
            repeats, edges = bucket.compared()
            row, near, far = _runs(repeats)
            picked = bucket.rows.iloc[row]
            a = picked["a"].to_numpy()
            inner = pd.DataFrame({"k": picked["k"].to_numpy(), "sub": picked["sub"].to_numpy(), "s": a - far, "e": a - near})
            yield inner.assign(o=0, span=None, cores=None)
            yield bucket.open_runs(edges & ~repeats)

        return ranged.mapInPandas(searched, _RANGE + ", o int, span binary, cores array<long>")


def across(runs: DataFrame) -> DataFrame:
    """Strings of open runs of which an equal one starts earlier, by the least place of each; counted before the shuffle."""
    parts = runs.select("k", "sub", "s", "e", "o", "span", F.posexplode("cores").alias("segment", "core"))
    again = parts.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    left = parts.join(again, "core", "left_semi").select("k", "sub", "s", "e", "o", "span", "segment")

    def spelled(batches):
        for part in batches:
            out = {c: [] for c in ("k", "sub", "s", "w1", "w2")}
            for k, sub, s, e, far, span, place in part.itertuples(index=False):
                near = far - (e - s)
                first = (near // SEGMENT + place) * SEGMENT
                for o in range(max(near, first), min(far, first + SEGMENT - 1) + 1):
                    whole = xxhash.xxh3_128_digest(span[far - o : far - o + LENGTH])
                    for name, value in zip(out, (k, sub, s + far - o, *np.frombuffer(whole, np.int64))):
                        out[name].append(value)
            yield pd.DataFrame(out)

    strings = staged(left.mapInPandas(spelled, "k long, sub long, s long, w1 long, w2 long"), "strings")
    place = F.struct("k", "sub", "s")
    firsts = strings.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    found = strings.join(firsts.select("w1", "w2", "first"), ["w1", "w2"]).where(place != F.col("first"))
    return found.select("k", "sub", "s", F.col("s").alias("e"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row: its UTF-8 bytes without those of repeated strings.

    A byte goes if a string of 100 bytes over it also starts earlier: in a document before (by ``doc_id``,
    null first), or further left in the same one. Strings are judged on the input. ``n_spans`` counts
    maximal removed runs; ``kept`` is binary, since a cut may split a character. Null counts as
    the empty text; texts under 100 bytes stay whole. Rows repeated under one id are documents of their own,
    ordered by a hash of the text; of equal rows one comes first and the others go whole. Other columns
    are not looked at. No rows give no rows.
    """
    corpus = Corpus(docs)
    met = staged(corpus.met(), "anchors")
    compared = staged(corpus.compared(met.where(~F.col("repeat")).select("k", "sub", "a", "s", "e")), "suffixes")
    ranges = met.where("repeat").select("k", "sub", "s", "e")
    ranges = ranges.union(compared.where("span IS NULL").select("k", "sub", "s", "e"))
    ranges = ranges.union(across(compared.where("span IS NOT NULL")))
    listed = ranges.groupBy("k", "sub").agg(F.collect_list("s").alias("from"), F.collect_list("e").alias("to"))
    joined = corpus.rows.join(listed, ["k", "sub"], "left")
    copy = F.row_number().over(Window.partitionBy("k", "sub").orderBy("doc_id")) > 1 if corpus.repeats else F.lit(False)
    joined = joined.select("doc_id", "text", "from", "to", copy.alias("copy"))

    def cut(batches):
        for part in batches:
            out = {"doc_id": part["doc_id"], "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            for text, first, last, copied in zip(part["text"], part["from"], part["to"], part["copy"]):
                blob = text.encode("utf-8", "surrogatepass")
                n = len(blob)
                steps = np.zeros(n + 1, np.int64)
                if copied and n >= LENGTH:
                    steps[0], steps[n] = 1, -1
                elif first is not None and len(first):
                    np.add.at(steps, np.asarray(first, np.int64), 1)
                    np.add.at(steps, np.asarray(last, np.int64) + LENGTH, -1)
                gone = np.cumsum(steps[:n]) > 0
                out["n_bytes"].append(n)
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((gone[1:] & ~gone[:-1]).sum() + (n > 0 and gone[0])))
                out["kept"].append(np.frombuffer(blob, np.uint8)[~gone].tobytes() if gone.any() else blob)
            yield pd.DataFrame(out)

    return joined.mapInPandas(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
