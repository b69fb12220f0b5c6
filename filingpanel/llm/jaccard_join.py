"""N-gram Jaccard join with count vectors and an R-tree, returned as connected documents.

A document's set are the hashes of its distinct word n-grams. Two sets link when their intersection is at
least num/den of their union; then they differ in at most D = (a + b) (den - num) / (den + num) elements.

1. Equal sets are one node. Tokens are hashed into G > D groups for documents of a band of sizes: at most
   D groups can differ, so linked nodes have a group of equal content. (band, group, content) is the key
   on which they meet; keys of one node only are dropped where they arrive.
2. Every node of a key is verified against the key's hub, the node with most shared keys, which
   connects a family of copies with as many checks as it has members.
3. Keys whose nodes are still in different components are searched in full: the nodes' counts in fixed
   groups are points of an R-tree, the overlap of two nodes is at most the sum of the coordinate minima,
   and a subtree is left out when that sum over its upper corner is below what a link needs.
   Nodes that surviving pairs connect are a cluster. It is searched once more with the whole sets, and
   pairs are verified until they connect what they can: no task returns more pairs than it has nodes.

Empty groups would make strangers meet. With G = D + 1 + s, equal groups number at least 1 + s, so a document
with at most s empty groups needs no key for them. Very frequent n-grams (from a sample) are first left
out of all groups, which cannot add differences; documents that lose too much that way write keys of their
complete groups as well. Neither rule loses a link, and the sample decides nothing but the amount of work.
"""

from __future__ import annotations

import dataclasses
import functools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingpanel.llm.common import partitions, prepare, text_or_empty, tidy
from filingpanel.llm.components import components
from filingpanel.session import staged

#: Coordinates of the points in the tree, and children of its nodes.
POINT_GROUPS, FANOUT = 128, 32

#: One document of so many is read for frequent n-grams and frequent keys; what counts as frequent there;
#: and how many of either are told to all tasks at most.
SAMPLED, FREQUENT, MOST_FREQUENT = 32, 4, 200_000

#: Tasks over which the rows of a frequent key are spread.
SALTS = 64

#: Nodes of a key or cluster that are searched in one task; more are searched block by block.
BLOCK_NODES = 1024

#: Ids up to this many are broadcast to find their texts; more are joined.
BROADCAST_IDS = 2_000_000

#: Bytes that are hashed at once; words beyond this length are hashed apart, alike in every text: from 1024 bytes
#: on there are words that any polynomial modulo 2^64 takes for one another.
BLOCK_BYTES, LONG_WORD = 1 << 20, 256

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * _MIX2
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


@dataclasses.dataclass(frozen=True)
class Rule:
    """Words of an n-gram, and the least similarity as a fraction."""

    words: int = 5
    num: int = 80
    den: int = 100

    @functools.cached_property
    def edges(self) -> list[int]:
        """First sizes of the bands; a link joins a band with itself or the next one."""
        step = max(self.den / self.num, 1.5 if self.num * 20 >= self.den * 17 else 1.0)
        edges = [1]
        while edges[-1] < 1 << 40:
            edges.append(max(edges[-1] + 1, int(edges[-1] * step), edges[-1] * self.den // self.num))
        return edges

    def band(self, n: int) -> int:
        return int(np.searchsorted(self.edges, n, "right")) - 1

    def differing(self, level: int) -> int:
        """Elements in which linked sets can differ if the larger lies in this band."""
        return 2 * (self.edges[level + 1] - 1) * (self.den - self.num) // (self.den + self.num)

    def levels(self, n: int) -> list[int]:
        """Bands in which a set of this size can be linked with a different set."""
        if not n:
            return []
        band = self.band(n)
        higher = n * self.den // self.num >= self.edges[band + 1]
        return [x for x in ([band, band + 1] if higher else [band]) if self.differing(x)]

    def slack(self, level: int) -> int:
        return 1 + self.differing(level) // 8

    def needed(self, total):
        """The least intersection of linked sets whose sizes add up to ``total``."""
        return -(-self.num * total // (self.num + self.den))


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a byte is white space, a random number for each byte, and powers of a base and its inverse."""
    size = BLOCK_BYTES + 1
    white = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
    powers = []
    for base in (_MIX, np.uint64(pow(int(_MIX), -1, 1 << 64))):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        powers.append(np.multiply.accumulate(steps))
    return white, mixed(np.arange(1, 257, dtype=np.uint64) * _MIX2), *powers


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a block begins, and its hash."""
    white, letters, powers, inverse = _tables()
    codes = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = ~white[codes]
    starts, ends = (np.flatnonzero(x) for x in (inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(letters[codes] * powers[: len(codes)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts])
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
    return starts, hashes


def _long_hashes(blob: bytes) -> np.ndarray:
    """The word hashes of a text beyond a block: its words in blocks, very long words apart."""
    out, block, size = [], [], 0
    for word in [*blob.split(), None]:
        if block and (word is None or size + len(word) >= BLOCK_BYTES):
            out.append(_word_hashes(b" ".join(block))[1])
            block, size = [], 0
        if word is not None and len(word) >= BLOCK_BYTES - 1:
            out.append(np.array([xxhash.xxh3_64_intdigest(word)], np.uint64))
        elif word is not None:
            block.append(word)
            size += len(word) + 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _set_of(hashes: np.ndarray, words: int) -> np.ndarray:
    """The hashes of a text's distinct n-grams, in order; of fewer words, the sequence as one."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    size = min(words, len(hashes))
    total = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        total = mixed(total * _MIX + hashes[k : k + len(total)])
    return np.unique(total)


def shingle_sets(texts: list[str], rule: Rule) -> list[np.ndarray]:
    """The n-gram set of each text, many texts at a time."""
    # Bytes: only A-Z are lowered, and only ASCII white space parts words.
    blobs = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    out: list = [None] * len(blobs)
    block: list[int] = []
    size = 0

    def finish() -> None:
        starts, hashes = _word_hashes(b" ".join([blobs[i] for i in block]))
        begins = np.cumsum([0] + [len(blobs[i]) + 1 for i in block])
        cuts = np.searchsorted(starts, begins)
        for i, a, b in zip(block, cuts[:-1], cuts[1:]):
            out[i] = _set_of(hashes[a:b], rule.words)

    for i, blob in enumerate(blobs):
        if len(blob) >= BLOCK_BYTES:
            out[i] = _set_of(_long_hashes(blob), rule.words)
            continue
        if size + len(blob) >= BLOCK_BYTES:
            finish()
            block, size = [], 0
        block.append(i)
        size += len(blob) + 1
    if block:
        finish()
    return out


def node_of(found: np.ndarray) -> int:
    """What stands for a set: equal sets have equal nodes."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def _sums(values: np.ndarray, groups: np.ndarray, size: int) -> np.ndarray:
    """The sum, modulo 2 to the 64, of the values of each group."""
    low = np.bincount(groups, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), size).astype(np.uint64)
    high = np.bincount(groups, (values >> np.uint64(32)).astype(np.float64), size).astype(np.uint64)
    return low + (high << np.uint64(32))


def keys_of(found: np.ndarray, rule: Rule, frequent: np.ndarray) -> np.ndarray:
    """The keys on which a set meets all sets that it can be linked with."""
    out = []
    rare = found
    if len(frequent) and len(found):
        place = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        rare = found[frequent[place] != found]
    for level in rule.levels(len(found)):
        slack = rule.slack(level)
        groups = rule.differing(level) + 1 + slack
        for variant, members in enumerate((rare, found)):
            index = (mixed(members ^ np.uint64(level + 1)) % np.uint64(groups)).astype(np.int64)
            content = _sums(mixed(members + _MIX), index, groups)
            filled = np.bincount(index, minlength=groups) > 0
            empty = groups - int(filled.sum())
            whole = variant == 1 and empty > slack
            chosen = np.arange(groups) if whole else np.flatnonzero(filled)
            tag = np.uint64((level * 2 + variant + 1) * 0x1000003)
            out.append(mixed(mixed(content[chosen] + tag) + chosen.astype(np.uint64) * _MIX))
            if empty <= slack:
                break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def point_of(found: np.ndarray) -> np.ndarray:
    return np.bincount((mixed(found) % np.uint64(POINT_GROUPS)).astype(np.int64), minlength=POINT_GROUPS).astype(np.uint32)


class CountTree:
    """An R-tree over count vectors, packed in order of size and then of the first coordinates."""

    def __init__(self, points: np.ndarray, rule: Rule):
        self.rule = rule
        sizes = points.sum(axis=1, dtype=np.int64)
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        corner, least = points[self.order], sizes[self.order]
        self.levels = [(corner, least)]  # from the points up: upper corners, and least sizes
        while len(corner) > FANOUT:
            starts = np.arange(0, len(corner), FANOUT)
            corner, least = np.maximum.reduceat(corner, starts), np.minimum.reduceat(least, starts)
            self.levels.append((corner, least))

    def search(self, point: np.ndarray) -> np.ndarray:
        """Places of all points whose overlap with this one may be enough for a link."""
        size = int(point.sum())
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, least = self.levels[depth]
            bound = np.minimum(corner[at], point).sum(axis=1, dtype=np.int64)
            at = at[bound >= self.rule.needed(least[at] + size)]
            if depth:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).reshape(-1)
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]


def linked(a: np.ndarray, b: np.ndarray, rule: Rule) -> bool:
    """Whether two sets, as ordered arrays, are similar enough."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return rule.den * common >= rule.num * (len(both) - common)


class SetTable:
    """Everything that is asked of the texts, by passes over them."""

    def __init__(self, docs: DataFrame, rule: Rule):
        self.spark, self.rule = docs.sparkSession, rule
        prepare(self.spark)
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def _pass(self, rows: DataFrame, each, schema: str) -> DataFrame:
        rule = self.rule

        def run(batches):
            for part in batches:
                found = shingle_sets(text_or_empty(part["text"]), rule)
                result = each(part, found)
                if len(result):
                    yield result

        return rows.mapInPandas(tidy(run), schema)

    def nodes(self) -> DataFrame:
        """``doc_id, n, node`` of every row."""

        def each(part, found):
            return pd.DataFrame({"doc_id": part["doc_id"], "n": [len(f) for f in found], "node": [node_of(f) for f in found]})

        return self._pass(self.docs, each, "doc_id long, n long, node long")

    def _sample(self) -> DataFrame:
        return self.docs.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SAMPLED)) == 0)

    def _frequent(self, each) -> np.ndarray:
        """Values that ``each`` finds in several sampled documents, in order."""
        counts = self._pass(self._sample(), each, "value long, n long").groupBy("value").agg(F.sum("n").alias("n"))
        top = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "value").limit(MOST_FREQUENT)
        return np.sort(np.array([r["value"] for r in top.collect()], np.int64).view(np.uint64))

    def frequent_shingles(self) -> np.ndarray:
        def each(part, found):
            distinct = {node_of(f): f for f in found}
            values, n = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
            return pd.DataFrame({"value": values.view(np.int64), "n": n})

        return self._frequent(each)

    def keys(self, rows: DataFrame, frequent: np.ndarray, hot: np.ndarray) -> DataFrame:
        """``key, salt, node``: rows of hot keys have a salt by their node."""
        rule = self.rule
        shared = self.spark.sparkContext.broadcast((frequent, hot))

        def each(part, found):
            frequent, hot = shared.value
            distinct = {node_of(f): f for f, i in zip(found, part["doc_id"]) if len(f) and not pd.isna(i)}
            keys = [keys_of(f, rule, frequent) for f in distinct.values()]
            if not keys:
                return pd.DataFrame()
            key = np.concatenate(keys)
            node = np.repeat(np.fromiter(distinct, np.int64, len(distinct)), [len(k) for k in keys])
            salt = np.zeros(len(key), np.int16)
            if len(hot):
                place = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                salt = np.where(hot[place] == key, 1 + node % SALTS, 0).astype(np.int16)
            return pd.DataFrame({"key": key.view(np.int64), "salt": salt, "node": node})

        return self._pass(rows, each, "key long, salt short, node long")

    def hot_keys(self, frequent: np.ndarray) -> np.ndarray:
        rows = self.keys(self._sample(), frequent, np.zeros(0, np.uint64)).groupBy("key").agg(F.count_distinct("node").alias("n"))
        top = rows.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "key").limit(MOST_FREQUENT)
        return np.sort(np.array([r["key"] for r in top.collect()], np.int64).view(np.uint64))

    def members(self, frequent: np.ndarray) -> DataFrame:
        """``key, node``, each pair once, of keys that more than one node has (and of hot keys)."""
        rows = self.keys(self.docs, frequent, self.hot_keys(frequent))
        dealt = rows.repartition(partitions(self.spark), "key", "salt")

        def shared(batches):
            parts = [np.stack([b["key"].to_numpy(), b["node"].to_numpy(), b["salt"].to_numpy(np.int64)]) for b in batches]
            if not parts:
                return
            key, node, salt = np.concatenate(parts, axis=1)
            del parts
            order = np.lexsort((node, key))
            key, node, salt = key[order], node[order], salt[order]
            first = np.ones(len(key), bool)
            first[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
            key, node, salt = key[first], node[first], salt[first]
            several = np.zeros(len(key), bool)
            equal = key[1:] == key[:-1]
            several[1:] |= equal
            several[:-1] |= equal
            kept_rows = several | (salt > 0)
            yield pd.DataFrame({"key": key[kept_rows], "node": node[kept_rows]})

        return dealt.mapInPandas(tidy(shared), "key long, node long")

    def sets(self, speakers: DataFrame) -> DataFrame:
        """``node, n, point, elements`` for nodes, read from the texts of their ``doc_id``."""
        few = speakers.count() <= BROADCAST_IDS
        wanted = F.broadcast(speakers) if few else speakers
        rows = self.docs.join(wanted.withColumnRenamed("node", "expected"), "doc_id")

        def each(part, found):
            same = [i for i, (f, e) in enumerate(zip(found, part["expected"])) if node_of(f) == e]
            return pd.DataFrame(
                {
                    "node": [int(part["expected"].iloc[i]) for i in same],
                    "n": [len(found[i]) for i in same],
                    "point": [point_of(found[i]).tobytes() for i in same],
                    "elements": [found[i].tobytes() for i in same],
                }
            )

        return self._pass(rows, each, "node long, n long, point binary, elements binary").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a, b`` that are links. Sizes and points are compared before whole sets travel."""
    small = sets.select("node", "n", "point")
    a = small.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    b = small.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb"))

    @F.pandas_udf("boolean")
    def possible(na: pd.Series, nb: pd.Series, pa: pd.Series, pb: pd.Series) -> pd.Series:
        if not len(na):
            return pd.Series([], dtype=bool)
        x = np.frombuffer(b"".join(pa), np.uint32).reshape(len(na), POINT_GROUPS)
        y = np.frombuffer(b"".join(pb), np.uint32).reshape(len(na), POINT_GROUPS)
        return pd.Series(np.minimum(x, y).sum(axis=1, dtype=np.int64) >= rule.needed(na.to_numpy() + nb.to_numpy()))

    sized = pairs.join(a, "a").join(b, "b")
    fit = (F.least("na", "nb") * rule.den >= F.greatest("na", "nb") * rule.num) & possible("na", "nb", "pa", "pb")
    left = staged(sized.where(fit).select("a", "b"), "pairs")

    @F.pandas_udf("boolean")
    def similar(ea: pd.Series, eb: pd.Series) -> pd.Series:
        return pd.Series([linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), rule) for x, y in zip(ea, eb)], dtype=bool)

    whole = left.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("ea")), "a")
    whole = whole.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("eb")), "b")
    return staged(whole.where(similar("ea", "eb")).select("a", "b"), "links")


class _Groups:
    """Disjoint sets of numbers."""

    def __init__(self, labels: np.ndarray):
        first: dict = {}
        self.parent = [first.setdefault(label, k) for k, label in enumerate(labels.tolist())]

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of a group (with its ``size``) once for each pair of blocks ``i, j`` that they belong to."""
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK_NODES).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    partner = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least("block", x).alias("i"), F.greatest("block", x).alias("j")))
    return rows.withColumn("cell", F.explode(partner)).select(*[c for c in rows.columns if c != "blocks"], "cell.i", "cell.j")


def _searched(batch: pd.DataFrame, rule: Rule, verify) -> pd.DataFrame:
    """Pairs between labels that join the nodes of a pair of blocks, as few as do.

    A pair must pass the tree's bound, and ``verify`` where it is given; then nodes of one label are joined
    already. Pairs that only pass the bound say nothing of the rest of their labels: every node begins alone,
    so both ends of each such pair come together.
    """
    batch = batch.drop_duplicates("node").reset_index(drop=True)
    points = np.frombuffer(b"".join(batch["point"]), np.uint32).reshape(len(batch), POINT_GROUPS)
    node, label, block = batch["node"].to_numpy(), batch["label"].to_numpy(), batch["block"].to_numpy()
    crossing = batch["i"].iloc[0] != batch["j"].iloc[0]
    tree, groups, found = CountTree(points, rule), _Groups(node if verify is None else label), []
    # The largest component only answers: all its pairs with others are asked by the others.
    names, sizes = np.unique(label, return_counts=True)
    for k in np.flatnonzero(label != names[sizes.argmax()]).tolist():
        at = tree.search(points[k])
        at = at[label[at] != label[k]]
        if crossing:
            at = at[block[at] != block[k]]
        for x in at.tolist():
            if groups.find(k) != groups.find(x) and (verify is None or verify(batch, k, x)):
                groups.join(k, x)
                found.append((min(node[k], node[x]), max(node[k], node[x])))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _clusters(members: DataFrame, labels: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Nodes in different components that share a key and whose points allow links, by connected cluster."""
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    marks = F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("y")
    ends = F.min("label").alias("l"), F.max("label").alias("h")
    keys = labelled.groupBy("key").agg(*ends, *marks, F.count("*").alias("size")).where("l <> h and size > 2")  # of two, the hub saw both
    open_keys = keys.groupBy("size", "x", "y").agg(F.min("key").alias("key"))  # of keys with the same nodes one is enough
    rows = labelled.join(open_keys.select("key", "size"), "key").join(sets.select("node", "point"), "node")

    def searched(batch: pd.DataFrame) -> pd.DataFrame:
        return _searched(batch, rule, None)

    joined = _in_blocks(rows.select("key", "size", "node", "label", "point")).groupBy("key", "i", "j")
    return components(joined.applyInPandas(searched, "a long, b long"))


def _cluster_links(clusters: DataFrame, labels: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Verified links that join the components within each cluster; a set travels once, or once for each block."""
    named = clusters.withColumnRenamed("label", "cluster")
    sized = named.join(named.groupBy("cluster").agg(F.count("*").alias("size")), "cluster")
    rows = sized.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).join(sets, "node")

    def verify(batch: pd.DataFrame, k: int, x: int) -> bool:
        a, b = batch["elements"].iat[k], batch["elements"].iat[x]
        return linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), rule)

    def searched(batch: pd.DataFrame) -> pd.DataFrame:
        return _searched(batch, rule, verify)

    chosen = rows.select("cluster", "size", "node", "label", "point", "elements")
    joined = _in_blocks(chosen).groupBy("cluster", "i", "j")
    return staged(joined.applyInPandas(searched, "a long, b long"), "more")


def linked_documents(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links, the own one included. Documents with
    equal sets are linked; those without words (null and empty texts too) have no set and are linked
    with nothing. Rows with a null id count their n-grams, but link with nothing and have no component. Rows
    repeated under one id are one document: the links of each of its texts are its links, and every row is
    returned. Columns other than ``doc_id`` and ``text`` are not looked at. No rows give no rows.

    N-grams are compared by 64-bit hashes, and equal sets by a 64-bit hash of all of them.
    """
    table = SetTable(docs, rule)
    rows = staged(table.nodes(), "nodes")
    named = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    speakers = staged(named.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "speakers")

    members = staged(table.members(table.frequent_shingles()), "members")
    degree = members.groupBy("node").agg(F.count("*").alias("degree"))
    ranked = members.join(degree, "node")
    hubs = ranked.groupBy("key").agg(F.max_by("node", F.struct("degree", "node")).alias("hub"), F.count("*").alias("size")).where("size > 1")
    starred = members.join(hubs.select("key", "hub"), "key").where(F.col("node") != F.col("hub"))
    stars = staged(starred.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "stars")

    involved = stars.select(F.col("a").alias("node")).union(stars.select(F.col("b").alias("node"))).distinct()
    sets = staged(table.sets(speakers.join(involved, "node")), "sets")
    links = _verified(stars, sets, rule)
    labels = components(links)
    clusters = _clusters(members.join(involved, "node", "left_semi"), labels, sets, rule)
    more = _cluster_links(clusters, labels, sets, rule)

    # Rows of one id are one document, whichever of its texts speaks for a node.
    texts = named.select("doc_id", "node").distinct()
    several = texts.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    same = texts.join(several.select("doc_id", "a"), "doc_id").where(F.col("node") != F.col("a")).select("a", F.col("node").alias("b"))
    labels = components(links.union(more).union(same))

    reached = speakers.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = reached.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    found = reached.join(smallest, "label").select("node", "component_id")
    named_node = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("node"))
    out = rows.withColumn("node", named_node).join(found, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
