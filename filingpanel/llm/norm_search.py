"""Exact top-k search by inner product, with norm buckets and pruning from local cosine thresholds.

Vectors are grouped by length into buckets. A query starts with a threshold: its k-th best product over
a bounded set of the longest vectors, which is a lower bound of its final k-th best. In a bucket whose
longest vector has length l the threshold becomes a cosine, t = threshold / (|query| l). Above 1 the
bucket is passed over. A high t prunes by coordinate: with a unit query q and a unit vector p whose cosine
is at least t, every coordinate of p lies in q_f t +- sqrt((1 - t^2)(1 - q_f^2)), a range in that
coordinate's sorted list. A low t prunes by length: only vectors of at least threshold / |query| are left.
Survivors are verified by whole products.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from filingpanel.llm.common import prepare
from filingpanel.session import staged

#: Lengths within one bucket differ by less than this factor.
BUCKET_STEP = 1.05

#: Numbers (rows times dimensions) of one bucket's block, and of one block of queries.
BLOCK_NUMBERS = 1 << 20

#: Longest vectors that give the first thresholds: rows, and numbers in all.
SEED_ROWS, SEED_NUMBERS = 4096, 1 << 21

#: Local cosine thresholds from here on prune by coordinate, lower ones by length.
COORDINATE_FROM = 0.35

#: Coordinates whose ranges are looked up; the shortest range gives the candidates.
FOCUS = 4

#: Products beyond this are not exact in doubles and are computed with whole numbers.
EXACT = 2.0**53

LONG_MAX = 2**63 - 1


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in values]) if len(values) else np.zeros((0, 0))


def _products(rows: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Products of whole numbers, exactly; beyond the range of long they stay at its end."""
    if exact:
        return (rows @ query).astype(np.int64)
    whole = [[int(x) for x in r] for r in rows]
    sums = (sum(int(a) * b for a, b in zip(query, r)) for r in whole)
    return np.array([max(-LONG_MAX, min(LONG_MAX, s)) for s in sums], np.int64)


class Bucket:
    """One block of a bucket: vectors by falling length, and their sorted coordinates once needed."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        order = np.lexsort((ids, -lengths))
        self.ids, self.vectors, self.lengths = ids[order], vectors[order], lengths[order]
        self.longest = float(self.lengths[0])
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def list_of(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The unit vectors' coordinate ``f`` in order, and whose it is."""
        if f not in self._lists:
            unit = self.vectors[:, f] / np.maximum(self.lengths, 1e-300)
            order = np.argsort(unit, kind="stable")
            self._lists[f] = unit[order], order
        return self._lists[f]

    def candidates(self, query: np.ndarray, length: float, threshold: float) -> np.ndarray | slice:
        """Places of all vectors whose product with the query can reach the threshold."""
        if threshold <= 0 or length == 0 or self.longest == 0:
            return slice(None) if threshold <= 0 else slice(0)
        t = threshold / (length * self.longest) - 1e-9
        if t > 1:
            return slice(0)
        if t < COORDINATE_FROM:
            return slice(int(np.searchsorted(-self.lengths, -(threshold / length) * (1 - 1e-9), "right")))
        unit = query / length
        found = None
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            spread = np.sqrt(max(0.0, (1 - t * t) * (1 - unit[f] ** 2)))
            values, order = self.list_of(int(f))
            # A cosine above t widens nothing below this range's outer end, and 1 bounds the other one.
            low, high = unit[f] * t - spread, unit[f] * t + spread
            if unit[f] > t:
                high = 1.0
            if unit[f] < -t:
                low = -1.0
            a, b = np.searchsorted(values, low - 1e-9, "left"), np.searchsorted(values, high + 1e-9, "right")
            if found is None or b - a < len(found):
                found = order[a:b]
        return found


def _searched(bucket: Bucket, queries: pd.DataFrame, k: int) -> list[pd.DataFrame]:
    out = []
    matrix = _matrix(queries["vector"])
    lengths = np.sqrt((matrix * matrix).sum(axis=1))
    exact = not len(lengths) or float(lengths.max()) * bucket.longest < EXACT
    for i, (own, threshold) in enumerate(zip(queries["query_id"].to_numpy(), queries["threshold"].to_numpy())):
        chosen = bucket.candidates(matrix[i], float(lengths[i]), float(threshold))
        ids = bucket.ids[chosen]
        if not len(ids):
            continue
        scores = _products(bucket.vectors[chosen], matrix[i], exact)
        other = (ids != own) & (scores >= threshold)
        ids, scores = ids[other], scores[other]
        if len(ids) > 4 * k:  # only what reaches the k-th best is put in order
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            ids, scores = ids[scores >= least], scores[scores >= least]
        best = np.lexsort((ids, -scores))[:k]
        if len(best):
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids[best], "score": scores[best]}))
    return out


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest products of each query, ties to the smaller id.

    Both inputs have ``vec_id`` and ``vector``, an array of whole numbers as doubles. Rows with a null id,
    a null vector, or a null or non-finite component take no part; neither do vectors of another number
    of dimensions than the query's. Rows that share the query's id are its own and no candidates. Rows
    repeated under one id count once each as candidates; as queries their results are joined. Empty
    inputs give no rows. Products beyond a long are returned as its largest value.

    Each task gets one block of one bucket and one block of queries, both of bounded size, whatever
    the number of either; a common vector, or one common length, only makes more blocks.
    """
    prepare(vectors.sparkSession)

    def cleaned(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("long").alias(name), F.col("vector").cast("array<double>").alias("vector"))
        rows = rows.where(F.col(name).isNotNull() & usable(F.col("vector")))
        squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
        return rows.withColumns({"length": F.sqrt(squares), "dim": F.size("vector")})

    rows = staged(cleaned(vectors, "vec_id"), "vectors")
    asked = staged(cleaned(queries, "query_id"), "queries")

    # The longest vectors give each query a first threshold.
    widest = rows.agg(F.max("dim")).first()[0] or 1
    seed_rows = max(k + 1, min(SEED_ROWS, SEED_NUMBERS // max(1, widest)))
    longest = rows.orderBy(F.desc("length"), "vec_id").limit(seed_rows).collect()
    by_dim: dict[int, list] = {}
    for r in longest:
        by_dim.setdefault(r["dim"], []).append(r)
    seeds = {d: Bucket(np.array([r["vec_id"] for r in rs]), np.array([r["vector"] for r in rs], np.float64).reshape(len(rs), d)) for d, rs in by_dim.items()}
    shared = vectors.sparkSession.sparkContext.broadcast(seeds)

    def started(batches):
        for part in batches:
            thresholds = []
            for own, vector in zip(part["query_id"], part["vector"]):
                bucket, query = shared.value.get(len(vector)), np.asarray(vector, np.float64)
                threshold = -np.inf
                if bucket is not None:
                    exact = float(np.sqrt((query * query).sum())) * bucket.longest < EXACT
                    scores = _products(bucket.vectors, query, exact)[bucket.ids != own]
                    if len(scores) >= k:
                        threshold = float(np.partition(scores, len(scores) - k)[len(scores) - k])
                        threshold -= abs(threshold) * 1e-15 * (not exact)
                thresholds.append(threshold)
            yield part.assign(threshold=thresholds)

    asked = staged(asked.mapInPandas(started, "query_id long, vector array<double>, length double, dim int, threshold double"), "thresholds")

    # Buckets by length, cut into blocks of bounded size; queries likewise.
    band = F.when(F.col("length") > 0, F.floor(F.log("length") / float(np.log(BUCKET_STEP)))).otherwise(F.lit(-(2**40)))
    rows = rows.withColumn("band", band)
    per_block = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_NUMBERS) / F.greatest(F.lit(1), F.col("dim"))))
    bands = rows.groupBy("dim", "band").agg(F.count("*").alias("n"), F.max("length").alias("top"))
    bands = staged(bands.withColumn("blocks", F.ceil(F.col("n") / per_block).cast("int")), "bands")
    parts = asked.groupBy("dim").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / per_block).cast("int"))
    asked = asked.join(parts.select("dim", "parts"), "dim").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))

    # A block of queries meets a bucket only if one of them can reach its threshold there.
    need = F.when(F.col("threshold") <= 0, F.lit(0.0)).when(F.col("length") == 0, F.lit(float("inf")))
    need = need.otherwise(F.col("threshold") / F.col("length") * (1 - 1e-9))
    needs = staged(asked.groupBy("dim", "part").agg(F.min(need).alias("need")), "needs")
    met = needs.join(bands.select("dim", "band", "top", "blocks"), "dim").where(F.col("top") >= F.col("need"))
    meets = staged(met.select("dim", "band", "part", "blocks", F.col("need").alias("least")), "meets")
    blocks = bands.select("dim", "band", "blocks")
    placed = rows.join(blocks, ["dim", "band"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    left = placed.join(meets.select("dim", "band", "part", "least"), ["dim", "band"]).where(F.col("length") >= F.col("least"))
    left = left.select("dim", "band", "block", "part", "vec_id", "vector")
    right = asked.join(meets.drop("least"), ["dim", "part"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = right.select("dim", "band", "block", "part", "query_id", "vector", "threshold")
    keys = ["dim", "band", "block", "part"]

    def searched(key, own: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(asking):
            bucket = Bucket(own["vec_id"].to_numpy(), _matrix(own["vector"]).reshape(len(own), -1))
            found = _searched(bucket, asking, k)
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(searched, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
