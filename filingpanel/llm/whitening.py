"""Embedding whitening with exact covariances from bit-sliced scatter.

Vectors of whole numbers are shifted to start at 0 in every dimension, and each bit of each dimension is
packed across rows into words: one plane a bit. The AND of two planes has as many ones as there are rows
with both bits, so cross-products are sums of counts, weighted by powers of two. They are whole numbers,
and they are centred as whole numbers (n times the sum of products less the product of sums), so nothing
is lost before the eigenvalues are taken.
"""

from __future__ import annotations

from collections import defaultdict
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingpanel.llm.common import prepare
from filingpanel.session import staged

#: Rows whose planes are made at once, and planes that are compared with each other at once.
BLOCK_ROWS, TILE_PLANES = 1 << 14, 512

#: Sums leave a task in limbs of so many bits, so that longs can add up those of 2^22 tasks.
LIMB = 40

#: Eigenvalues below this share of the trace, for each dimension, are noise of the decomposition.
NOISE = 1e-15

LONG_MAX = 2**63 - 1

#: Rows of ``i, j``: a sum of products, a sum (``j`` = -1), or the number of rows (both -1).
_PARTS = "dim int, i int, j int, limb int, value long"


def planes_of(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of unsigned numbers (rows by dimensions) as 64-bit words; whose they are, and which bit."""
    n, d = shifted.shape
    bits = [int(m).bit_length() for m in shifted.max(axis=0)]
    owner = np.repeat(np.arange(d), bits)
    place = np.concatenate([np.arange(b) for b in bits] + [np.zeros(0, np.int64)]).astype(np.int64)
    words = np.zeros((len(owner), (n + 63) // 64 * 8), np.uint8)
    for k in range(len(owner)):
        bit = (shifted[:, owner[k]] >> np.uint64(place[k])) & np.uint64(1)
        packed = np.packbits(bit.astype(np.uint8))
        words[k, : len(packed)] = packed
    return words.view(np.uint64), owner, place


def products_of(shifted: np.ndarray) -> np.ndarray:
    """Exact sums of products of every two columns of unsigned numbers, as int64 or, where too large, objects."""
    n, d = shifted.shape
    planes, owner, place = planes_of(shifted)
    widest = 0 if not len(place) else int(place.max()) + 1
    small = 2 * widest + n.bit_length() + 2 * max(1, widest).bit_length() < 63
    kind = np.int64 if small else object
    weight = np.array([1 << int(p) for p in place], kind)
    found = np.zeros((d, d), kind)
    for a in range(0, len(owner), TILE_PLANES):
        for b in range(a, len(owner), TILE_PLANES):
            left, right = planes[a : a + TILE_PLANES], planes[b : b + TILE_PLANES]
            ones = np.zeros((len(left), len(right)), np.int64)
            for k in range(len(left)):
                low = k if a == b else 0
                ones[k, low:] = np.bitwise_count(left[k] & right[low:]).sum(axis=1, dtype=np.int64)
            if a == b:
                ones = ones + np.triu(ones, 1).T
            weighted = ones.astype(kind) * weight[a : a + TILE_PLANES, None] * weight[b : b + TILE_PLANES]
            rows, row_at = np.unique(owner[a : a + TILE_PLANES], return_index=True)
            columns, column_at = np.unique(owner[b : b + TILE_PLANES], return_index=True)
            part = np.add.reduceat(np.add.reduceat(weighted, row_at, axis=0), column_at, axis=1)
            found[np.ix_(rows, columns)] += part
            if a != b:
                found[np.ix_(columns, rows)] += part.T
    return found


class Scatter:
    """Exact number, sums and sums of products of vectors of one length, added up block by block."""

    def __init__(self, dim: int):
        self.n = 0
        self.sums = np.zeros(dim, np.int64)
        self.products = np.zeros((dim, dim), np.int64)
        self.bound = 0  # no sum so far is larger

    def add(self, rows: np.ndarray) -> None:
        least = rows.min(axis=0)
        shifted = rows.astype(np.uint64) - least.astype(np.uint64)  # modulo 2^64, which the difference fits
        products = products_of(shifted)
        largest = max(abs(int(rows.min())), abs(int(rows.max())), 1)
        self.bound += 4 * len(rows) * largest * largest
        if self.bound > LONG_MAX and self.products.dtype != object:
            self.sums, self.products = self.sums.astype(object), self.products.astype(object)
        kind = self.products.dtype
        low = least.astype(kind)
        sums = shifted.astype(kind).sum(axis=0) if kind != object else np.array([sum(map(int, c)) for c in shifted.T], object)
        self.n += len(rows)
        self.sums = self.sums + sums + len(rows) * low
        cross = np.multiply.outer(low, sums)
        self.products = self.products + products.astype(kind) + cross + cross.T + len(rows) * np.multiply.outer(low, low)

    def limbs(self, dim: int) -> pd.DataFrame:
        """All numbers as rows of ``_PARTS``; limbs have the sign of the whole."""
        i, j = np.triu_indices(dim)
        keys = np.concatenate([np.stack([i, j]), np.stack([np.arange(dim), np.full(dim, -1)]), [[-1], [-1]]], axis=1)
        left = np.concatenate([self.products[i, j], self.sums, np.array([self.n], self.sums.dtype)])
        out, limb = [], 0
        while True:
            size = np.abs(left)
            part = np.sign(left) * (size & ((1 << LIMB) - 1)) if left.dtype != object else np.array([(1 if v > 0 else -1) * (abs(v) & ((1 << LIMB) - 1)) for v in left], object)
            chosen = part != 0
            out.append(pd.DataFrame({"dim": dim, "i": keys[0][chosen], "j": keys[1][chosen], "limb": limb, "value": part[chosen].astype(np.int64)}))
            left = np.sign(left) * (size >> LIMB) if left.dtype != object else np.array([(1 if v > 0 else -1) * (abs(v) >> LIMB) for v in left], object)
            limb += 1
            if not any(left):
                return pd.concat(out, ignore_index=True)


class Components:
    """Number, sums, and the leading components of vectors of one length."""

    def __init__(self, dim: int, n: int, sums: list[int], products: dict[tuple[int, int], int], most: int):
        self.n, self.sums = n, sums
        centred = np.zeros((dim, dim))
        for i in range(dim):
            for j in range(i, dim):
                centred[i, j] = centred[j, i] = (n * products.get((i, j), 0) - sums[i] * sums[j]) / (n * n)
        values, vectors = np.linalg.eigh(centred)
        order = np.argsort(-values, kind="stable")[:most]
        self.trace = float(np.trace(centred))
        self.values = values[order]
        self.vectors = vectors[:, order].T
        for v in self.vectors:  # one sign, whatever the decomposition gave
            if v[np.argmax(np.abs(v))] < 0:
                v *= -1
        self.live = self.values > NOISE * dim * max(self.trace, 0.0)
        self.mean = np.array([s / n for s in sums])

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        """Rows by components; not a number where a component has no variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            found = ((rows.astype(np.float64) - self.mean) @ self.vectors.T) / np.sqrt(self.values)
        found[:, ~self.live] = np.nan
        return found

    def deviations(self, rows: np.ndarray) -> list[int]:
        """Exact sums over dimensions of (n x - S)^2."""
        largest = max(int(rows.max(initial=0)), -int(rows.min(initial=0)))
        widest = self.n * largest + max(map(abs, self.sums), default=0)
        kind = np.int64 if widest * widest * max(1, rows.shape[1]) <= LONG_MAX else object
        gaps = self.n * rows.astype(kind) - np.array(self.sums, kind)
        return (gaps * gaps).sum(axis=1).tolist()

    def explained(self) -> np.ndarray:
        return np.where(self.live, self.values, 0.0) / self.trace if self.trace > 0 else np.zeros(len(self.values))


def whole_vectors(df: DataFrame, vector: str, scale: int = 256) -> DataFrame:
    """Rows whose ``vector`` is neither null nor has a null or non-finite entry, as ``vec_id, x``.

    ``x`` is ``floor(scale * entry)`` with the entry as double, an array of longs (beyond a long: the nearest one).
    """
    entry = F.col(vector)
    usable = entry.isNotNull() & F.coalesce(F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    x = F.transform(entry, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(0))
    return df.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<long>").alias("x"))


def _by_dimension(batch: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors of a batch as matrices, by their length, and the places of their rows."""
    places = defaultdict(list)
    for at, v in enumerate(batch["x"]):
        places[len(v)].append(at)
    column = batch["x"].to_numpy()
    return {d: (np.array(at), np.stack(column[at]).astype(np.int64)) for d, at in places.items() if d}


def learn(fit: DataFrame, most: int = 4) -> dict[int, Components]:
    """The components of the vectors ``x`` of ``fit``, by vector length (vectors without dimensions take no part).

    Each task adds up its blocks; what reaches the driver is one row for each two dimensions, whatever
    the number of vectors.
    """
    prepare(fit.sparkSession)

    def scattered(batches):
        held: dict[int, list[np.ndarray]] = defaultdict(list)
        totals: dict[int, Scatter] = {}

        def add(d: int) -> None:
            totals.setdefault(d, Scatter(d)).add(np.concatenate(held.pop(d)))

        for batch in batches:
            for d, (_, rows) in _by_dimension(batch).items():
                for k in range(0, len(rows), BLOCK_ROWS):
                    held[d].append(rows[k : k + BLOCK_ROWS])
                    if sum(map(len, held[d])) >= BLOCK_ROWS:
                        add(d)
        for d in list(held):
            add(d)
        for d, total in totals.items():
            yield total.limbs(d)

    parts = fit.select("x").mapInPandas(scattered, _PARTS)
    rows = parts.groupBy("dim", "i", "j", "limb").agg(F.sum("value").alias("value")).collect()
    found: dict[int, dict[tuple[int, int], int]] = defaultdict(lambda: defaultdict(int))
    for r in rows:
        found[r["dim"]][r["i"], r["j"]] += r["value"] << (LIMB * r["limb"]) if r["value"] >= 0 else -(-r["value"] << (LIMB * r["limb"]))
    return {d: Components(d, v[-1, -1], [v[i, -1] for i in range(d)], v, most) for d, v in found.items()}


def identity_errors(fit: DataFrame, models: dict[int, Components]) -> dict[int, float]:
    """By vector length: how far the covariance of the whitened vectors of ``fit`` is from the identity, at most.

    Tasks give number, means and centred products of their own rows; one more sum over the tasks, with the
    distance of their means from the common one, makes them the covariance.
    """
    spark = fit.sparkSession
    shared = spark.sparkContext.broadcast(models)

    def gathered(batches):
        totals = {}
        for batch in batches:
            for d, (_, rows) in _by_dimension(batch).items():
                w = np.nan_to_num(shared.value[d].whitened(rows))
                n, mean = len(w), w.mean(axis=0)
                centred = (w - mean).T @ (w - mean)
                if d in totals:
                    m, old, products = totals[d]
                    gap = mean - old
                    products = products + centred + np.outer(gap, gap) * (n * m / (n + m))
                    totals[d] = n + m, old + gap * (n / (n + m)), products
                else:
                    totals[d] = n, mean, centred
        for d, (n, mean, products) in totals.items():
            i, j = np.triu_indices(len(mean))
            yield pd.DataFrame({"dim": d, "i": i, "j": j, "n": n, "a": mean[i], "b": mean[j], "products": products[i, j]})

    parts = staged(fit.select("x").mapInPandas(gathered, "dim int, i int, j int, n long, a double, b double, products double"), "gathered")
    total = F.sum("n")
    means = parts.groupBy("dim", "i", "j").agg(total.alias("rows"), (F.sum(F.col("n") * F.col("a")) / total).alias("ma"), (F.sum(F.col("n") * F.col("b")) / total).alias("mb"))
    moved = F.col("products") + F.col("n") * (F.col("a") - F.col("ma")) * (F.col("b") - F.col("mb"))
    found = parts.join(means, ["dim", "i", "j"]).groupBy("dim", "i", "j").agg((F.sum(moved) / F.first("rows")).alias("covariance")).collect()
    errors = {d: 0.0 for d in models}
    for r in found:
        live = models[r["dim"]].live
        if live[r["i"]] and live[r["j"]]:
            errors[r["dim"]] = max(errors[r["dim"]], abs(r["covariance"] - (r["i"] == r["j"])))
    shared.destroy()
    return errors


def whiten(df: DataFrame, vector: str = "embedding", most: int = 4) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: each vector on the leading components.

    Vectors that are null or have null or non-finite entries take no part. The fit list has every vector of whole
    numbers once, however often it occurs; ``n`` is its length. ``deviation`` is exact (a decimal of 38 digits, null
    beyond them). Components are numbered from 1 by falling variance; a vector has as many as it has dimensions,
    up to ``most``. Where a component has no variance ``whitened`` is null and ``explained`` 0, and the identity error
    leaves it out. Vectors of different lengths are populations of their own; vectors without dimensions give no
    rows. Repeated rows and ids give rows each, null ids stay, empty tables give no rows, and other columns are not
    looked at. The driver and every task hold numbers by pairs of dimensions, never by vectors.
    """
    spark = df.sparkSession
    prepare(spark)
    rows = whole_vectors(df, vector).where(F.size("x") > 0)
    fit = staged(rows.select("x").distinct(), "fit")
    models = learn(fit, most)
    errors = identity_errors(fit, models) if models else {}
    shared = spark.sparkContext.broadcast(models)
    known = F.coalesce("vec_id", F.lit(0)).alias("known")  # a column with nulls would travel as doubles

    def projected(batches):
        for batch in batches:
            for d, (places, x) in _by_dimension(batch).items():
                model = shared.value[d]
                k = len(model.values)
                deviations = [Decimal(v) if v < 10**38 else None for v in model.deviations(x)]
                yield pd.DataFrame(
                    {
                        "known": np.repeat(batch["known"].to_numpy()[places], k),
                        "unknown": np.repeat(batch["unknown"].to_numpy()[places], k),
                        "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                        "n": model.n,
                        "deviation": np.repeat(np.array(deviations, object), k),
                        "whitened": model.whitened(x).reshape(-1),
                        "explained": np.tile(model.explained(), len(x)),
                        "identity_error": errors[d],
                    }
                )

    schema = "known long, unknown boolean, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    found = rows.select(known, F.col("vec_id").isNull().alias("unknown"), "x").mapInPandas(projected, schema)
    found = found.withColumns({"vec_id": F.when(~F.col("unknown"), F.col("known")), "whitened": F.when(~F.isnan("whitened"), F.col("whitened"))})
    return found.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
