"""Whitening against exact sums of Python's own whole numbers and numpy's decomposition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from filingpanel.llm import queries, whitening

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, most):
    """{(id, component): (n, deviation, |whitened|, explained)} of (id, vector) rows with unique ids and one length."""
    x = {i: tuple(math.floor(256 * float(np.float32(c))) for c in v) for i, v in rows}
    fit = sorted(set(x.values()))
    n, d = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(d)]
    centred = [[n * v[k] - sums[k] for k in range(d)] for v in fit]
    cov = np.array([[sum(v[i] * v[j] for v in centred) / n**3 for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    out = {}
    for place in range(min(most, d)):
        e, axis = values[d - 1 - place], vectors[:, d - 1 - place]
        for i, v in x.items():
            gaps = [n * v[k] - sums[k] for k in range(d)]
            whitened = sum(g * a for g, a in zip(gaps, axis)) / n / math.sqrt(e)
            out[i, place + 1] = n, sum(g * g for g in gaps), abs(whitened), e / values.sum()
    return out


def same(found, expected):
    assert {(r["vec_id"], r["component"]) for r in found} == set(expected) and len(found) == len(expected)
    for r in found:
        n, deviation, whitened, explained = expected[r["vec_id"], r["component"]]
        assert (r["n"], int(r["deviation"])) == (n, deviation)
        assert math.isclose(abs(r["whitened"]), whitened, rel_tol=1e-6, abs_tol=1e-8) and math.isclose(r["explained"], explained, rel_tol=1e-9)
        assert r["identity_error"] < 1e-9


def test_bit_planes_give_exact_products():
    rng = np.random.default_rng(3)
    for high, n, d in ((1, 5, 3), (2, 70, 4), (1000, 200, 7), (2**31, 65, 5), (2**64 - 1, 130, 3)):
        rows = rng.integers(0, high, (n, d), np.uint64, endpoint=True)
        plain = rows.astype(object)
        assert (whitening.products_of(rows) == plain.T.dot(plain)).all()


def test_tiles_of_planes_do_not_change_the_products(monkeypatch):
    rows = np.random.default_rng(4).integers(0, 300, (90, 6), np.uint64)
    monkeypatch.setattr(whitening, "TILE_PLANES", 7)
    assert (whitening.products_of(rows) == rows.astype(object).T.dot(rows.astype(object))).all()


def test_whitening_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * [3, 1, 0.5, 2, 0.1, 1]).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # a third of all rows is one vector: it counts once
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(7)).collect()
    same(found, brute(rows, 4))
    for r in found:
        if r["vec_id"] >= 1000:
            assert (r["n"], r["deviation"]) == next((x["n"], x["deviation"]) for x in found if x["vec_id"] == 0)


def test_query_on_its_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    found = queries.QUERIES["op11_whitening"](spark, path)
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["n"] == "bigint"
    found = found.collect()
    same(found, brute(rows, 4))
    assert all(r["deviation"] == r["exact_deviation"] for r in found)


def test_odd_vectors_and_lengths(spark):
    rows = [
        (None, [1.0, 2.0]), (2**60 + 1, [3.0, 2.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]),  # the second dimension never varies
        (8, [float("nan"), 1.0]), (9, [None, 1.0]), (10, None), (11, []), (12, [float("-inf"), 1.0]),
        (20, [5.0]), (21, [-0.0]), (22, [3.0e38]), (30, [4.0, 4.0, 4.0]),
    ]
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("x", "known", "unknown", "dim")})).collect()
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], []).append(r)
    assert set(by) == {None, 2**60 + 1, 7, 20, 21, 22, 30}
    assert [len(by[i]) for i in (None, 2**60 + 1, 7, 20, 30)] == [2, 2, 4, 1, 3]
    first, second = sorted(by[2**60 + 1], key=lambda r: r["component"])
    assert (first["n"], first["deviation"], abs(first["whitened"]), first["explained"]) == (2, 512**2, 1.0, 1.0)
    assert (second["whitened"], second["explained"]) == (None, 0.0)
    assert [(r["n"], r["whitened"], r["explained"]) for r in by[30]] == [(1, None, 0.0)] * 3
    big = 2**63 - 1  # 3e38 is beyond a long
    assert by[22][0]["n"] == 3 and by[22][0]["deviation"] is None or by[22][0]["deviation"] == (3 * big - big - 1280) ** 2
    assert by[20][0]["explained"] == 1.0


def test_sums_beyond_longs_are_exact(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=3) * [1e9, 1e8, 1e7]).tolist()) for i in range(60)]
    same(whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(3)).collect(), brute(rows, 4))


@pytest.mark.parametrize("schema", [VECTORS, VECTORS + ", label int"])
def test_no_rows(spark, schema):
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
