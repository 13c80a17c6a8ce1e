"""Whitening against exact sums and numpy's eigenvectors."""

import math

import numpy as np

from tracewarden.llm import jacobi_whitening as jw

SCHEMA = "vec_id long, embedding array<float>, label int, x string, width int, component int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in vectors], SCHEMA)


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    base = (rng.normal(size=(300, 20)) * np.linspace(3, 0.2, 20) + 5).astype(np.float32)
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    # a hot copy, repeated rows, a null id and rows to drop
    vectors += [(1000 + i, vectors[7][1]) for i in range(150)] + [vectors[3], (None, vectors[4][1])]
    bad = [(2000, None), (2001, [math.nan] * 20), (2002, [1.0] * 19 + [math.inf]), (2003, [None] + [1.0] * 19), (2004, []), (2005, [1.0] * 7),
           (2006, [3e38] * 20)]
    got = jw.whiten(table(spark, vectors + bad)).collect()
    assert len(got) == 16 * len(vectors)
    x = np.floor(64 * base.astype(float)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, sums = len(u), u.sum(0)
    z = u - sums / n
    values, parts = np.linalg.eigh(z.T @ z / n)
    values, parts = values[::-1], parts[:, ::-1]
    want = np.abs((x - sums / n) @ parts[:, :16] / np.sqrt(values[:16]))
    for r in got:
        i = {None: 4}.get(r["vec_id"], 7 if r["vec_id"] and r["vec_id"] >= 1000 else r["vec_id"])
        assert r["n"] == n and r["deviation"] == int(((n * x[i] - sums) ** 2).sum())
        assert abs(abs(r["whitened"]) - want[i, r["component"] - 1]) < 1e-9
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-12 and r["identity_error"] < 1e-10


def test_rank_one_and_constant_and_empty(spark):
    line = jw.whiten(table(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 5
    assert abs(sum(r["whitened"] ** 2 for r in line) / 5 - 1) < 1e-12 and abs(line[0]["explained"] - 1) < 1e-12
    assert jw.whiten(table(spark, [(i, [1.0, 2.0]) for i in range(3)])).collect() == []
    assert jw.whiten(table(spark, [])).collect() == []
    assert jw.whiten(table(spark, [(1, None), (2, [])])).collect() == []


def test_large_numbers_stay_exact(spark):
    rows = [(1, [1e15, 0.5]), (2, [-1e15, 0.25]), (3, [3e10, 1.0])]
    got = {r["vec_id"]: r for r in jw.whiten(table(spark, rows)).where("component = 1").collect()}
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], object)
    sums = x.sum(axis=0)
    for i, row in zip((1, 2, 3), x):
        exact = int(((3 * row - sums) ** 2).sum())
        assert got[i]["deviation"] == (exact if exact < 2 ** 63 else None)


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    for d, rank in ((1, 1), (7, 3), (40, 40), (33, 20)):
        b = rng.normal(size=(d, rank)) * 10.0 ** -np.arange(rank).clip(0, 6)
        a = b @ b.T
        factor = jw.pivoted_cholesky(a)
        assert factor.shape[1] <= rank + 1 and np.allclose(factor @ factor.T, a, atol=1e-10 * np.abs(a).max())
        values, vectors = jw.one_sided_jacobi(factor)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
        assert np.allclose((vectors * values) @ vectors.T, a, atol=1e-10 * np.abs(a).max()) and (np.diff(values) <= 0).all()


def test_exact_products():
    y = np.array([[3, -(2 ** 40)], [2 ** 52, 5]], np.int64)
    big = y.astype(object)
    assert (jw.exact_products(y) == big.T @ big).all()
    small = np.arange(-500, 500).reshape(100, 10)
    assert (jw.exact_products(small) == small.T @ small).all()
