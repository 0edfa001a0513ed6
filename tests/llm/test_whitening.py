from fractions import Fraction

import numpy as np
import pytest

from pagelode.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n long, vector string, whitened double"


def whole(vector):
    return [int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in vector]


def brute(rows):
    """n, deviations by row, and V, in exact arithmetic."""
    x = [(i, whole(v)) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    n, dims = len(x), len(x[0][1])
    sums = [sum(r[k] for _, r in x) for k in range(dims)]
    deviations = sorted((i, sum((n * a - s) ** 2 for a, s in zip(r, sums))) for i, r in x)
    off = np.array([[n * a - s for a, s in zip(r, sums)] for _, r in x], object)
    return n, deviations, np.array([[float(Fraction(int(v), n**3)) for v in row] for row in off.T @ off]), off


def check(rows, vectors, most=8):
    n, deviations, v, off = brute(vectors)
    values, components = np.linalg.eigh(v)
    values, components = values[::-1][:most], components[:, ::-1][:, :most]
    found = {}
    for r in rows:
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        found.setdefault(r.component, []).append((r.vec_id, r.deviation, r.whitened))
    assert sorted(found) == list(range(1, len(values) + 1))
    for k, got in found.items():
        assert sorted((i, d) for i, d, _ in got) == deviations
        wanted = off.astype(float) / n @ components[:, k - 1] / np.sqrt(values[k - 1])
        order = sorted(range(n), key=lambda a: (got[a][0], got[a][1]))
        white = np.array([got[a][2] for a in order])
        by_id = np.array([w for *_, w in sorted(zip([i for i, x in vectors if usable(x)], [d for d in brute_by_row(off)], wanted))])
        assert np.abs(white - by_id).max() < 1e-6 or np.abs(white + by_id).max() < 1e-6


def usable(vector):
    return vector is not None and all(c is not None and np.isfinite(c) for c in vector)


def brute_by_row(off):
    return [int((r * r).sum()) for r in off]


def test_embeddings(spark, sf_dir):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(whitening.op12(spark, sf_dir).collect(), vectors)


def test_hard_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, (rng.normal(size=3) * [5, 1, .1]).tolist()) for i in range(40)]
    good += [good[7], (7, [9.0, 9.0, 9.0]), (None, [1.0, 2.0, 3.0])]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [1.0, float("nan"), 2.0]), (53, [float("inf"), 0.0, 0.0]), (54, []), (55, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 1, 2, 3, "x", 4.0) for i, v in good + bad], SCHEMA)
    rows = whitening.whiten(frame).collect()
    assert {r.component for r in rows} == {1, 2, 3} and len(rows) == 3 * len(good)
    n, deviations, v, _ = brute([(-1 if i is None else i, x) for i, x in good])
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.deviation) for r in rows if r.component == 1) == deviations
    assert all(r.n == n and r.identity_error < 1e-9 for r in rows)
    assert whitening.whiten(frame.where("false")).count() == 0
    assert whitening.whiten(frame.where("vec_id = 9")).count() == 0
    assert whitening.whiten(frame.where("vec_id in (50, 51, 54)")).count() == 0
    assert [f.name for f in whitening.whiten(frame.where("false")).schema] == [f.name for f in whitening.whiten(frame).schema]


def test_low_rank_and_huge_entries(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 2))
    flat = [(i, [a, b, a, 0.0, 5.0]) for i, (a, b) in enumerate(np.round(base * 512).tolist())]
    frame = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in flat], "vec_id long, embedding array<float>")
    rows = whitening.whiten(frame).collect()
    assert {r.component for r in rows} == {1, 2} and all(r.identity_error < 1e-9 for r in rows)
    huge = spark.createDataFrame([(i, [3e38 * (i % 2), float(i), -3e38]) for i in range(20)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(huge).collect()
    assert {r.component for r in rows} == {1, 2} and all(np.isfinite(r.whitened) for r in rows)


def test_exact_products():
    rng = np.random.default_rng(1)
    for largest in (100, 10**6, 2**31, 2**50):
        y = rng.integers(-largest, largest, (300, 4))
        wanted = y.astype(object).T @ y.astype(object)
        assert (whitening.products(y) == wanted).all()


def test_factor_and_rotations_keep_small_eigenvalues():
    """Scales over twelve orders of magnitude, rotated inside blocks: relative accuracy of every eigenvalue."""
    rng = np.random.default_rng(2)
    m = rng.normal(size=(400, 7))
    scale = 10.0 ** -np.arange(0, 14, 2)
    a = (m * scale).T @ (m * scale)
    factor, order = whitening.pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a[np.ix_(order, order)], rtol=1e-12, atol=0)
    values, components = whitening.principal(a, 7)
    # The same eigenvalues from singular values of the scaled rows, graded columns largest first.
    exact = [np.linalg.svd((m * scale), compute_uv=False)[k] ** 2 for k in range(4)]
    assert np.allclose(values[:4], exact, rtol=1e-8)
    assert np.abs(components @ components.T - np.eye(7)).max() < 1e-12
    for e, c in zip(values, components):
        assert np.abs(a @ c - e * c).max() <= 1e-13 * values[0]
