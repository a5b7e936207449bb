"""Whitening against a dense eigendecomposition, exact deviations, odd vectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from areastats.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, component string, n string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "c", "n") for i, v in rows], SCHEMA)


def compared(rows, vectors):
    """Hold rows (of one vector length) against numpy and exact fractions."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors.values()])
    n, d = x.shape
    total = x.sum(axis=0)
    z = np.array([[float(Fraction(int(n * a - s), n)) for a, s in zip(r, total, strict=True)] for r in x])
    v = z.T @ z / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(32, d)
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == n * k
    place = {vec_id: i for i, vec_id in enumerate(vectors)}
    white = np.array([[got[vec_id, c + 1].whitened for c in range(k)] for vec_id in place])
    want = z @ axes[:, :k] / np.sqrt(values[:k])
    assert np.allclose(np.abs(white), np.abs(want), atol=1e-7)
    for c in range(k):
        signs = np.sign(white[:, c] * want[:, c])[np.abs(want[:, c]) > 1e-6]
        assert len(set(signs)) == 1
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-9
    for r in rows:
        i = place[r.vec_id]
        assert r.n == n
        assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], total, strict=True))
        assert r.explained == pytest.approx(values[r.component - 1] / v.trace(), rel=1e-9)
        assert r.identity_error < 1e-9


def test_query_against_numpy(spark):
    vectors = {r[0]: r[1] for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()}
    compared(queries.QUERIES["op11_whitening"](spark, SF_DIR).collect(), vectors)


def test_odd_vectors_and_lengths(spark):
    rng = np.random.default_rng(3)
    wide = {i: rng.normal(size=40).tolist() for i in range(200)}
    narrow = {1000 + i: rng.normal(size=3).tolist() for i in range(50)}
    bad = [(2000, None), (2001, []), (2002, [1.0, None, 2.0]), (2003, [float("nan")] * 3), (2004, [float("inf"), 0.0, 0.0])]
    found = whitening.whitened(table(spark, [*wide.items(), *narrow.items(), *bad])).collect()
    compared([r for r in found if r.vec_id < 1000], wide)
    compared([r for r in found if r.vec_id >= 1000], narrow)


def test_no_variance(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])]
    found = whitening.whitened(table(spark, rows)).collect()
    assert len(found) == 6
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {(3, 0, None, 0.0, None)}
    assert whitening.whitened(table(spark, rows).limit(0)).collect() == []


def test_rank_below_dimension(spark):
    found = whitening.whitened(table(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(8)])).collect()
    by = {c: [r for r in found if r.component == c] for c in (1, 2, 3)}
    assert all(r.explained == pytest.approx(1) and r.identity_error < 1e-12 for r in by[1])
    assert all(r.whitened is None and r.explained == 0 for c in (2, 3) for r in by[c])


def test_huge_entries(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 0.1]), (3, [0.0, 0.2]), (4, [5.0, 1e17])]
    found = whitening.whitened(table(spark, rows)).collect()
    assert len(found) == 8 and {r.deviation for r in found} == {None}


@pytest.mark.parametrize("shape", [(200, 64), (10, 30), (300, 5), (50, 1)])
def test_factor_and_rotation(shape):
    rng = np.random.default_rng(1)
    a = rng.normal(size=shape) * 10.0 ** rng.integers(-3, 3, size=shape[1])
    v = a.T @ a
    g = whitening.pivoted_cholesky(v)
    assert np.allclose(g @ g.T, v, rtol=1e-10, atol=1e-10 * v.max())
    order = np.argsort((g != 0).sum(axis=1), kind="stable")
    assert np.allclose(np.triu(g[order][: g.shape[1]], 1), 0)
    values, axes = whitening.one_sided_jacobi(g)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][: len(values)], rtol=1e-6, atol=1e-12 * v.max())
    assert np.allclose(axes.T @ axes, np.eye(len(values)), atol=1e-12)
    assert (np.diff(values) <= 0).all()


@pytest.mark.parametrize("n", range(2, 12))
def test_rounds_hold_every_pair_once(n):
    pairs = [tuple(p) for r in whitening.rounds(n) for p in r.tolist()]
    assert sorted(pairs) == [(a, b) for a in range(n) for b in range(a + 1, n)]
    assert all(len(set(r.ravel().tolist())) == r.size for r in whitening.rounds(n))
