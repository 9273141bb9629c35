"""op12: Jacobi-Davidson whitening against a dense eigendecomposition of the same covariance."""

import math

import numpy as np
import pytest

from marquee.llm import whitening as Wh

SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string, whitened int"


def dense(rows):
    """Eigenpairs and quantised vectors by numpy, the contract read literally."""
    xs = {}
    for i, v, *_ in rows:
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        xs[i] = np.floor(64 * np.array(v, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    d = max(len(x) for x in xs.values())
    xs = {i: x for i, x in xs.items() if len(x) == d}
    fit = np.unique(np.array(list(xs.values())), axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    return xs, n, s, e[::-1], u[:, ::-1]


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((120, 20)) * np.linspace(0.5, 0.02, 20)
    rows = [(i, [float(c) for c in v], 1, "x", "y", 7) for i, v in enumerate(base)]
    rows += [(500 + i, rows[i][1], 0, "x", "y", 7) for i in range(30)]        # repeated vectors
    rows += [(900, None, 0, "x", "y", 7), (901, [0.1] * 19 + [None], 0, "x", "y", 7), (902, [float("nan")] * 20, 0, "x", "y", 7),
             (903, [float("inf")] + [0.0] * 19, 0, "x", "y", 7), (904, [0.1] * 5, 0, "x", "y", 7), (None, rows[3][1], 0, "x", "y", 7)]
    return rows


def test_whitening_equals_dense(spark, table):
    out = Wh.whiten(spark.createDataFrame(table, SCHEMA)).toPandas()
    xs, n, s, e, u = dense([r for r in table if r[0] is not None] + [(-1, table[3][1])])
    assert set(out.vec_id.dropna()) == set(xs) - {-1} and out.vec_id.isna().sum() == 16
    assert (out.n == n).all() and sorted(out.component.unique()) == list(range(1, 17))
    explained = out.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, e[:16] / e.sum(), rtol=1e-9)
    assert out.identity_error.iloc[0] < 1e-9
    for i, x in list(xs.items())[:40]:
        if i == -1:
            continue
        got = out[out.vec_id == i].sort_values("component")
        want = (x - s / n) @ u[:, :16] / np.sqrt(e[:16])
        signs = np.sign(out[out.vec_id == 0].sort_values("component").whitened.to_numpy()) * np.sign(((xs[0] - s / n) @ u[:, :16]))
        assert np.allclose(got.whitened.to_numpy(), want * signs, atol=1e-8)
        assert got.deviation.iloc[0] == int(((n * x - s) ** 2).sum())


def test_whitening_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert Wh.whiten(empty).count() == 0
    one = spark.createDataFrame([(1, [0.5, 0.25], 0, "a", "b", 1), (2, [0.5, 0.25], 0, "a", "b", 1), (3, None, 0, "a", "b", 1)], SCHEMA)
    assert Wh.whiten(one).count() == 0          # one distinct vector: every eigenvalue is zero
    flat = spark.createDataFrame([(1, [], 0, "a", "b", 1)], SCHEMA)
    assert Wh.whiten(flat).count() == 0
    two = spark.createDataFrame([(1, [0.0, 0.0, 0.0], 0, "a", "b", 1), (2, [1.0, 0.0, 0.0], 0, "a", "b", 1)], SCHEMA)
    rows = Wh.whiten(two).collect()
    assert len(rows) == 2 and {r.component for r in rows} == {1} and all(abs(abs(r.whitened) - 1) < 1e-12 for r in rows)


def test_jacobi_davidson_alone():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((40, 40))
    m = a @ a.T
    values, vectors = Wh.jacobi_davidson(lambda w: m @ w, 40, 16)
    e, u = np.linalg.eigh(m)
    assert np.allclose(values, e[::-1][:16], rtol=1e-12)
    assert np.abs(m @ vectors - vectors * values).max() < 1e-11 * e[-1]
