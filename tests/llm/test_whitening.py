import math
from fractions import Fraction

import numpy as np
import pytest

from forgeline.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, v int, i int, j int, w int, n int, deviation int, component int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, *[7] * 7) for i, v in rows], SCHEMA)


def vectors(n=400, d=12, seed=3):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 5
    return [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(mixed)]


def exact(rows):
    """(n, sums, covariance as fractions, x) in plain Python."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    y = [[n * r[j] - sums[j] for j in range(d)] for r in x]
    cov = [[Fraction(sum(r[i] * r[j] for r in y), n**3) for j in range(d)] for i in range(d)]
    return n, sums, cov, y


def test_contract(spark):
    rows = vectors()
    bad = [(900, None), (901, []), (902, [float("nan")] * 12), (903, [1.0] * 11 + [float("inf")]), (904, [None] + [1.0] * 11), (905, [1.0] * 5)]
    rows.append((None, rows[0][1]))
    rows.append(rows[1])
    got = W.whiten(table(spark, rows + bad)).collect()
    n, sums, cov, y = exact(rows)
    assert len(got) == 8 * len(rows) and {r.n for r in got} == {n}
    values, axes = np.linalg.eigh(np.array([[float(c) for c in r] for r in cov]))
    values, axes = values[::-1], axes[:, ::-1]
    trace = sum(cov[i][i] for i in range(12))
    want = np.array([[v / n for v in r] for r in y]) @ axes[:, :8] / np.sqrt(values[:8])
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
        assert r.identity_error < 1e-9 and abs(r.explained - values[r.component - 1] / float(trace)) < 1e-12
    for k in range(8):
        mine = np.array([by_id[i][k + 1][0].whitened for i, _ in rows])
        sign = np.sign(mine @ want[:, k])
        assert np.abs(mine * sign - want[:, k]).max() < 1e-10
    for at, (i, _) in enumerate(rows):
        assert all(r.deviation == sum(c * c for c in y[at]) for r in by_id[i][1])
    assert len(by_id[1][1]) == 2 and set(by_id) == {i for i, _ in rows}


def test_sums_and_products_are_exact(spark, monkeypatch):
    rows = vectors(60, 5) + [(1000, [3e38, -3e38, 1.0, 2.0, 3.0]), (1001, [1e15, 2.0, 3.0, 4.0, 1e-30])]
    model = W.fit(W.valid(table(spark, rows)))
    clipped = [[min(max(math.floor(max(min(1024 * c, W.BOUND), -W.BOUND)), -W.BOUND), W.BOUND) + W.SHIFT for c in v] for _, v in rows]
    assert model.sums == [sum(r[j] for r in clipped) for j in range(5)]
    assert len(W.whiten(table(spark, rows)).collect()) == len(rows) * len(model.values)


def residual(a, values, x):
    """(largest entry of AX - XL over the norm, largest entry of X'X - I), in fractions."""
    f = [[Fraction(float(h)) + Fraction(float(c - np.longdouble(float(c)))) for c, h in zip(r, r)] for r in x]
    lam = [Fraction(float(v)) + Fraction(float(v - np.longdouble(float(v)))) for v in values]
    d = len(lam)
    norm = max(abs(c) for r in a for c in r)
    off = max(abs(sum(Fraction(a[i][k]) * f[k][j] for k in range(d)) - lam[j] * f[i][j]) for i in range(d) for j in range(d))
    orth = max(abs(sum(f[k][i] * f[k][j] for k in range(d)) - (i == j)) for i in range(d) for j in range(d))
    return float(off / norm), float(orth)


@pytest.mark.parametrize("spread", [
    [9, 8, 7, 6, 5, 4, 3, 2, 1, 0.5],
    [1, 1 + 1e-9, 1 + 2e-9, 1 - 3e-8, 0.5, 0.5 + 1e-11, 0.5 + 1e-13, 1e-3, 1e-6, 1e-9],  # clusters and a cluster in a cluster
    [2] * 5 + [1] * 5,
    [1] + [0] * 9,
])
def test_refinement(spread):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(10, 10)))[0]
    a = (q * np.array(spread)) @ q.T
    a = ((a + a.T) / 2).astype(np.longdouble)
    values, x = W.refined(a)
    off, orth = residual([[float(c) for c in r] for r in a], values, x)
    assert off < 1e-17 and orth < 1e-17
    assert np.abs(np.sort(spread)[::-1] - values).max() < 1e-14 * max(spread) * 10
    if len(set(spread)) == 10:  # each vector is that of its own value, not a mixture of its cluster's
        start = np.linalg.eigh(a.astype(np.float32))[1]
        assert residual([[float(c) for c in r] for r in a], values, start[:, ::-1].astype(np.longdouble))[0] > 1e-9


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, None)]])
def test_without_variance(spark, rows):
    assert W.whiten(table(spark, rows)).collect() == []


def test_fewer_components(spark):
    rows = [(i, [float(i), float(2 * i), 1.0]) for i in range(20)]
    got = W.whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)


def test_any_partitioning_is_equal(spark):
    rows = table(spark, vectors(300))
    one, many = (W.fit(W.valid(rows.repartition(p))) for p in (1, 9))
    assert (one.vectors == many.vectors).all() and (one.values == many.values).all() and one.rest == many.rest
