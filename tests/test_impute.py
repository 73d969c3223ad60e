"""Imputation: group fallbacks, benchmark guard, regression = least squares."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgeline.operators import impute, regression

T0 = dt.datetime(2025, 1, 1)


def test_group_fill_falls_back_to_global(spark):
    rows = [("A", 1.0), ("A", 3.0), ("A", None), ("B", None), ("C", 10.0), ("C", 20.0), ("C", 60.0), ("C", None)]
    df = spark.createDataFrame(rows, "m string, v double")
    mean = {(r.m, r.v): r.f for r in impute.group_fill(df, "v", "m", "mean", "f").collect()}
    assert mean[("A", None)] == 2.0 and mean[("C", None)] == 30.0
    assert mean[("B", None)] == pytest.approx(94.0 / 5)
    med = {(r.m, r.v): r.f for r in impute.group_fill(df, "v", "m", "median", "f").collect()}
    assert med[("C", None)] == 20.0 and med[("B", None)] == 10.0


def test_benchmark_needs_30_observed(spark):
    rows = [("MACH-01", T0 + dt.timedelta(hours=h), float(h)) for h in range(20)]
    df = spark.createDataFrame(rows, "machine_id_std string, event_ts timestamp_ntz, v double")
    ctx = impute.ImputationContext("d", "v")
    with pytest.raises(Exception, match="Not enough observed rows"):
        impute.evaluate_imputation(df, ctx).collect()


def test_benchmark_metrics_and_choice(spark):
    rows = [(f"MACH-{m:02d}", T0 + dt.timedelta(hours=h), 30.0 + m + (h % 5)) for m in range(1, 4) for h in range(200)]
    df = spark.createDataFrame(rows, "machine_id_std string, event_ts timestamp_ntz, v double")
    ctx = impute.ImputationContext("d", "v", plausible_min=0.0, plausible_max=120.0)
    m = {r.method: r for r in impute.evaluate_imputation(df, ctx, ("mean", "median")).collect()}
    assert m["mean"].masked_rows == 60 and m["mean"].out_of_range_rate == 0.0
    assert m["mean"].rmse >= m["mean"].mae
    ch = impute.choose_method(impute.evaluate_imputation(df, ctx)).first()
    assert ch.recommended_method in impute.METHODS
    assert set(impute.evaluate_imputation(df, ctx).toPandas()["method"]) == set(impute.METHODS)


def test_guard_survives_column_pruning(spark):
    rows = [("MACH-01", T0 + dt.timedelta(hours=h), float(h)) for h in range(12)]
    df = spark.createDataFrame(rows, "machine_id_std string, event_ts timestamp_ntz, v double")
    with pytest.raises(Exception, match="Not enough observed rows"):
        impute.evaluate_imputation(df, impute.ImputationContext("d", "v")).select("mae").collect()


def test_regression_keeps_columns_and_fills_auxiliaries(spark):
    rows = [("MACH-01", T0 + dt.timedelta(hours=h), None if h % 5 == 0 else 2.0 * (h % 3), None if h % 7 == 0 else float(h % 3), h) for h in range(60)]
    df = spark.createDataFrame(rows, "machine_id_std string, event_ts timestamp_ntz, v double, aux double, hour long")
    out = regression.regression_fill(df, "v", "machine_id_std", "event_ts", "f", ["aux"])
    assert out.columns == [*df.columns, "f"]
    got = out.collect()
    assert all(r.f is not None for r in got) and [r.hour for r in sorted(got, key=lambda r: r.event_ts)] == list(range(60))
    none = regression.regression_fill(df.withColumn("v", F.lit(None).cast("double")), "v", "machine_id_std", "event_ts", "f")
    assert none.where("f is not null").count() == 0


def test_regression_fill_matches_least_squares(spark):
    rng = np.random.default_rng(0)
    rows = []
    for m in range(1, 4):
        for h in range(0, 24 * 20, 3):
            ts = T0 + dt.timedelta(hours=h)
            v = 20 + 2 * m + 0.3 * ts.hour + rng.normal(0, 0.1)
            rows.append((f"MACH-{m:02d}", ts, None if h % 7 == 0 else float(v)))
    df = spark.createDataFrame(rows, "machine_id_std string, event_ts timestamp_ntz, v double")
    out = regression.regression_fill(df, "v", "machine_id_std", "event_ts", "f").orderBy("machine_id_std", "event_ts").collect()
    feats = regression.imputation_features(df, "machine_id_std", "event_ts").orderBy("machine_id_std", "event_ts").collect()
    X = np.array([[1.0] + [r[c] for c in regression.FEATURES] for r in feats])
    y = np.array([r.v if r.v is not None else np.nan for r in feats])
    ok = ~np.isnan(y)
    beta, *_ = np.linalg.lstsq(X[ok], y[ok], rcond=None)
    pred = X @ beta
    for r, p, obs in zip(out, pred, y):
        assert r.f == pytest.approx(obs if not np.isnan(obs) else p, rel=1e-6, abs=1e-6)


def test_mask_is_deterministic(spark):
    rows = [("MACH-01", T0 + dt.timedelta(hours=h), float(h)) for h in range(500)]
    df = spark.createDataFrame(rows, "machine_id_std string, event_ts timestamp_ntz, v double")
    ctx = impute.ImputationContext("d", "v")
    a = impute.mask_observed(df, ctx).where("is_masked").select("event_ts").collect()
    b = impute.mask_observed(df, ctx).where("is_masked").select("event_ts").collect()
    assert a == b and len(a) == 50  # exactly max(10, int(0.1 * 500))
    few = spark.createDataFrame(rows[:40], "machine_id_std string, event_ts timestamp_ntz, v double")
    assert impute.mask_observed(few, ctx).where("is_masked").count() == 10
    assert impute.mask_observed(df, ctx).where(F.col("is_masked") & F.col("_bench_value").isNotNull()).count() == 0


def _ridge(X, y):
    """Bayesian ridge with an intercept on a plain design matrix, by its singular values."""
    xm, ym = X.mean(axis=0), y.mean()
    A, b, n = X - xm, y - ym, len(y)
    U, S, Vt = np.linalg.svd(A, full_matrices=False)
    alpha, lam, old = 1 / (b.var() + np.finfo(float).eps), 1.0, None

    def coef(ratio):
        return Vt.T @ ((S * (U.T @ b)) / (S**2 + ratio))

    for _ in range(300):
        w = coef(lam / alpha)
        gamma = (alpha * S**2 / (lam + alpha * S**2)).sum()
        lam = (gamma + 2e-6) / ((w**2).sum() + 2e-6)
        alpha = (n - gamma + 2e-6) / (((b - A @ w) ** 2).sum() + 2e-6)
        if old is not None and np.abs(old - w).sum() < 1e-3:
            break
        old = w
    w = coef(lam / alpha)
    return w, ym - xm @ w


def _chained(M, tolerance, rounds=15):
    """Column 0 of a matrix with NaN gaps after chained Bayesian ridge rounds from medians."""
    gap = np.isnan(M)
    Z = np.where(gap, np.nanmedian(M, axis=0), M)
    order = [c for c in np.argsort(gap.mean(axis=0), kind="stable") if gap[:, c].any()]
    largest, did = np.abs(M[~gap]).max(), 0
    for _ in range(rounds):
        before = Z.copy()
        for c in order:
            rest = np.delete(Z, c, axis=1)
            w, b = _ridge(rest[~gap[:, c]], Z[~gap[:, c], c])
            Z[gap[:, c], c] = rest[gap[:, c]] @ w + b
        did += 1
        if np.abs(Z - before).sum(axis=1).max() < tolerance * largest:
            break
    return Z[:, 0], did


def _gappy(spark, with_aux_gaps):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(240):
        m = None if with_aux_gaps and i % 17 == 0 else f"MACH-{i % 3 + 1:02d}"
        at = T0 + dt.timedelta(hours=3 * i)
        a = float(rng.normal(50, 5))
        v = None if i % 5 == 0 else float(0.8 * a + 0.5 * at.hour + rng.normal(0, 0.5))
        a = None if with_aux_gaps and i % 7 == 0 else a
        rows.append((i, m, at, v, a, None if a is None else 2 * a + 1, 4.0))  # a collinear and a constant feature
    return spark.createDataFrame(rows, "i long, machine_id_std string, event_ts timestamp_ntz, v double, a double, twice double, same double"), rows


def _matrix(rows):
    code = {m: float(k) for k, m in enumerate(sorted({r[1] for r in rows if r[1]}))}
    nan = lambda x: np.nan if x is None else x
    return np.array([[nan(r[3]), np.nan if r[1] is None else code[r[1]], r[2].hour, r[2].weekday(), r[2].month,
                      (r[2] - dt.datetime(1970, 1, 1)).total_seconds() // 3600, nan(r[4]), nan(r[5]), r[6]] for r in rows], float)


@pytest.mark.parametrize(("with_aux_gaps", "tolerance"), [(False, 1e-3), (True, 1e-3), (True, 1e-11)])
def test_chained_bayesian_ridge_matches_plain_numpy(spark, monkeypatch, with_aux_gaps, tolerance):
    """Hours since 1970 are the largest value, so the usual tolerance ends after a round; a small one takes several."""
    df, rows = _gappy(spark, with_aux_gaps)
    want, rounds = _chained(_matrix(rows), tolerance)
    monkeypatch.setattr(regression, "ROUND_TOLERANCE", tolerance)
    out = regression.chained_fill(df, "v", "machine_id_std", "event_ts", "f", ["a", "twice", "same"])
    assert out.columns == [*df.columns, "f"]
    got = {r.i: r.f for r in out.collect()}
    assert (rounds > 2) == (tolerance < 1e-3) and len(got) == len(rows)
    for r, w in zip(rows, want):
        assert got[r[0]] == pytest.approx(w if r[3] is None else r[3], rel=1e-6), r


def test_bayesian_ridge_weights(spark):
    df, rows = _gappy(spark, False)
    M = _matrix(rows)
    known = M[~np.isnan(M[:, 0])]
    w, _ = _ridge(known[:, 1:], known[:, 0])
    cov = np.cov(known.T, bias=True)
    mine = regression.bayesian_ridge(cov[1:, 1:], cov[1:, 0], cov[0, 0], len(known))
    assert np.allclose(mine, w, rtol=1e-6, atol=1e-9) and mine[-1] == 0


def test_chained_fill_without_values(spark):
    df, _ = _gappy(spark, True)
    none = regression.chained_fill(df.withColumn("v", F.lit(None).cast("double")), "v", "machine_id_std", "event_ts", "f", ["a"])
    assert none.where("f is not null").count() == 0 and none.columns == [*df.columns, "f"]
    full = regression.chained_fill(df.dropna(), "v", "machine_id_std", "event_ts", "f", ["a"])
    assert full.where("f <> v").count() == 0
