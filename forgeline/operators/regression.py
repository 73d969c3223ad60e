"""Regression imputation.

Every fit is one aggregate (means and covariances of target and features,
combined on the executors); the small system, features x features, is solved on
the driver.  ``regression_fill`` is least squares; ``chained_fill`` is the
iterative imputer: Bayesian ridge regressions, in rounds over all columns with
gaps where there are several.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.functions.quantiles import exact_quantiles
from forgeline.session import materialize

# Fixed values that must equal the reference for right results.
ROUNDS = 15  # of the iterative imputer
FIT_STEPS, FIT_TOLERANCE, PRIOR = 300, 1e-3, 1e-6  # of a Bayesian ridge fit: steps at most, change of the weights that ends it, shape and rate of both priors
ROUND_TOLERANCE = 1e-3  # change of a row's filled values, as a share of the largest observed one, that ends the rounds

FEATURES = ["machine_code_numeric", "hour", "dayofweek", "month", "time_ordinal_hours"]


def machine_codes(df: DataFrame, group: str) -> DataFrame:
    """Lexicographic code of each machine (0-based), one row per machine."""
    distinct = df.where(F.col(group).isNotNull()).select(group).distinct()
    return distinct.withColumn("machine_code_numeric", (F.dense_rank().over(Window.orderBy(group)) - 1).cast("double"))


def imputation_features(df: DataFrame, group: str, time: str, aux: list[str] | None = None) -> DataFrame:
    """Machine code, hour, day of week (Mon=0), month, ordinal hours."""
    out = df.join(F.broadcast(machine_codes(df, group)), group, "left")
    feats = X.calendar_features(time)
    out = out.withColumns({k: v.cast("double") for k, v in feats.items()})
    for c in aux or []:
        out = out.withColumn(c, F.col(c).cast("double"))
    return out


def regression_fill(df: DataFrame, value: str, group: str, time: str, out: str, aux: list[str] | None = None) -> DataFrame:
    """``coalesce(value, prediction)`` from a least-squares fit on observed rows.

    Gaps of auxiliary columns take the column's median.  A feature without
    variance gets no weight; of collinear features the smallest weights are
    taken.  Rows without a machine or time get no prediction.
    """
    codes = machine_codes(df, group).select(F.col(group).alias("__group"), F.col("machine_code_numeric").alias("__x0"))
    rows = df.join(F.broadcast(codes), F.col(group) == F.col("__group"), "left").drop("__group")
    features = list(X.calendar_features(time).values())
    features += [F.coalesce(F.col(c).cast("double"), exact_quantiles(df, c, [0.5]).select("q0").scalar()) for c in aux or []]
    names = [f"__x{i}" for i in range(len(features) + 1)]
    rows = rows.withColumns({n: f.cast("double") for n, f in zip(names[1:], features, strict=True)})
    known = rows.select(F.col(value).cast("double").alias("__y"), *names).dropna()
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    stats = known.agg(F.avg("__y").alias("y"), *[F.avg(n).alias(n) for n in names], *[F.covar_pop(n, "__y").alias(f"{n}y") for n in names],
                      *[F.covar_pop(a, b).alias(a + b) for a, b in pairs]).first()
    if stats["y"] is None:
        return rows.withColumn(out, F.col(value).cast("double")).drop(*names)
    both = {p: stats[a + b] for a, b in pairs for p in ((a, b), (b, a))}
    weights = _weights(np.array([[both[a, b] for b in names] for a in names]), np.array([stats[f"{n}y"] for n in names]))
    prediction = F.lit(float(stats["y"]))
    for n, w in zip(names, weights.tolist(), strict=True):
        if w:
            prediction = prediction + F.lit(w) * (F.col(n) - F.lit(float(stats[n])))
    complete = F.lit(True)
    for n in names:
        complete = complete & F.col(n).isNotNull()
    return rows.withColumn(out, F.coalesce(F.col(value).cast("double"), F.when(complete, prediction))).drop(*names)


def _weights(covariances: np.ndarray, with_target: np.ndarray) -> np.ndarray:
    """Least-squares weights from covariances, solved on standardised features."""
    scale = np.sqrt(np.diag(covariances))
    used = scale > 1e-12 * max(1.0, float(scale.max()))
    weights = np.zeros(len(scale))
    if used.any():
        s = scale[used]
        weights[used] = np.linalg.lstsq(covariances[np.ix_(used, used)] / np.outer(s, s), with_target[used] / s, rcond=1e-10)[0] / s
    return weights


def bayesian_ridge(covariances: np.ndarray, with_target: np.ndarray, target_variance: float, n: int) -> np.ndarray:
    """Weights of a Bayesian ridge regression from population covariances (evidence maximisation after MacKay).

    Noise and weight precisions are re-estimated from the fit until the weights
    stand still; collinear features share their weight, and a feature without
    variance gets none.
    """
    roots, axes = np.linalg.eigh(covariances * n)
    roots, along = np.maximum(roots, 0.0), axes.T @ (with_target * n)
    squares = target_variance * n

    def fit(ratio: float) -> tuple[np.ndarray, float]:
        """(weights along the axes, sum of squared errors) at a ratio of weight to noise precision."""
        w = along / (roots + ratio)
        return w, max(0.0, float(squares - 2 * w @ along + (w * w) @ roots))

    noise, weight, before = 1.0 / (target_variance + np.finfo(float).eps), 1.0, None
    for _ in range(FIT_STEPS):
        w, error = fit(weight / noise)
        known = float((noise * roots / (weight + noise * roots)).sum())  # number of well determined weights
        weight = (known + 2 * PRIOR) / (float(w @ w) + 2 * PRIOR)
        noise = (n - known + 2 * PRIOR) / (error + 2 * PRIOR)
        now = axes @ w
        if before is not None and np.abs(before - now).sum() < FIT_TOLERANCE:
            break
        before = now
    return axes @ fit(weight / noise)[0]


def _moments(rows: DataFrame, target: str, others: list[str]) -> tuple[int, dict[str, float], np.ndarray, np.ndarray, float]:
    """(rows, means, covariances of the others, with the target, target's variance) in one aggregate."""
    names = [target, *others]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    r = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in names], *[F.covar_pop(a, b).alias(f"{a}*{b}") for a, b in pairs]).first()
    both = {p: r[f"{a}*{b}"] or 0.0 for a, b in pairs for p in ((a, b), (b, a))}
    cov = np.array([[both[a, b] for b in others] for a in others]).reshape(len(others), len(others))
    return r["n"], {c: r[c] for c in names}, cov, np.array([both[c, target] for c in others]), both[target, target]


def chained_fill(df: DataFrame, value: str, group: str, time: str, out: str, aux: list[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """The iterative imputer's ``value``; gaps start at the column's median.

    Columns are the value, the calendar and machine features and ``aux``.  In
    every round each column with gaps, the one with the fewest first, is fitted
    on the rows where it was observed, on all other columns as they are filled
    now, and its gaps take the prediction.  Rounds end when no row's filled
    values change by a thousandth of the largest observed one, or after
    ``rounds``; with gaps in one column alone the first round is the last.  A
    column without any value is left out; without an observed value the result
    is null.  Rounds over several columns are stored, so a plan never holds
    more than one.
    """
    codes = machine_codes(df, group).select(F.col(group).alias("__group"), F.col("machine_code_numeric").alias("__c1"))
    rows = df.join(F.broadcast(codes), F.col(group) == F.col("__group"), "left").drop("__group")
    features = [F.col("__c1"), *X.calendar_features(time).values(), *[F.col(c) for c in aux or []]]
    columns = {"__c0": F.col(value), **{f"__c{i}": f for i, f in enumerate(features, 1)}}
    rows = rows.withColumns({c: F.when(~F.isnan(v.cast("double")), v.cast("double")) for c, v in columns.items()})
    seen = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in columns], F.max(F.greatest(*[F.abs(c) for c in columns])).alias("largest")).first()
    used = [c for c in columns if seen[c]]
    gaps = sorted((c for c in used if seen[c] < seen["n"]), key=lambda c: (seen["n"] - seen[c], used.index(c)))
    if "__c0" not in used:
        return rows.withColumn(out, F.col(value).cast("double")).drop(*columns)
    medians = {c: exact_quantiles(rows, c, [0.5]).first()["q0"] for c in gaps}
    filled = rows.withColumns({f"__gap{c}": F.col(c).isNull() for c in gaps}).withColumns({c: F.coalesce(c, F.lit(medians[c])) for c in gaps})
    kept = filled.columns
    for step in range(rounds if len(gaps) > 1 else min(1, len(gaps))):
        if len(gaps) > 1:
            filled = filled.select(*kept, *[F.col(c).alias(f"__old{c}") for c in gaps])
        for c in gaps:
            others = [x for x in used if x != c]
            n, means, cov, with_target, variance = _moments(filled.where(~F.col(f"__gap{c}")), c, others)
            prediction: Column = F.lit(float(means[c]))
            for x, w in zip(others, bayesian_ridge(cov, with_target, variance, n).tolist(), strict=True):
                prediction = prediction + F.lit(w) * (F.col(x) - F.lit(float(means[x])))
            filled = filled.withColumn(c, F.when(F.col(f"__gap{c}"), prediction).otherwise(F.col(c)))
        if len(gaps) > 1:
            filled = materialize(filled, "chained")
            change = filled.agg(F.max(sum(F.abs(F.col(c) - F.col(f"__old{c}")) for c in gaps))).first()[0]
            filled = filled.select(*kept)
            if change < ROUND_TOLERANCE * seen["largest"]:
                break
    return filled.withColumn(out, F.col("__c0")).drop(*[c for c in filled.columns if c.startswith(("__c", "__gap")) and c not in df.columns])


FILLS = {"least_squares": regression_fill, "bayesian_ridge": chained_fill}
