"""Operator 12: embedding whitening by mixed-precision eigenvector refinement.

Entries become integers (``floor(1024 c) + 100000``), so sums and products are
exact in any order: two passes give, per task, the sums and the products of
rows centred on the rounded mean; what is left of the centring is exact integer
arithmetic on the d x d result.  Only d numbers and d (d + 1) / 2 numbers reach
the driver, whatever the number of rows.

Eigenvectors of the covariance are found in float32 and corrected in extended
precision by Ogita and Aishima's iteration: with ``R = I - X'X`` and
``S = X'AX`` every vector gets a correction from matrix products alone, which
doubles the correct digits of each round.  Eigenvalues that lie closer together
than the error bound can't be told apart that way: their vectors are rotated by
a sub-solve, the eigenvectors of the small matrix ``V'(A - mu I)V`` that the
cluster's vectors V span, after which the rounds go on.

Edge cases: rows whose vector is null, empty or holds a null or non-finite
entry are dropped; the dimension is the most frequent length (of equally
frequent ones the smallest), rows of other lengths are dropped too; entries
beyond 2^52 / 1024 count as that bound; a null id is kept; repeated rows count
each; a deviation beyond 64 bits is null; components without variance (one row,
equal rows, dependent dimensions) are not returned, so there may be fewer than
asked for; an empty table gives an empty result; other input columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import stored

SCALE, SHIFT = 1024, 100_000
BOUND = 2**52  # largest scaled entry
SMALL = 2**20  # centred entries below this multiply exactly in float64, EXACT_ROWS at a time
EXACT_ROWS = 4096
COMPONENTS = 8
ROUNDS = 30  # of refinement at most; a handful is enough unless clusters lie in clusters
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def valid(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the rows whose vector is whole and finite."""
    v = F.col(f"`{vector}`").cast("array<double>")
    whole = F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return table.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v")).where((F.size("v") > 0) & whole)


def _scaled(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """rows x d integers, without SHIFT."""
    flat = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    with np.errstate(over="ignore"):
        return np.floor(np.clip(flat * SCALE, -BOUND, BOUND)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], d: int, rows: int) -> Iterator[np.ndarray]:
    for batch in batches:
        x = _scaled(batch, d)
        for i in range(0, len(x), rows):
            yield x[i : i + rows]


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, object)
        for x in _blocks(batches, d, 1024):  # 1024 entries of 2^52 fit 64 bits
            total += x.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), _decimals(total)], names=["i", "v"])

    return run


def _products(centre: np.ndarray):
    d = len(centre)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part, rows = np.zeros((d, d), object), np.zeros((d, d), np.int64), 0
        for x in _blocks(batches, d, EXACT_ROWS):
            z = x - centre
            if np.abs(z).max(initial=0) < SMALL:
                f = z.astype(np.float64)
                part += (f.T @ f).astype(np.int64)  # below 2^52: exact in float64
                rows += len(x)
                if rows >= 2**22:
                    total, part, rows = total + part.astype(object), np.zeros((d, d), np.int64), 0
            else:
                z = z.astype(object)
                total = total + z.T @ z
        total = total + part.astype(object)
        yield pa.RecordBatch.from_arrays([*(pa.array(u.astype(np.int32)) for u in upper), _decimals(total[upper])], names=["i", "j", "v"])

    return run


def _norm(m: np.ndarray):
    return np.sqrt((m * m).sum())


def _clusters(values: np.ndarray, bound) -> list[np.ndarray]:
    """Index groups of eigenvalues whose neighbours in order lie within ``bound``."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > bound) + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def refined(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric extended-precision matrix.

    The start is a float32 solve; each round corrects all vectors by matrix
    products and rotates clustered ones by a sub-solve, until no correction
    above the precision is left.
    """
    size = np.abs(a).max(initial=0)
    if not size:
        return np.zeros(len(a), a.dtype), np.eye(len(a), dtype=a.dtype)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(a.dtype)
    eps, eye, scale = np.finfo(a.dtype).eps, np.eye(len(a), dtype=a.dtype), _norm(a)
    least, stalled = np.inf, 0
    for _ in range(ROUNDS):
        r, s = eye - x.T @ x, x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        bound = 2 * (_norm(s - np.diag(values)) + scale * _norm(r))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > bound
        change = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ change
        turned = 0.0
        for group in _clusters(values, bound):
            v = x[:, group]
            mean = values[group].mean()
            inner = v.T @ (a @ v - mean * v)
            inner = (inner + inner.T) / 2
            own = np.abs(inner).max()
            if own <= eps * scale * len(a):  # equal eigenvalues: any basis is right
                continue
            w = np.linalg.eigh((inner / own).astype(np.float64))[1].astype(a.dtype)
            x[:, group] = v @ w
            turned = max(turned, float(np.abs(inner - np.diag(np.diag(inner))).max() / own))
        now = max(float(np.abs(change).max()), turned)
        stalled = stalled + 1 if now > least / 2 else 0  # what is left is the rounding of close eigenvalues
        least = min(least, now)
        if now <= 4 * eps or stalled == 4:
            break
    for _ in range(2):  # corrections of close pairs cost orthogonality, which needs no gap to be restored
        x = x + x @ (eye - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(axis=0))
    values = ((a @ x) * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


@dataclass(frozen=True)
class Whitening:
    n: int
    centre: np.ndarray  # rounded mean of the scaled entries without SHIFT, per dimension
    rest: list[int]  # sum over rows of (entry - centre), per dimension
    values: np.ndarray  # eigenvalues of the returned components, falling
    vectors: np.ndarray  # their unit eigenvectors, as columns
    explained: np.ndarray  # shares of the trace

    @property
    def sums(self) -> list[int]:
        """Per-dimension sums of x."""
        return [int(c + SHIFT) * self.n + r for c, r in zip(self.centre, self.rest, strict=True)]


def _eigen(numerators: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Eigenpairs of numerators / n^2; numerators are exact integers, values come times 2^shift."""
    square = n * n
    most = max(abs(int(v)) for v in numerators.ravel())
    shift = 61 - (most.bit_length() - square.bit_length() + 1)  # 61 bits for the largest entry
    fixed = [(int(v) << shift) // square if shift >= 0 else int(v) // (square << -shift) for v in numerators.ravel()]
    values, vectors = refined(np.array(fixed, np.int64).astype(np.longdouble).reshape(numerators.shape))
    return values, vectors, shift


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``rows`` (``valid``); None without rows."""
    length = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "d").first()
    if length is None:
        return None
    d, n = length["d"], length["n"]
    rows = rows.where(F.size("v") == d).select("v")
    first = rows.mapInArrow(_sums(d), "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()
    sums = [0] * d
    for r in first:
        sums[r["i"]] = int(r["v"])
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    found = rows.mapInArrow(_products(centre), "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    numerators = np.zeros((d, d), object)  # n^2 times the covariance
    for r in found:
        numerators[r["i"], r["j"]] = numerators[r["j"], r["i"]] = n * int(r["v"]) - rest[r["i"]] * rest[r["j"]]
    trace = sum(int(numerators[i, i]) for i in range(d))
    if not trace:
        return Whitening(n, centre, rest, np.zeros(0), np.zeros((d, 0)), np.zeros(0))
    values, vectors, shift = _eigen(numerators, n)
    kept = min(components, int((values > values[0] * d * 2.0**-52).sum()))
    values, vectors = values[:kept], vectors[:, :kept]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])  # the largest entry is positive
    values = np.ldexp(values, -shift)
    return Whitening(n, centre, rest, values.astype(np.float64), vectors.astype(np.float64), (values / (np.longdouble(trace) / n / n)).astype(np.float64))


def _whitened(model: Whitening):
    d = len(model.centre)
    mean = np.array([r / model.n for r in model.rest])
    axes = model.vectors / np.sqrt(model.values)
    rest, squares = np.array(model.rest, object), sum(r * r for r in model.rest)
    most = max(map(abs, model.rest))
    if most * SMALL * d < 2**62:
        rest = rest.astype(np.int64)
    n = model.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            z = _scaled(batch, d) - model.centre
            out = (z - mean) @ axes
            exact = z if np.abs(z).max() < SMALL and rest.dtype != object else z.astype(object)
            own, cross = (exact * exact).sum(axis=1).tolist(), (exact * rest).sum(axis=1).tolist()
            deviation = [n * n * p - 2 * n * q + squares for p, q in zip(own, cross, strict=True)]  # sum of (n z - rest)^2
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("vec_id")),
                pa.array([v if v < 2**63 else None for v in deviation], pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)), pa.array(out.ravel())),
            ], names=["vec_id", "deviation", "w"])

    return run


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation, w (one entry per component) of the ``valid`` rows of the model's dimension."""
    rows = rows.where(F.size("v") == len(model.centre))
    return rows.mapInArrow(_whitened(model), "vec_id long, deviation long, w array<double>")


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, in one aggregate of centred moments."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    moments = whitened.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]) for i, j in pairs]).first()
    return max(abs(m - (i == j)) for m, (i, j) in zip(moments, pairs, strict=True))


def whiten(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component."""
    rows = valid(table, vec_id, vector)
    model = fit(rows, components)
    if model is None or not len(model.values):
        return table.sparkSession.createDataFrame([], RESULT)
    out = stored(transform(rows, model), "whitened")
    error = identity_error(out, len(model.values))
    share = F.array(*[F.lit(float(e)) for e in model.explained])
    return out.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(float(error)).alias("identity_error"))
