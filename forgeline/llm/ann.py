"""Operator 7: nearest neighbours by an adaptive dimension scan over inverted lists.

Vectors are assigned to the nearest of at most ``MAX_LISTS`` centroids, fitted
by k-means on a bounded sample of ``SAMPLE_PER_LIST`` vectors per list (those
of smallest id hash); every vector is indexed.  A query probes the lists of
its nearest centroids.  Inside a list vectors are rotated by a fixed random
orthogonal matrix and scanned in column blocks: after each block a candidate
is abandoned if its partial distance, scaled to the full dimension, exceeds
the current k-th distance by more than the test's margin.  Survivors get the
exact Euclidean distance on the original vectors in double precision.

Lists are split into parts of at most ``PART_ROWS`` vectors and of at most
``PART_ROWS`` queries, so a hot list (many copies of one vector) is many
groups; each part returns its k best, and a ranked window merges them.

Edge cases: vectors that are null, zero, of another length than the most
common one, or with null or non-finite components take no part, neither do
rows with a null id.  Rows that share a query's id are not its candidates; a
repeated query id is searched once.  With fewer than k candidates all are
returned; ties go to the smaller ``vec_id``.  An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_LISTS = 4096
SAMPLE_PER_LIST = 64
MIN_SAMPLE = 4096
PART_ROWS = 4096
TARGET = 0.97  # share of sample neighbours in the probed lists
TRIALS = 256  # sample vectors whose neighbours are looked up
BLOCK = 32
MARGIN = 2.1  # width of the hypothesis test; larger abandons later
SEED = 7

RESULT = "query_id long, vec_id long, score double"


def valid_vectors(table: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, vec array<double>): rows that can take part, all of the most common length."""
    x = F.col(column).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda v: v != 0))
    most = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return rows.where(F.size("vec") == (most["n"] if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]


def kmeans(sample: np.ndarray, lists: int, steps: int = 8) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    distinct = np.unique(sample, axis=0)
    centroids = distinct[rng.choice(len(distinct), min(lists, len(distinct)), replace=False)]
    for _ in range(steps):
        own = np.concatenate([_squared(part, centroids).argmin(1) for part in np.array_split(sample, max(1, len(sample) // 4096))])
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        counts = np.bincount(own, minlength=len(centroids))
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def needed_probes(sample: np.ndarray, centroids: np.ndarray, k: int, target: float) -> int:
    """Lists to probe so that they hold ``target`` of the k nearest sample vectors of sample vectors."""
    trials = sample[:TRIALS]
    own = np.concatenate([_squared(part, centroids).argmin(1) for part in np.array_split(sample, max(1, len(sample) // 4096))])
    distance = _squared(trials, sample)
    distance[np.arange(len(trials)), np.arange(len(trials))] = np.inf
    near = np.argsort(distance, axis=1, kind="stable")[:, : min(k, max(1, len(sample) - 1))]
    place = np.argsort(np.argsort(_squared(trials, centroids), axis=1, kind="stable"), axis=1, kind="stable")
    return int(np.quantile(np.take_along_axis(place, own[near], axis=1), target, method="higher")) + 1


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def adaptive_scan(query: np.ndarray, turned_query: np.ndarray, ids: np.ndarray, vecs: np.ndarray, turned: np.ndarray, own_id: int,
                  k: int, step: int = 512) -> list[tuple[float, int]]:
    """The k nearest of one list part: (distance, id) by distance and id."""
    dim = turned.shape[1]
    best: list[tuple[float, int]] = []
    for a in range(0, len(ids), step):
        alive = a + np.flatnonzero(ids[a : a + step] != own_id)
        partial = np.zeros(len(alive))
        for d in range(0, dim, BLOCK):
            diff = turned[alive, d : d + BLOCK] - turned_query[d : d + BLOCK]
            partial += np.einsum("ij,ij->i", diff, diff)
            seen = min(d + BLOCK, dim)
            if len(best) == k and seen < dim:
                stay = partial <= best[-1][0] ** 2 * (seen / dim) * (1 + MARGIN / np.sqrt(seen)) ** 2
                alive, partial = alive[stay], partial[stay]
                if not len(alive):
                    break
        if len(alive):
            diff = vecs[alive] - query
            exact = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            order = np.lexsort((ids[alive], exact))[:k]
            best = sorted(best + [(float(exact[i]), int(ids[alive[i]])) for i in order])[:k]
    return best


def search(table: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query (vec_id, vec) among all valid rows of ``table``."""
    spark = table.sparkSession
    rows = valid_vectors(table)
    n = rows.count()
    out = "query_id long, rank int, vec_id long, score double"
    if n == 0:
        return spark.createDataFrame([], out)
    lists = int(min(MAX_LISTS, max(1, round(np.sqrt(n)))))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(MIN_SAMPLE, SAMPLE_PER_LIST * lists)).select("vec")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.concatenate([_matrix(b.column(0)) for b in batches])
        centroids = kmeans(found, lists)
        yield pa.RecordBatch.from_arrays([pa.array(centroids.tolist(), pa.list_(pa.float64())), pa.array([needed_probes(found, centroids, k, TARGET)] * len(centroids), pa.int32())],
                                         names=["centroid", "probes"])

    # the bounded sample is fitted by one task; at most MAX_LISTS centroids come back
    fitted = sample.coalesce(1).mapInArrow(fit, "centroid array<double>, probes int").collect()
    centroids, probes = np.array([r["centroid"] for r in fitted]), fitted[0]["probes"]
    lists = len(centroids)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _squared(_matrix(batch.column(1)), centroids).argmin(1) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.int32())], names=["vec_id", "vec", "list"])

    placed = rows.mapInArrow(nearest, "vec_id long, vec array<double>, list int")
    sizes = np.zeros(lists, np.int64)
    for r in placed.groupBy("list").count().collect():  # at most MAX_LISTS rows
        sizes[r["list"]] = r["count"]

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = np.argsort(_squared(_matrix(batch.column(1)), centroids), axis=1, kind="stable") if batch.num_rows else np.empty((0, lists), int)
            # further lists until k others are sure to be among the rows
            enough = [max(probes, int(np.searchsorted(np.cumsum(sizes[o]), 2 * k + 1)) + 1) for o in order]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([o[:e].tolist() for o, e in zip(order, enough, strict=True)],
                                                                                       pa.list_(pa.int32()))], names=["query_id", "query", "lists"])

    asked = queries.dropDuplicates(["vec_id"]).mapInArrow(probed, "query_id long, query array<double>, lists array<int>")
    asked = asked.select("query_id", "query", F.explode("lists").alias("list"))
    load = {r["list"]: r["count"] for r in asked.groupBy("list").count().collect()}  # at most MAX_LISTS rows
    parts = spark.createDataFrame([(i, max(1, -(-int(sizes[i]) // PART_ROWS)), max(1, -(-load.get(i, 0) // PART_ROWS))) for i in range(lists)],
                                  "list int, vparts int, qparts int")
    parts = F.broadcast(parts)

    def spread(own: str, other: str):
        return F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(f"__{other}"), F.pmod(F.xxhash64(own), F.col(f"{other[0] == 'q' and 'v' or 'q'}parts")).cast("int")

    every_q, v_own = spread("vec_id", "qparts")
    every_v, q_own = spread("query_id", "vparts")
    left = placed.join(parts, "list").select("list", v_own.alias("v"), every_q, "vec_id", "vec").withColumnRenamed("__qparts", "q")
    right = asked.join(parts, "list").select("list", every_v, q_own.alias("q"), "query_id", "query").withColumnRenamed("__vparts", "v")

    def scan(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if vectors.num_rows and asked.num_rows:
            ids, vecs = vectors["vec_id"].to_numpy(), _matrix(vectors["vec"])
            turn = rotation(vecs.shape[1])
            turned, wanted = vecs @ turn, _matrix(asked["query"])
            turned_wanted = wanted @ turn
            for i, own in enumerate(asked["query_id"].to_pylist()):
                found += [(own, v, s) for s, v in adaptive_scan(wanted[i], turned_wanted[i], ids, vecs, turned, own, k)]
        q, v, s = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    near = left.groupBy("list", "v", "q").cogroup(right.groupBy("list", "v", "q")).applyInArrow(scan, RESULT)
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(vectors: list[tuple[int, list[float]]], query_ids: set[int], k: int = 10) -> dict[int, list[tuple[float, int]]]:
    """Exact answers on a small fixture."""
    ids, x = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors], dtype=float)
    out = {}
    for i, own in enumerate(ids):
        if int(own) in query_ids:
            d = np.sqrt(((x - x[i]) ** 2).sum(1))
            out[int(own)] = sorted((float(a), int(b)) for a, b in zip(d, ids, strict=True) if b != own)[:k]
    return out
