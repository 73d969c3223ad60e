"""Helpers shared by the corpus operators.

Words everywhere are ``[^\\x20\\x09-\\x0D]+``: exactly what ``bytes.split()``
yields on the UTF-8 bytes of a text.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgeline.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD_CACHE = 1_000_000  # entries of a task's word table before it is started anew


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of the executions inside go as soon as each has ended."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared scratch folder and read it back: lineage is cut, lost executors re-read files."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plainly_named(docs: DataFrame, *kept: str) -> DataFrame:
    """All columns but ``kept`` under names of their place, so that none clashes with an inner one or needs quoting; ``toDF`` names them back."""
    return docs.toDF(*[c if c in kept else f"column_{i}" for i, c in enumerate(docs.columns)])


def text_bytes(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """(rows, UTF-8 bytes of the text column): one aggregate over the scan."""
    r = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


class WordHashes(dict):
    """word bytes -> 64-bit hash, computed once per task and word; started anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` words; a shorter sequence is one window, none without words."""
    n = len(word_hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(k, n)
    acc = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        acc = (acc + word_hashes[j : n - k + 1 + j]) * _MUL
        acc ^= acc >> np.uint64(29)
    return mixed(acc)


def ranked(df: DataFrame, group: str, order: list, salt, rank: str, buckets: int = 1024) -> DataFrame:
    """Gapless rank from 0 within ``group`` without one task per group.

    ``salt`` (a long expression on the rows) spreads each group over
    ``buckets`` parts; rows are numbered inside a part and the parts' counts,
    at most ``buckets`` per group, give each part its offset.  The number of
    groups must be bounded (shards, length classes), so the broadcast offsets
    are: groups x buckets rows.
    """
    part = "__part"
    rows = df.withColumn(part, F.pmod(salt, F.lit(buckets)))
    w = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(group, part).agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
        .select(F.col(group).alias("__g"), F.col(part).alias("__p"), "__off")
    )
    numbered = rows.withColumn("__rn", F.row_number().over(Window.partitionBy(group, part).orderBy(*order)))
    return (
        numbered.join(F.broadcast(offsets), (F.col(group) == F.col("__g")) & (F.col(part) == F.col("__p")))
        .withColumn(rank, (F.col("__off") + F.col("__rn") - 1).cast("long"))
        .drop("__g", "__p", "__off", "__rn", part)
    )
