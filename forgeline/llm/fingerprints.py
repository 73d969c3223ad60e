"""Operator 1: threshold-scaled document fingerprints.

A text's shingles are its windows of five words (a shorter text is one
shingle).  The sketch retains every shingle hash below a fixed fraction
2^-BASE_LEVEL of the hash space, so sketches merge by union and estimate
containment between texts of very unequal size.  A text that would retain
fewer than MIN_RETAINED hashes doubles its fraction until it has them (or
retains all); two sketches are compared at the smaller of their fractions,
below which both are complete.

A fingerprint is ``<level>:<base64 of the sorted retained 64-bit hashes>``;
equal texts have equal fingerprints.

Edge cases: a null text is empty; texts without words have the empty
fingerprint ``0:`` and likeness 1 to each other, 0 to all others.  Rows with
the same ``doc_id`` are ordered by text; null ids come last.  The only
document of a table is its own successor.  An empty table gives an empty
result; other input columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import WordHashes, shingle_hashes, text_bytes

SHINGLE_WORDS = 5
BASE_LEVEL = 4
MIN_RETAINED = 64
BUCKET_BYTES = 4 << 20
MAX_BUCKETS = 100_000

SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, contained_edited double, contained_next double")

Sketch = tuple[int, np.ndarray]


def sketch(text: str, hashes: WordHashes) -> Sketch:
    """(level, sorted retained hashes): all hashes below 2^(64 - level)."""
    u = np.unique(shingle_hashes(hashes.of(text.encode().split()), SHINGLE_WORDS))
    for level in range(BASE_LEVEL, 0, -1):
        kept = int(np.searchsorted(u, np.uint64(1 << (64 - level))))
        if kept >= MIN_RETAINED:
            return level, u[:kept]
    return 0, u


def encoded(s: Sketch) -> str:
    return f"{s[0]}:{base64.b64encode(s[1].astype('<u8').tobytes()).decode()}"


def decoded(fingerprint: str) -> Sketch:
    level, _, data = fingerprint.partition(":")
    return int(level), np.frombuffer(base64.b64decode(data), "<u8")


def _at_common_level(a: Sketch, b: Sketch) -> tuple[np.ndarray, np.ndarray]:
    level = max(a[0], b[0])
    cut = lambda s: s[1] if s[0] == level else s[1][: int(np.searchsorted(s[1], np.uint64(1 << (64 - level))))]
    return cut(a), cut(b)


def merged(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of the union of two shingle sets."""
    x, y = _at_common_level(a, b)
    return max(a[0], b[0]), np.union1d(x, y)


def likeness(a: Sketch, b: Sketch) -> tuple[float, float]:
    """(Jaccard estimate, estimated share of a's shingles that b contains)."""
    x, y = _at_common_level(a, b)
    if not len(x) and not len(y):
        return (1.0, 1.0) if len(a[1]) == len(b[1]) == 0 else (0.0, 0.0)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both), both / len(x) if len(x) else 0.0


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of the next text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (bucket, role, order); each row is finished when its successor is seen."""
    hashes = WordHashes()
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                        *[(c, pa.float64()) for c in ("near_edited", "near_next", "contained_edited", "contained_next")]])
    held = None  # (bucket, doc_id, text, sketch, fingerprint)
    out: list[tuple] = []

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        out.clear()
        return batch

    for batch in batches:
        for bucket, role, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if role and (held is None or held[0] != bucket):
                continue  # a further row with the successor's doc_id
            s = sketch(text, hashes)
            if held is not None and held[0] == bucket:
                _, last_id, last_text, last, fingerprint = held
                new = edited_text(last_text, text)
                other = last if new == last_text else sketch(new, hashes)
                near_edited, near_next = likeness(last, other), likeness(last, s)
                out.append((last_id, len(last_text), hashlib.sha256(new.encode()).hexdigest(), fingerprint, encoded(other),
                            near_edited[0], near_next[0], near_edited[1], near_next[1]))
            held = None if role else (bucket, doc_id, text, s, encoded(s))
            if len(out) >= 500:
                yield flush()
    if out:
        yield flush()


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, see SCHEMA.

    The text is shuffled once: approximate quantiles of ``doc_id`` cut the
    rows into buckets in id order, and the first row of each bucket is also
    sent to the bucket whose last row it follows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n, size = text_bytes(rows)
    if n == 0:
        return spark.createDataFrame([], SCHEMA)
    parts = max(1, min(MAX_BUCKETS, n, -(-size // BUCKET_BYTES)))
    key = F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.7e308))
    rows = rows.withColumn("__key", key)
    cuts = sorted(set(rows.approxQuantile("__key", [i / parts for i in range(1, parts)], 0.25 / parts))) if parts > 1 else []
    if cuts:
        rows = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="__key", outputCol="__b").transform(rows)
        rows = rows.withColumn("__bucket", F.col("__b").cast("int"))
    else:
        rows = rows.withColumn("__bucket", F.lit(0))
    # one row per bucket (at most MAX_BUCKETS): its largest id
    firsts = sorted((r["__bucket"], r["first"]) for r in rows.groupBy("__bucket").agg(F.max("doc_id").alias("first")).collect())
    heads = [(firsts[i - 1][1], b) for i, (b, _) in enumerate(firsts)]  # below the lowest bucket follows the highest
    heads_df = F.broadcast(spark.createDataFrame(heads, "__head long, __target int"))
    own = F.struct(F.col("__bucket").alias("bucket"), F.lit(0).alias("role"))
    copy = F.struct(F.col("__target").alias("bucket"), F.lit(1).alias("role"))
    placed = rows.join(heads_df, F.col("doc_id").eqNullSafe(F.col("__head")), "left").select(
        F.explode(F.when(F.col("__target").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("at"), "doc_id", "text")
    return (
        placed.select("at.bucket", "at.role", "doc_id", "text")
        .repartition(max(parts, len(firsts)), "bucket")
        .sortWithinPartitions("bucket", "role", F.col("doc_id").desc_nulls_last(), "text")
        .mapInArrow(_fingerprinted, SCHEMA)
    )
