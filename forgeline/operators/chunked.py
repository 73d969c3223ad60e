"""Ordered scans over long per-key series without one task per key.

A ``Window.partitionBy(machine)`` over *raw* readings puts a whole machine
into one task; when one machine holds a third of all rows that task is the
job.  The helpers here split each key's series into time chunks (a day by
default), do the ordered work inside ``(key, chunk)`` partitions and carry
what crosses chunk boundaries (previous timestamp, running totals, row
offsets) through small per-chunk summaries.  The summaries have one row per
key and chunk, so their size follows the time span, not the data volume.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chunk_of(ts: Column | str, unit: str = "day") -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def with_running_sum(df: DataFrame, keys: list[str], chunk: str, order: list[str], value: str, out: str) -> DataFrame:
    """Inclusive running sum of ``value`` per key in ``order`` (across chunks)."""
    local, total, offset = (_free(df, c) for c in ("local_sum", "chunk_total", "offset"))
    named = {k: _free(df, f"of_{i}") for i, k in enumerate([*keys, chunk])}
    w_local = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_chunk = df.groupBy(*[F.col(k).alias(n) for k, n in named.items()]).agg(F.sum(value).alias(total))
    w_chunks = Window.partitionBy(*[named[k] for k in keys]).orderBy(named[chunk]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(*named.values(), F.coalesce(F.sum(total).over(w_chunks), F.lit(0)).alias(offset))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()])
    return (
        df.withColumn(local, F.sum(value).over(w_local))
        .join(offsets, same, "left")
        .withColumn(out, F.col(offset) + F.col(local))
        .drop(local, offset, *named.values())
    )


def with_row_index(df: DataFrame, keys: list[str], chunk: str, order: list[str], out: str) -> DataFrame:
    """0-based position of each row within its key (a distributed row_number)."""
    one = _free(df, "one")
    return with_running_sum(df.withColumn(one, F.lit(1)), keys, chunk, order, one, out).withColumn(out, F.col(out) - 1).drop(one)


def _free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    name = f"_{name}"
    while name in df.columns:
        name = f"_{name}"
    return name


def halo_buckets(df: DataFrame, index: str, bucket_rows: int, before: int, after: int = 0,
                 bucket: str = "_bucket", home: str = "_home") -> DataFrame:
    """Replicate rows into other buckets so frames never cross a bucket.

    Each row lives in bucket ``index // bucket_rows`` (column ``home`` true) and
    is copied into every bucket that starts within ``before`` after it or ends
    within ``after`` before it.  A window partitioned by (key, ``bucket``) with a
    frame of at most ``before`` back and ``after`` ahead then sees exactly the
    rows it would see over the whole series; keep ``home`` rows afterwards.
    """
    own = F.floor(F.col(index) / bucket_rows).cast("bigint")
    first = F.floor((F.col(index) - after) / bucket_rows).cast("bigint")
    last = F.floor((F.col(index) + before) / bucket_rows).cast("bigint")
    return df.select("*", F.explode(F.sequence(first, last)).alias(bucket)).withColumn(home, F.col(bucket) == own)
