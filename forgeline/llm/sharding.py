"""Operator 8: sharding by a hierarchical weighted hash tree (DataFrame functions only).

A document descends region -> rack -> shard.  At every level each child draws
``-ln(u) / weight`` with ``u`` a hash of (document key, child) in (0, 1), and
the smallest draw wins: a child wins in proportion to its weight, and when a
weight changes only draws of that child change, so rows move only into or out
of that subtree.

Law ``key``: ``doc_id`` and the topology decide alone.  A shard added as a
region of its own takes rows only into itself; racks and shards elsewhere keep
their draws.

Edge cases: a null ``doc_id`` draws by the hash of its text; a null text has
size 1 and CRC 0; repeated rows get the same shard and separate slots; an
empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import ranked


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(shards: int, per_rack: int = 2, racks_per_region: int = 2) -> list[Shard]:
    """Shards 0..n-1 filled rack by rack, region by region, all of weight 1."""
    per_region = per_rack * racks_per_region
    return [Shard(s // per_region, s // per_rack, s) for s in range(shards)]


def _draw(key: Column, level: str, node: int, weight: float) -> Column:
    # 53 high bits of the hash, half a step off zero: u lies strictly in (0, 1)
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(f"{level}:{node}")), 11).cast("double") + 0.5) / float(2**53)
    return F.struct((-F.log(u) / F.lit(float(weight))).alias("draw"), F.lit(node).alias("node"))


def _winner(key: Column, level: str, weights: dict[int, float]) -> Column:
    if len(weights) == 1:
        return F.lit(next(iter(weights)))
    return F.array_min(F.array(*[_draw(key, level, n, w) for n, w in sorted(weights.items())]))["node"]


def _branch(parent: Column, options: dict[int, Column]) -> Column:
    if len(options) == 1:
        return next(iter(options.values()))
    out = None
    for node, value in sorted(options.items()):
        out = F.when(parent == node, value) if out is None else out.when(parent == node, value)
    return out


def _weights(shards: list[Shard], child: str, parent: str | None = None) -> dict:
    out: dict = {}
    for s in shards:
        level = out.setdefault(getattr(s, parent), {}) if parent else out
        level[getattr(s, child)] = level.get(getattr(s, child), 0.0) + s.weight
    return out


def descend(df: DataFrame, key: Column, shards: list[Shard], prefix: str = "") -> DataFrame:
    """Adds ``<prefix>region``, ``<prefix>rack`` and ``<prefix>shard`` columns."""
    if not shards or any(s.weight <= 0 for s in shards):
        raise ValueError("a topology needs shards of positive weight")
    region, rack, shard = (prefix + c for c in ("region", "rack", "shard"))
    racks = {r: _winner(key, "rack", w) for r, w in _weights(shards, "rack", "region").items()}
    leaves = {r: _winner(key, "shard", w) for r, w in _weights(shards, "shard", "rack").items()}
    df = df.withColumn(region, _winner(key, "region", _weights(shards, "region")))
    df = df.withColumn(rack, _branch(F.col(region), racks))
    return df.withColumn(shard, _branch(F.col(rack), leaves).cast("int"))


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("null:"), F.xxhash64(F.col(text)).cast("string")))


def shard_documents(docs: DataFrame, shards: list[Shard], grown: list[Shard]) -> DataFrame:
    """One row per document: its shard, its gapless slot there, and its shard in the ``grown`` topology."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        document_key().alias("__key"),
    )
    rows = descend(rows, F.col("__key"), shards)
    rows = descend(rows, F.col("__key"), grown, "grown_")
    salt = F.xxhash64("__key", "text_crc32", "size")
    rows = ranked(rows, "shard", ["__key", "text_crc32", "size"], salt, "slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
                       "region", "rack")
