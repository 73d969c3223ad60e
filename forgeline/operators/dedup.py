"""Dedup and conflict resolution.

All resolutions are ``groupBy`` aggregates with map-side partial
aggregation, so a hot key is pre-aggregated in every task before the
shuffle; nothing is collected per group.  U01 reads its input once and joins
nothing: one aggregate by key resolves single rows and groups alike.  Where
hardly any key is repeated, ``filter_bits`` saves the shuffle of single rows:
repeated keys are found by an eight-byte hash, a Bloom filter of them is built,
and rows that it doesn't contain pass through (its false positives are groups of
one in the aggregate); that reads the input three times, twice in part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 21  # a quarter of a megabyte: 100,000 repeated keys make it contain 1 % of the others; a size for ``filter_bits``
PROVENANCE_COLUMNS = ("row_number", "ingestion_batch_id", "source_file")


def row_order(df: DataFrame) -> list[str]:
    """Columns that order rows as read: row numbers restart in every file of a source."""
    return [c for c in ("source_file", "row_number") if c in df.columns]


def _all_equal(cols: list[str], n: Column) -> Column:
    """NULL-safe 'every row of the group has the same value' for each column."""
    checks = [
        F.min(c).eqNullSafe(F.max(c)) & ((F.count(c) == 0) | (F.count(c) == n)) for c in cols
    ]
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def dedup_sensor(
    df: DataFrame,
    value: str,
    keys: tuple[str, ...] = ("machine_id_std", "event_ts"),
    order: list[str] | None = None,
    compare: list[str] | None = None,
    filter_bits: int | None = None,
) -> DataFrame:
    """One row per key.

    ``unique`` (single row), ``strict_duplicate_drop`` (all compared columns
    equal, NULL = NULL), ``all_missing_keep_first`` (no value),
    ``keep_non_missing_value`` (one distinct value), else
    ``median_conflict_resolution``.  Other columns come from the first row in
    ``order`` (source file and row number).  Adds ``is_duplicate``, ``dedupe_resolution``, ``records_in_group``.
    """
    others = [c for c in df.columns if c not in keys]
    if compare is None:
        compare = [c for c in others if c not in PROVENANCE_COLUMNS]
    order = order or row_order(df)
    v = F.col(value)
    n = F.count(F.lit(1))
    rows = df
    if filter_bits:
        key_hash = F.xxhash64(*keys)
        often = in_filter(key_hash, repeated_filter(df, key_hash, filter_bits), filter_bits)
        rows = df.where(often)
    g = rows.groupBy(*keys).agg(
        n.alias("records_in_group"),
        F.count(v).alias("_n_val"),
        F.min(v).alias("_vmin"),
        F.max(v).alias("_vmax"),
        F.percentile(v, 0.5).alias("_vmed"),
        _all_equal(compare, n).alias("_strict"),
        F.min_by(F.struct(*others), F.struct(*order)).alias("_first"),
    )
    resolution = (
        F.when(F.col("records_in_group") == 1, F.lit("unique"))
        .when(F.col("_strict"), F.lit("strict_duplicate_drop"))
        .when(F.col("_n_val") == 0, F.lit("all_missing_keep_first"))
        .when(F.col("_vmin") == F.col("_vmax"), F.lit("keep_non_missing_value"))
        .otherwise(F.lit("median_conflict_resolution"))
    )
    resolved = (
        F.when(F.col("dedupe_resolution").isin("unique", "strict_duplicate_drop"), F.col(f"_first.{value}"))
        .when(F.col("dedupe_resolution") == "all_missing_keep_first", F.lit(None))
        .when(F.col("dedupe_resolution") == "keep_non_missing_value", F.col("_vmin"))
        .otherwise(F.col("_vmed"))
    )
    out = g.withColumn("dedupe_resolution", resolution).withColumn("_resolved", resolved)
    cols = [F.col(k) for k in keys] + [
        (F.col("_resolved").cast(df.schema[value].dataType) if c == value else F.col(f"_first.{c}")).alias(c)
        for c in others
    ]
    out = out.select(*cols, (F.col("records_in_group") > 1).alias("is_duplicate"), "dedupe_resolution", "records_in_group")
    if not filter_bits:
        return out
    single = df.where(~often).select(
        *keys, *others, F.lit(False).alias("is_duplicate"), F.lit("unique").alias("dedupe_resolution"), F.lit(1).cast("long").alias("records_in_group"))
    return single.unionByName(out)


def repeated_filter(df: DataFrame, key_hash: Column, bits: int) -> Column:
    """A Bloom filter (array of longs, ``bits`` bits) of the key hashes that occur more than once, as a scalar.

    Its size is fixed: with more repeated keys than it can tell apart it
    contains more single rows, which costs their shuffle and changes no result.
    """
    repeated = df.select(key_hash.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    places = repeated.select(F.explode(F.array(*_places(F.col("_h"), bits))).alias("_at"))
    words = places.groupBy(F.shiftright("_at", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_at & 63 as int))")).alias("_bits"))
    every = df.sparkSession.range(bits // 64).select(F.col("id").alias("_word")).join(words, "_word", "left")
    dense = F.array_sort(F.collect_list(F.struct("_word", F.coalesce("_bits", F.lit(0).cast("long")).alias("_bits"))))
    return every.agg(F.transform(dense, lambda w: w["_bits"]).alias("_filter")).scalar()


def _places(key_hash: Column, bits: int) -> list[Column]:
    """The two positions of a key in a filter."""
    return [F.pmod(key_hash, F.lit(bits)).cast("long"), F.pmod(F.shiftrightunsigned(key_hash, 32), F.lit(bits)).cast("long")]


def in_filter(key_hash: Column, words: Column, bits: int) -> Column:
    """Whether the filter contains the key."""
    return reduce(Column.__and__, [F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(63).cast("int")) == 1 for at in _places(key_hash, bits)])


def dedup_incidents(df: DataFrame, key: str = "incident_id", order: list[str] | None = None) -> DataFrame:
    """Keep the row with the most non-NULL columns, the first one on ties."""
    order = order or row_order(df)
    others = [c for c in df.columns if c != key]
    business = [c for c in df.columns if c not in PROVENANCE_COLUMNS]
    non_null = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in business])
    g = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("records_in_group"),
        F.min_by(F.struct(*others), F.struct(-non_null, *order)).alias("_best"),
    )
    n_c = F.col("records_in_group")
    return g.select(
        key,
        *[F.col(f"_best.{c}").alias(c) for c in others],
        (n_c > 1).alias("is_duplicate"),
        F.when(n_c > 1, F.lit("keep_most_complete_row")).otherwise(F.lit("unique")).alias("dedupe_resolution"),
        "records_in_group",
    )


def dedup_decisions(
    deduped: DataFrame, dataset_name: str, keys: list[str], value: str | None = None
) -> DataFrame:
    """Decision log rows for keys that had more than one record."""
    resolved = F.col(value).cast("double") if value else F.lit(None).cast("double")
    return deduped.where("records_in_group > 1").select(
        F.lit(dataset_name).alias("dataset_name"),
        *keys,
        "records_in_group",
        F.col("dedupe_resolution").alias("resolution"),
        resolved.alias("resolved_value"),
    )


def keep_one_per_key(df: DataFrame, keys: list[str], order: list[Column], keep: str = "first") -> DataFrame:
    """Keep the first (or last) row per key by ``order``, as one aggregate."""
    others = [c for c in df.columns if c not in keys]
    pick = F.min_by if keep == "first" else F.max_by
    g = df.groupBy(*keys).agg(pick(F.struct(*others), F.struct(*order)).alias("_row"))
    return g.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])
