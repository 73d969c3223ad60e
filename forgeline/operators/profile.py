"""Dataset profiling and anomaly analytics.

Every statistic is an aggregate (map-side combined) or a window over a
bounded axis; per-column statistics are computed on a stacked
(column, value) view so one ``groupBy`` covers all numeric columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.functions.quantiles import exact_quantiles
from forgeline.operators.chunked import chunk_of
from forgeline.operators.dedup import row_order
from forgeline.session import materialize

DERIVED_COLUMNS = ("source_file", "separator", "machine_id_original", "machine_id_std", "event_ts", "row_number")


# S05 / P29 ---------------------------------------------------------------
def enrich(df: DataFrame, source_file: str, separator: str, machine: str | None = "machine_id") -> DataFrame:
    """Provenance + normalised machine + event timestamp, as the notebook loader adds."""
    out = df.withColumn("source_file", F.lit(source_file)).withColumn("separator", F.lit(separator))
    if machine and machine in df.columns:
        out = out.withColumn("machine_id_original", F.col(machine).cast("string")).withColumn(
            "machine_id_std", X.machine_code(machine))
    else:
        out = out.withColumn("machine_id_original", F.lit(None).cast("string")).withColumn(
            "machine_id_std", F.lit(None).cast("string"))
    if "timestamp" in df.columns:
        ts = X.parse_timestamp("timestamp")
    elif "date" in df.columns and "time" in df.columns:
        ts = X.combine_date_time("date", "time")
    elif "date" in df.columns:
        ts = F.col("date").try_cast("timestamp_ntz")
    else:
        ts = F.lit(None).cast("timestamp_ntz")
    return out.withColumn("event_ts", ts)


def business_columns(df: DataFrame) -> list[str]:
    """All columns but the derived ones."""
    return [c for c in df.columns if c not in DERIVED_COLUMNS]


# A13 ---------------------------------------------------------------------
def dataset_overview(df: DataFrame, name: str, business: list[str] | None = None) -> DataFrame:
    """Rows, columns, exact duplicate rows, missing cells, distinct machines, time range."""
    business = business or business_columns(df)
    nulls = [F.col(c).isNull().cast("int") for c in business]
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in business])
    distinct_rows = df.select(*business).distinct().agg(F.count(F.lit(1)).alias("_d"))
    stats = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(reduce(lambda a, b: a + b, nulls)).alias("missing_cells"),
        F.count_if(any_null).alias("rows_with_missing"),
        F.count_distinct("machine_id_original").alias("machines_raw"),
        F.count_distinct("machine_id_std").alias("machines_normalized"),
        F.min("event_ts").alias("start"),
        F.max("event_ts").alias("end"),
    )
    return stats.select(
        F.lit(name).alias("dataset"),
        F.col("rows").cast("bigint").alias("rows"),
        F.lit(len(business)).cast("bigint").alias("columns"),
        (F.col("rows") - distinct_rows.select("_d").scalar()).cast("bigint").alias("duplicates"),
        F.col("missing_cells").cast("bigint").alias("missing_cells"),
        F.col("rows_with_missing").cast("bigint").alias("rows_with_missing"),
        F.col("machines_raw").cast("bigint").alias("machines_raw"),
        F.col("machines_normalized").cast("bigint").alias("machines_normalized"),
        "start", "end",
    )


def _stack(df: DataFrame, cols: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(F.explode(pairs).alias("_p")).select("_p.column", "_p.value")


# A14 ---------------------------------------------------------------------
def numeric_profile(df: DataFrame, name: str, cols: list[str]) -> DataFrame:
    """Per numeric column: missing, min, median, max, mean, population std, IQR fences and alerts."""
    # wide aggregates; only the quantiles' bucket counts see one row per column and cell
    q = exact_quantiles(_stack(df, cols), "value", [0.25, 0.5, 0.75], ["column"])
    q = q.select("column", F.col("q1").alias("median"), (F.col("q0") - 1.5 * (F.col("q2") - F.col("q0"))).alias("iqr_lower"),
                 (F.col("q2") + 1.5 * (F.col("q2") - F.col("q0"))).alias("iqr_upper"))
    q = materialize(q, "quantiles")  # one row per column, read for the fences and for the result
    fences = q.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("iqr_lower", "iqr_upper")))).alias("m")).scalar()  # one entry per column
    v = {c: F.col(c).cast("double") for c in cols}
    fence = lambda c, side: F.element_at(fences, F.lit(c)).getField(side)
    wide = df.agg(*[F.struct(
        F.lit(c).alias("column"), F.count_if(v[c].isNull()).alias("missing"), F.count(v[c]).alias("_n"), F.min(v[c]).alias("min"), F.max(v[c]).alias("max"),
        F.avg(v[c]).alias("mean"), F.stddev_pop(v[c]).alias("std"),
        F.count_if((v[c] < fence(c, "iqr_lower")) | (v[c] > fence(c, "iqr_upper"))).alias("iqr_alerts")).alias(f"_c{i}") for i, c in enumerate(cols)])
    stats = wide.select(F.explode(F.array(*[f"_c{i}" for i in range(len(cols))])).alias("s")).select("s.*").where("_n > 0")
    return stats.join(q, "column").select(F.lit(name).alias("dataset"), "column", "missing", "min", "median", "max", "mean", "std",
                                          "iqr_lower", "iqr_upper", "iqr_alerts")


# A15 ---------------------------------------------------------------------
def machine_id_audit(df: DataFrame, name: str) -> DataFrame:
    return (
        df.where(F.col("machine_id_original").isNotNull())
        .groupBy("machine_id_original", "machine_id_std").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("dataset"), "machine_id_original", "machine_id_std", "rows")
    )


# L03 ---------------------------------------------------------------------
def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """``row_number() <= k`` per group (planned as a WindowGroupLimit)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k).drop("_rk")


# A16 ---------------------------------------------------------------------
def missing_per_column(df: DataFrame, cols: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("missing_values")) for c in cols])
    return counts.select(F.explode(pairs).alias("_p")).select("_p.column", "_p.missing_values")


# A17 / A18 ---------------------------------------------------------------
def daily_resample(df: DataFrame, ts: str, value: str | None) -> DataFrame:
    """Calendar-complete daily axis: mean of ``value`` (NULL on empty days) or row count (0)."""
    d = df.where(F.col(ts).isNotNull()).withColumn("day", F.to_date(ts))
    agg = F.avg(value) if value else F.count(F.lit(1))
    daily = d.groupBy("day").agg(agg.alias("_v"))
    spine = daily.agg(F.min("day").alias("s"), F.max("day").alias("e")).select(
        F.explode(F.sequence("s", "e")).alias("day"))
    out = spine.join(daily, "day", "left")
    v = F.col("_v") if value else F.coalesce(F.col("_v"), F.lit(0)).cast("bigint")
    return out.select("day", v.alias(value or "rows"))


# A19 ---------------------------------------------------------------------
def global_iqr_alerts(df: DataFrame, value: str) -> DataFrame:
    v = df.where(F.col(value).isNotNull())
    q = exact_quantiles(v, value, [0.25, 0.75]).select(F.struct(
        (F.col("q0") - 1.5 * (F.col("q1") - F.col("q0"))).alias("lower"), (F.col("q1") + 1.5 * (F.col("q1") - F.col("q0"))).alias("upper")).alias("f")).scalar()
    lo, hi = q.getField("lower"), q.getField("upper")
    return v.agg(
        F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"),
        F.count_if((F.col(value) < lo) | (F.col(value) > hi)).cast("bigint").alias("alerts"),
    ).select("min", "max", "mean", lo.alias("iqr_lower"), hi.alias("iqr_upper"), "alerts")


# W12 ---------------------------------------------------------------------
def rolling_zscore_alerts(df: DataFrame, value: str = "temperature", group: str = "machine_id_std",
                          ts: str = "event_ts", order: list[str] | None = None, window_rows: int = 168,
                          min_periods: int = 24, threshold: float = 4.0, chunk_unit: str = "month") -> DataFrame:
    """Per machine, 168-row rolling mean / population std (min 24 values); keep |z| > 4.

    Rows are ordered by time, source file and row number.  A machine's rows are
    dealt once, by (machine, time chunk), and the window runs inside a chunk.
    What its first rows need from before it are the last rows of earlier chunks:
    from one count per chunk follows which chunks those are and how many rows
    each must hand on (several chunks, where they hold few rows), and only
    those rows are copied.  Sorting by |z| is left to the caller (L02).
    """
    order = order or row_order(df)
    before = window_rows - 1
    clean = df.where(F.col(group).isNotNull() & F.col(ts).isNotNull() & F.col(value).isNotNull()).select(
        group, ts, *order, value, chunk_of(ts, chunk_unit).alias("_chunk")).where(F.col("_chunk").isNotNull())  # as the join below infers: one exchange
    w = Window.partitionBy(group, "_chunk").orderBy(ts, *order)

    chunks = clean.groupBy(F.col(group).alias("_group"), F.col("_chunk").alias("_from_chunk")).agg(F.count(F.lit(1)).alias("_rows"))
    wc = Window.partitionBy("_group").orderBy("_from_chunk")
    ends = F.sum("_rows").over(wc.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chunks = chunks.withColumn("_ends", ends)
    later = F.collect_list(F.struct(F.col("_from_chunk").alias("chunk"), (F.col("_ends") - F.col("_rows")).alias("starts"))).over(wc.rowsBetween(1, before))
    heirs = F.filter(F.transform(later, lambda c: F.struct(c["chunk"].alias("chunk"), (F.lit(before) - c["starts"] + F.col("_ends")).alias("rows"))), lambda c: c["rows"] > 0)
    chunks = chunks.withColumn("_heirs", heirs).select("_group", "_from_chunk", F.explode("_heirs").alias("_heir"))

    after = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - F.row_number().over(w)
    dealt = clean.repartition(group, "_chunk")  # the one exchange of all rows, for the tails and for the result
    tails = dealt.withColumn("_after", after).where(F.col("_after") < before)
    tails = tails.join(chunks, (F.col(group) == F.col("_group")) & (F.col("_chunk") == F.col("_from_chunk"))).where(F.col("_after") < F.col("_heir.rows"))
    tails = tails.select(group, ts, *order, value, F.col("_heir.chunk").alias("_chunk"), F.lit(False).alias("_home")).repartition(group, "_chunk")
    rows = dealt.withColumn("_home", F.lit(True)).unionByName(tails)  # dealt alike, so the union keeps its rows where they are

    rolling = w.rowsBetween(-before, 0)
    scored = rows.withColumn("_n", F.count(value).over(rolling)).withColumn("_m", F.avg(value).over(rolling)).withColumn(
        "_s", F.stddev_pop(value).over(rolling)).where("_home")
    mean = F.when(F.col("_n") >= min_periods, F.col("_m"))
    std = F.when(F.col("_n") >= min_periods, F.nullif(F.col("_s"), F.lit(0.0)))
    z = (F.col(value) - mean) / std
    return scored.select(
        F.col(group).alias("machine_id"), ts, *order, value,
        mean.alias("rolling_mean"), std.alias("rolling_std"), z.alias("rolling_zscore"), F.abs(z).alias("abs_zscore"),
    ).where(F.col("abs_zscore") > threshold)


# L02 / L04 ---------------------------------------------------------------
def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top-k (TakeOrderedAndProject: each task keeps k rows, bounded)."""
    return df.orderBy(*order).limit(k)


def sample_rows(df: DataFrame, k: int, key: list[str], seed: int = 42, hash_col: Column | None = None) -> DataFrame:
    """Fixed-size sample without replacement: the k smallest hashes of the key."""
    h = hash_col if hash_col is not None else F.xxhash64(F.lit(seed), *[F.col(c) for c in key])
    return df.withColumn("_h", h).orderBy("_h", *key).limit(k).drop("_h")


# J05 / J08 / A21 ---------------------------------------------------------
def common_sensor_frame(temperature: DataFrame, pressure: DataFrame) -> DataFrame:
    t = temperature.select("machine_id_std", "event_ts", "temperature").dropna()
    p = pressure.select("machine_id_std", "event_ts", "pressure_bar").dropna()
    return t.join(p, ["machine_id_std", "event_ts"], "inner")


def common_machines(frames: list[DataFrame]) -> DataFrame:
    sets = [f.where(F.col("machine_id_std").isNotNull()).select("machine_id_std") for f in frames]
    return reduce(DataFrame.intersect, sets)


def coverage_window(overviews: DataFrame) -> DataFrame:
    """Common start = max(start), common end = min(end); NULL when disjoint."""
    w = overviews.agg(F.max("start").alias("s"), F.min("end").alias("e"))
    ok = F.col("s").isNotNull() & F.col("e").isNotNull() & (F.col("e") >= F.col("s"))
    return w.select(
        F.when(ok, F.col("s")).alias("common_start"),
        F.when(ok, F.col("e")).alias("common_end"),
        F.when(ok, (F.unix_seconds(F.col("e").cast("timestamp")) - F.unix_seconds(F.col("s").cast("timestamp"))) / 3600.0)
        .alias("overlap_hours"),
    )
