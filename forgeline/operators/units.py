"""Unit normalisation: Fahrenheit window detection.

Some temperature exports switch to Fahrenheit for a while.  A reading is
*suspected* when it looks like Fahrenheit next to the machine's usual level;
a run of at least three consecutive suspected readings (no gap over two
hours, no normal reading in between) is converted to Celsius.

Plan: per-machine baseline (one aggregate, joined back), then one pass over
(machine, time chunk) partitions.  Whether a reading is in a run of three shows
in the two rows before and after it, and rows of one run lie within two hours of
each other, so readings within four hours of a chunk's edge are copied into the
neighbouring chunk and every chunk decides alone: raw rows are shuffled and
sorted once and joined with nothing per run.  Runs that cross chunks are put
together from one summary per run and chunk (points, sums, first and last time).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.functions.expr import fahrenheit_to_celsius
from forgeline.functions.quantiles import exact_quantiles
from forgeline.operators.dedup import row_order
from forgeline.operators.chunked import chunk_of

# Fixed values that must equal the reference for right results.
BASELINE_RANGE = (10.0, 80.0)
FAHRENHEIT_RAW_RANGE = (80.0, 180.0)
CONVERTED_RANGE = (10.0, 80.0)
MARGIN = 3.0
MAX_GAP_SECONDS = 2 * 3600
MIN_RUN = 3


def machine_baseline(df: DataFrame, value: str = "temperature", group: str = "machine_id_std") -> DataFrame:
    """Median of values in 10..80, else median of all values, per machine."""
    v = F.col(value)
    rows = df.where(F.col(group).isNotNull() & v.isNotNull()).select(F.col(group).alias("machine"), F.coalesce(v.between(*BASELINE_RANGE), F.lit(False)).alias("usual"), v.alias("v"))
    of = lambda usual: F.struct(F.col("machine").alias(group), F.lit(usual).alias("usual"))
    medians = exact_quantiles(rows, "v", [0.5], ["machine", "usual"], into=F.when(F.col("usual"), F.array(of(True), of(False))).otherwise(F.array(of(False))))
    return medians.groupBy(group).agg(F.max_by("q0", "usual").alias("baseline_celsius"))


def normalize_temperature_units(
    df: DataFrame,
    value: str = "temperature",
    group: str = "machine_id_std",
    ts: str = "event_ts",
    order: list[str] | None = None,
    chunk_unit: str = "day",
    materialize_fn=None,
) -> tuple[DataFrame, DataFrame]:
    """Returns (rows with ``temperature_normalized`` etc., A06 window summary).

    Output columns added: ``temperature_original``, ``temperature_normalized``,
    ``detected_unit`` ('C'/'F') and ``normalization_rule``.  Rows with a NULL
    machine pass through unchanged (trap T9); rows without a time form runs of
    their own.  A caller that needs both outputs can have the flagged rows
    stored once (``materialize_fn``); neither output needs it.
    """
    out = flagged_readings(df, value, group, ts, order, chunk_unit)
    raw, in_run = F.col(value), F.col("__w11_converted")
    out = (
        out.withColumn("temperature_original", raw)
        .withColumn("temperature_normalized", F.when(in_run, fahrenheit_to_celsius(raw)).otherwise(raw))
        .withColumn("detected_unit", F.when(in_run, F.lit("F")).otherwise(F.lit("C")))
        .withColumn("normalization_rule", F.when(in_run, F.lit("fahrenheit_window_to_celsius")).otherwise(F.lit("identity")))
    )
    if materialize_fn is not None:
        out = materialize_fn(out)
    return out.drop(*[c for c in out.columns if c.startswith("__w11_")]), unit_window_summary(out, value, group, ts)


def suspected(value: str, baseline: Column) -> Column:
    """The reading looks like Fahrenheit next to the machine's usual level."""
    raw, conv = F.col(value), fahrenheit_to_celsius(F.col(value))
    looks = raw.between(*FAHRENHEIT_RAW_RANGE) & conv.between(*CONVERTED_RANGE) & ((F.abs(conv - baseline) + MARGIN) < F.abs(raw - baseline))
    return F.coalesce(looks, F.lit(False))


def flagged_readings(df: DataFrame, value: str, group: str, ts: str, order: list[str] | None, chunk_unit: str) -> DataFrame:
    """The rows with ``__w11_baseline``, ``__w11_chunk``, ``__w11_converted`` and ``__w11_run``.

    ``__w11_run`` numbers the converted runs that begin in a chunk from 1; 0 is
    the run that goes on from the chunk before.
    """
    base = machine_baseline(df, value, group).select(F.col(group).alias("__w11_machine"), F.col("baseline_celsius").alias("__w11_baseline"))
    # one row a machine: joined by a shuffle, a machine's readings would be sorted in one task
    rows = df.join(F.broadcast(base), F.col(group) == F.col("__w11_machine"), "left").drop("__w11_machine")
    home = chunk_of(ts, chunk_unit)
    reach = F.expr(f"INTERVAL {(MIN_RUN - 1) * MAX_GAP_SECONDS + MIN_RUN} SECOND")  # whole seconds count: one more a row
    near = F.sequence(chunk_of(F.col(ts) - reach, chunk_unit), chunk_of(F.col(ts) + reach, chunk_unit), F.expr(f"INTERVAL 1 {chunk_unit}"))
    rows = rows.withColumn("__w11_suspected", suspected(value, F.col("__w11_baseline")))
    rows = rows.select("*", F.explode_outer(near).alias("__w11_chunk")).withColumn("__w11_home", F.col("__w11_chunk").eqNullSafe(home))

    w = Window.partitionBy(group, "__w11_chunk").orderBy(ts, *(order or row_order(df)))
    gap = _seconds(F.col(ts)) - _seconds(F.lag(ts).over(w))
    linked = F.col("__w11_suspected") & F.coalesce(F.lag("__w11_suspected").over(w), F.lit(False)) & (F.coalesce(gap, F.lit(0)) <= MAX_GAP_SECONDS)
    rows = rows.withColumn("__w11_linked", linked & F.col(group).isNotNull())

    # a run of MIN_RUN rows that holds this row starts MIN_RUN - 1 rows back at most
    at = {k: F.coalesce((F.lag if k < 0 else F.lead)("__w11_linked", abs(k)).over(w), F.lit(False)) if k else F.col("__w11_linked") for k in range(2 - MIN_RUN, MIN_RUN)}
    runs = [reduce(Column.__and__, [at[k] for k in range(first + 1, first + MIN_RUN)]) for first in range(1 - MIN_RUN, 1)]
    rows = rows.withColumn("__w11_converted", reduce(Column.__or__, runs))
    begins = F.col("__w11_home") & F.col("__w11_converted") & ~F.col("__w11_linked")
    rows = rows.withColumn("__w11_run", F.sum(begins.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.where("__w11_home").drop("__w11_home", "__w11_suspected", "__w11_linked")


def unit_window_summary(flagged: DataFrame, value: str, group: str, ts: str) -> DataFrame:
    """One row per converted run.

    A run's rows are summed per chunk first; a run that goes on from the chunk
    before belongs to the last one that began earlier, which one small window
    over (machine, chunk) rows finds.
    """
    celsius = fahrenheit_to_celsius(F.col(value))
    parts = flagged.where("__w11_converted").groupBy(group, "__w11_chunk", "__w11_run").agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).alias("points"),
        F.sum(value).alias("raw"), F.sum(celsius).alias("celsius"), F.first("__w11_baseline").alias("baseline"))
    begun = parts.groupBy(F.col(group).alias("in_group"), F.col("__w11_chunk").alias("in_chunk")).agg(F.max("__w11_run").alias("runs"))
    earlier = Window.partitionBy("in_group").orderBy("in_chunk").rowsBetween(Window.unboundedPreceding, -1)
    last_run = F.last(F.when(F.col("runs") > 0, F.struct("in_chunk", "runs")), ignorenulls=True).over(earlier)
    begun = begun.withColumn("going_on", last_run)
    same = (F.col(group) == F.col("in_group")) & F.col("__w11_chunk").eqNullSafe(F.col("in_chunk"))
    own = F.struct(F.col("__w11_chunk").alias("in_chunk"), F.col("__w11_run").alias("runs"))
    run = F.when(F.col("__w11_run") > 0, own).otherwise(F.col("going_on"))
    return parts.join(begun, same).groupBy(group, run.alias("run")).agg(
        F.min("start").alias("window_start"), F.max("end").alias("window_end"), F.sum("points").alias("points_converted"),
        (F.sum("raw") / F.sum("points")).alias("raw_mean"), (F.sum("celsius") / F.sum("points")).alias("converted_mean_celsius"),
        F.first("baseline").alias("baseline_celsius")).drop("run")


def _seconds(c: Column) -> Column:
    return F.unix_seconds(c.cast("timestamp"))
