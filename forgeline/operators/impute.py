"""Imputation benchmark and application.

The benchmark hides a share of the observed values, fills them with each
candidate method and scores the candidates against the hidden truth.  All
candidates are columns of one frame; the metrics are one ``groupBy`` over a
stacked (method, prediction) view.  The only value that reaches the driver
is the chosen method name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.functions.quantiles import exact_quantiles
from forgeline.session import materialize

METHODS = ("mean", "median", "iterative")
METRIC_ORDER = ("out_of_range_rate", "rmse", "mae", "distribution_drift", "medae")


@dataclass(frozen=True)
class ImputationContext:
    dataset_name: str
    target: str
    group: str = "machine_id_std"
    time: str = "event_ts"
    plausible_min: float | None = None
    plausible_max: float | None = None
    mask_fraction: float = 0.1
    seed: int = 42
    estimator: str = "bayesian_ridge"  # of the iterative candidate; "least_squares" is the form that SQL can check


# W14 ---------------------------------------------------------------------
def hash_unit(cols: list[str], seed: int) -> Column:
    """Deterministic uniform number in [0, 1) from key columns (xxhash64)."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])
    return F.pmod(h, F.lit(1_000_000)).cast("double") / F.lit(1_000_000.0)


def arithmetic_hash_unit(ts: str, group_number: Column) -> Column:
    """Engine-neutral hash in [0, 1) for oracle checks: same value in DuckDB."""
    hours = X.ordinal_hours(ts)
    return F.pmod(hours * F.lit(2654435761) + group_number * F.lit(40503), F.lit(1000003)).cast("double") / F.lit(1000003.0)


HASH_BUCKETS = 1 << 20


def mask_observed(df: DataFrame, ctx: ImputationContext, u: Column | None = None) -> DataFrame:
    """Hide ``k = min(n, max(10, int(fraction * n)))`` observed values, chosen by key hash.

    The reference draws the k rows with a seeded RNG.  Here the k observed
    rows with the smallest hash (ties broken by key) are masked, found
    without a global sort: rows are counted per hash bucket (at most 2^20
    bucket rows), a running total over the buckets finds the bucket holding
    the k-th row, and only that one bucket is ranked row by row, which gives
    the k-th (hash, key).  Every observed row up to it is masked, so the rows
    themselves are neither joined nor shuffled.
    """
    if u is None:
        u = hash_unit([ctx.group, ctx.time], ctx.seed)
    observed = F.col(ctx.target).isNotNull()
    keys = [ctx.group, ctx.time]
    d = df.withColumn("_u", u).withColumn("_b", F.floor(F.col("_u") * HASH_BUCKETS).cast("bigint"))
    obs = d.where(observed & F.col("_u").isNotNull())
    per_bucket = obs.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    # one row per non-empty bucket (at most 2^20): the running total is a small single-partition window
    w = Window.orderBy("_b")
    running = per_bucket.select(
        "_b", "_n", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"),
        F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"))
    k = F.least(F.col("_all"), F.greatest(F.lit(10), F.floor(F.col("_all") * F.lit(ctx.mask_fraction)).cast("bigint")))
    cut = running.where(F.col("_cum") >= k).agg(
        F.min_by(F.struct(F.col("_b").alias("bucket"), (k - F.col("_cum") + F.col("_n")).alias("rest")), F.col("_b")).alias("c")).scalar()
    place = F.struct("_u", *keys)
    edge = obs.where(F.col("_b") == cut.getField("bucket")).select(
        place.alias("_at"), F.row_number().over(Window.partitionBy("_b").orderBy("_u", *keys)).alias("_r"))
    last = edge.where(F.col("_r") == cut.getField("rest")).agg(F.max("_at")).scalar()
    masked = F.coalesce(observed & F.col("_u").isNotNull() & (place <= last), F.lit(False))
    return d.withColumn("is_masked", masked).withColumn(
        "_bench_value", F.when(F.col("is_masked"), F.lit(None).cast("double")).otherwise(F.col(ctx.target))
    ).drop("_u", "_b")


# A07 / A08 ---------------------------------------------------------------
def group_fill(df: DataFrame, value: str, group: str, strategy: str, out: str) -> DataFrame:
    """``coalesce(value, group statistic, global statistic)``.

    Group statistics are an aggregate joined back (small side: one row per
    machine, broadcast, as a shuffle would put a machine's rows into one task);
    the global fallback is a scalar subquery.
    Medians come from the distributed exact quantiles.
    """
    if strategy == "mean":
        stats = df.groupBy(group).agg(F.avg(value).alias(f"_{out}_g"))
        global_stat = df.agg(F.avg(value)).scalar()
    elif strategy == "median":
        # every value counts for its group and for all
        both = F.array(F.struct(F.lit(False).alias("all"), F.col("g")), F.struct(F.lit(True).alias("all"), F.lit(None).cast(df.schema[group].dataType).alias("g")))
        medians = materialize(exact_quantiles(df.select(F.col(value).alias("v"), F.col(group).alias("g")), "v", [0.5], ["g"], into=both), "medians")
        stats = medians.where("not all").select(F.col("g").alias(group), F.col("q0").alias(f"_{out}_g"))
        global_stat = medians.where("all").select("q0").scalar()
    else:
        raise ValueError(f"unsupported strategy {strategy}")
    return df.join(F.broadcast(stats), group, "left").withColumn(
        out, F.coalesce(F.col(value), F.col(f"_{out}_g"), global_stat)
    ).drop(f"_{out}_g")


def candidate_columns(masked: DataFrame, ctx: ImputationContext, methods=METHODS) -> DataFrame:
    out = masked
    for m in methods:
        if m in ("mean", "median"):
            out = group_fill(out, "_bench_value", ctx.group, m, f"_cand_{m}")
        elif m == "iterative":
            from forgeline.operators.regression import FILLS

            out = FILLS[ctx.estimator](out, "_bench_value", ctx.group, ctx.time, "_cand_iterative")
        else:
            raise ValueError(m)
    return out


def benchmark_metrics(cands: DataFrame, ctx: ImputationContext, methods=METHODS,
                      observed: DataFrame | None = None) -> DataFrame:
    """A09-A11 per method: one wide aggregate, and one pass for all medians.

    Only filled values differ between methods, so an observed value is read
    once: it counts for the medians of all methods, and moments of observed
    and of filled values are put together.  ``observed`` (default ``cands``)
    supplies the original values.
    """
    truth, hidden = F.col(ctx.target), F.col("is_masked")
    bounded = ctx.plausible_min is not None and ctx.plausible_max is not None
    out = (lambda v: (~X.in_range(v, ctx.plausible_min, ctx.plausible_max)).cast("long")) if bounded else (lambda v: F.lit(0).cast("long"))
    wide = [F.count(F.lit(1)).alias("rows"), F.count_if(hidden).alias("masked_rows"), F.sum(F.when(truth.isNotNull(), out(truth))).alias("out_observed")]
    for m in methods:
        pred = F.col(f"_cand_{m}")
        err, filled = F.when(hidden, pred - truth), F.when(truth.isNull(), pred)
        wide.append(F.struct(
            F.lit(m).alias("method"), F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(err).alias("bias"),
            F.sum(F.when(truth.isNull(), out(pred))).alias("out_filled"), F.count(filled).alias("n"), F.avg(filled).alias("mean"), F.var_pop(filled).alias("var")).alias(f"_of_{m}"))
    scores = cands.agg(*wide).select("rows", "masked_rows", "out_observed", F.explode(F.array(*[f"_of_{m}" for m in methods])).alias("s")).select(
        "rows", "masked_rows", "out_observed", "s.*")

    kind = lambda name, method, v: F.struct(F.lit(name).alias("kind"), F.lit(method).alias("method"), v.alias("v"))
    values = [kind("observed", "", truth)]
    for m in methods:
        pred = F.col(f"_cand_{m}")
        values += [kind("medae", m, F.when(hidden, F.abs(pred - truth))), kind("filled", m, F.when(truth.isNull(), pred))]
    long = cands.select(F.explode(F.filter(F.array(*values), lambda x: x["v"].isNotNull())).alias("x")).select("x.*")
    group = lambda name, method: F.struct(F.lit(name).alias("kind"), method.alias("method"))
    into = F.when(F.col("kind") == "observed", F.array(*[group("filled", F.lit(m)) for m in methods], *[group("observed", F.lit(m)) for m in methods])).otherwise(
        F.array(F.struct("kind", "method")))
    medians = exact_quantiles(long, "v", [0.5], ["kind", "method"], into=into)
    of = lambda name: F.max(F.when(F.col("kind") == name, F.col("q0")))
    by_method = medians.groupBy("method").agg(of("medae").alias("medae"), of("filled").alias("_i_median"), of("observed").alias("_o_median"))

    source = observed if observed is not None else cands
    orig = source.agg(F.struct(F.count(ctx.target).alias("n"), F.avg(ctx.target).alias("mean"), F.stddev_pop(ctx.target).alias("std")).alias("_o")).scalar()
    base = {"mean": orig.getField("mean"), "std": orig.getField("std"), "median": F.col("_o_median")}
    n_o, n_f = orig.getField("n").cast("double"), F.col("n").cast("double")
    mean_o, mean_f = F.coalesce(base["mean"], F.lit(0.0)), F.coalesce("mean", F.lit(0.0))
    n = F.nullif(n_o + n_f, F.lit(0.0))
    mean = (n_o * mean_o + n_f * mean_f) / n
    spread = n_o * (F.coalesce(base["std"] * base["std"], F.lit(0.0)) + (mean_o - mean) * (mean_o - mean)) + n_f * (F.coalesce("var", F.lit(0.0)) + (mean_f - mean) * (mean_f - mean))
    out_rate = (F.coalesce("out_observed", F.lit(0)) + F.coalesce("out_filled", F.lit(0))) / F.nullif(F.col("rows").cast("double"), F.lit(0.0)) if bounded else F.lit(0.0)
    m = scores.join(by_method, "method", "left").withColumns({"_i_mean": mean, "_i_std": F.sqrt(spread / n), "out_of_range_rate": out_rate})
    diffs = [F.abs(F.col(f"_i_{s}") - base[s]) for s in ("mean", "median", "std")]
    n_ok = sum((d.isNotNull().cast("int") for d in diffs[1:]), diffs[0].isNotNull().cast("int"))
    tot = sum((F.coalesce(d, F.lit(0.0)) for d in diffs[1:]), F.coalesce(diffs[0], F.lit(0.0)))
    drift = F.when(n_ok > 0, tot / n_ok)
    return m.select(
        F.lit(ctx.dataset_name).alias("dataset_name"),
        F.lit(ctx.target).alias("target_column"),
        "method",
        F.col("masked_rows").cast("bigint").alias("masked_rows"),
        "mae", "rmse", "medae", "bias", "out_of_range_rate",
        drift.alias("distribution_drift"),
    )


def evaluate_imputation(df: DataFrame, ctx: ImputationContext, methods=METHODS, u: Column | None = None,
                        store: bool = True) -> DataFrame:
    """Mask, fill with each candidate, score.  Fails below 30 observed rows.

    The masked frame is read for every candidate's statistics and the filled
    one for every score, so (with ``store``) their needed columns are written
    to the shared checkpoint folder instead of being computed each time.
    """
    masked = mask_observed(df, ctx, u)
    if store:
        masked = materialize(masked.select(ctx.group, ctx.time, ctx.target, "is_masked", "_bench_value"), "masked")
    n_obs = masked.agg(F.count(ctx.target).alias("_n")).scalar()
    cands = candidate_columns(masked, ctx, methods)
    if store:
        cands = materialize(cands.select(ctx.target, "is_masked", *[f"_cand_{m}" for m in methods]), "candidates")
    metrics = benchmark_metrics(cands, ctx, methods, observed=masked)
    # on the filter, so that no choice of columns prunes the check away
    too_few = F.raise_error(F.lit(f"Not enough observed rows to evaluate {ctx.dataset_name}.{ctx.target}")).cast("boolean")
    return metrics.where(F.when(n_obs < 30, too_few).otherwise(F.lit(True)))


def choose_method(metrics: DataFrame) -> DataFrame:
    """Best method per (dataset, column) by the metric order, with a reason."""
    order = F.struct(*[F.col(c) for c in METRIC_ORDER], F.col("method"))
    best = metrics.groupBy("dataset_name", "target_column").agg(
        F.min_by(F.struct(*[c for c in metrics.columns if c not in ("dataset_name", "target_column")]), order).alias("b")
    )
    return best.select(
        "dataset_name",
        "target_column",
        F.col("b.method").alias("recommended_method"),
        *[F.col(f"b.{c}").alias(c) for c in ("mae", "rmse", "medae", "bias", "out_of_range_rate", "distribution_drift")],
        F.lit("first_by_" + "_".join(METRIC_ORDER)).alias("decision_reason"),
    )


def severity_policy_row(spark) -> DataFrame:
    """The incident severity policy (rule based, never imputed)."""
    return spark.createDataFrame(
        [("releves_incidents", "severity", "rule_based_no_imputation",
          "business_rule_only")],
        "dataset_name string, target_column string, recommended_method string, decision_reason string",
    )


def apply_method(df: DataFrame, value: str, method: str, group: str = "machine_id_std",
                 time: str = "event_ts", sensor_type: str | None = None, unit: str | None = None,
                 estimator: str = "bayesian_ridge") -> DataFrame:
    """Fill missing values with the chosen method, refit on all observed rows (Q2)."""
    if method in ("mean", "median"):
        filled = group_fill(df, value, group, method, "sensor_value")
    elif method == "iterative":
        from forgeline.operators.regression import FILLS

        filled = FILLS[estimator](df, value, group, time, "sensor_value")
    else:
        filled = df.withColumn("sensor_value", F.col(value))
    out = filled.withColumn("is_missing", F.col(value).isNull()).withColumn(
        "was_imputed", F.col(value).isNull() & F.col("sensor_value").isNotNull()
    )
    if sensor_type:
        out = out.withColumn("sensor_type", F.lit(sensor_type))
    if unit:
        out = out.withColumn("unit", F.lit(unit))
    return out
