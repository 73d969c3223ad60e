"""Gold machine x hour features.

Plan (SURVEY 4.3): Silver is one fact table tagged by ``sensor_type``, so
the temperature x pressure full outer join becomes one conditional
aggregate per (machine, hour) with map-side partial aggregation.  Hourly
incidents are one more aggregate, left-joined on the same key.  The rolling
features then run as a single window pass over the *hourly* grid (8,760 rows
per machine and year at most), cut into buckets with a halo so that a machine
isn't one task.  Ambient weather (one row per hour) is
broadcast; split thresholds are a scalar subquery over (hour, count) pairs.

All windows are row based over hours that exist (quirk Q4) and lookbacks
include the current hour (quirk Q3), as the reference computes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.operators.chunked import halo_buckets, with_row_index

ROLLING_HOURS = (6, 12, 24)
LABEL_HOURS = (6, 12, 24, 48)
LOOKBACK_HOURS = 168
BUCKET_HOURS = 4096  # hours of a machine that one window partition holds, without its halo
# Fixed values that must equal the reference for right results.
SPLIT_QUANTILES = (0.70, 0.85)
ZSCORE_CLIP = 10.0


def hourly_sensor_features(silver: DataFrame, machine: str = "machine_id_std", ts: str = "event_ts") -> DataFrame:
    """A01 + A02 + J01 as one aggregate over the unified Silver sensor table."""
    s = silver.where(F.col(machine).isNotNull() & F.col(ts).isNotNull() & F.col("sensor_value").isNotNull())
    s = s.withColumn("window_start", X.hour_floor(ts))
    v = F.col("sensor_value")
    aggs = []
    for prefix, kind in (("temp", "temperature"), ("pressure", "pressure")):
        is_kind = F.col("sensor_type") == kind
        aggs += [
            F.avg(F.when(is_kind, v)).alias(f"{prefix}_mean_1h"),
            F.max(F.when(is_kind, v)).alias(f"{prefix}_max_1h"),
            F.sum(F.when(is_kind, F.col("is_missing").cast("int"))).alias(f"{prefix}_missing_count"),
        ]
    return s.groupBy(machine, "window_start").agg(*aggs)


def hourly_incident_features(incidents: DataFrame, machine: str = "machine_id_std", ts: str = "event_ts") -> DataFrame:
    """A03 + A04: incident count, max severity and the nine type sums per hour."""
    i = incidents.where(F.col(machine).isNotNull() & F.col(ts).isNotNull())
    i = i.withColumn("window_start", X.hour_floor(ts))
    return i.groupBy(machine, "window_start").agg(
        F.count("incident_id").alias("incident_count_1h"),
        F.max("severity").alias("incident_max_severity_1h"),
        *[F.sum(c).cast("bigint").alias(c) for c in X.INCIDENT_TYPE_COLUMNS],
    )


def rolling_features(hourly: DataFrame, machine: str = "machine_id_std", include_current: bool = True,
                     time_based: bool = False, bucket_hours: int = BUCKET_HOURS) -> DataFrame:
    """W01-W10 in one window pass, ordered by hour.

    Frames count hours that exist (row frames, quirk Q4) by default;
    ``time_based=True`` uses range frames over the hour number instead, so a
    "24h" window never reaches past a gap.  ``include_current=False`` moves
    lookbacks to the previous hours and labels to the next hours (Q3).

    A machine's hours are cut into buckets of ``bucket_hours`` (of its rows, or
    of hours when time based) with a halo as long as the longest frames, so the
    windows run per (machine, bucket) and one machine spreads over many tasks.
    The one unbounded frame, the last incident, is carried from bucket to
    bucket by a summary of one row per bucket.
    """
    added = {**_sensor_windows(machine, time_based), **_incident_windows(machine, include_current, time_based)}
    clash = [c for c in hourly.columns if c.startswith("__w_")]
    if clash:
        raise ValueError(f"column names in use: {clash}")
    at = X.ordinal_hours("window_start").cast("bigint").alias("__w_hour")
    rows = hourly.select("*", at)
    if time_based:
        rows = rows.withColumn("__w_at", F.col("__w_hour"))
    else:
        rows = rows.withColumn("__w_chunk", F.floor(F.col("__w_hour") / bucket_hours))
        rows = with_row_index(rows, [machine], "__w_chunk", ["__w_hour"], "__w_at")
    rows = halo_buckets(rows, "__w_at", bucket_hours, LOOKBACK_HOURS - 1, max(LABEL_HOURS), bucket="__w_bucket", home="__w_home")

    happened = F.when(F.col("incident_count_1h") > 0, F.col("window_start"))
    last = rows.where("__w_home").groupBy(F.col(machine).alias("__w_machine"), F.col("__w_bucket").alias("__w_in")).agg(F.max(happened).alias("__w_last"))
    before = Window.partitionBy("__w_machine").orderBy("__w_in").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("__w_machine", "__w_in", F.max("__w_last").over(before).alias("__w_carried"))

    out = rows.withColumns(added).where("__w_home")
    out = out.join(carried, F.col(machine).eqNullSafe(F.col("__w_machine")) & (F.col("__w_bucket") == F.col("__w_in")))
    last_incident = F.coalesce(F.col("__w_last_incident"), F.col("__w_carried"))
    hours = (F.unix_seconds(F.col("window_start").cast("timestamp")) - F.unix_seconds(last_incident.cast("timestamp"))) / F.lit(3600.0)
    zscore = X.safe_ratio_clipped(F.col("temp_mean_1h") - F.col("temp_mean_24h"), F.col("temp_std_24h"), -ZSCORE_CLIP, ZSCORE_CLIP)
    out = out.withColumns({"window_end": X.plus_hours("window_start", 1), "temp_zscore_24h": zscore, "hours_since_last_incident": hours})
    return out.drop(*[c for c in out.columns if c.startswith("__w_")])


def _frames(machine: str, time_based: bool):
    """(window over a machine's bucket, frame from a to b hours around the row)."""
    w = Window.partitionBy(machine, "__w_bucket").orderBy("__w_hour")
    return w, (w.rangeBetween if time_based else w.rowsBetween)


def _sensor_windows(machine: str, time_based: bool) -> dict[str, Column]:
    """W01-W04."""
    w, frame = _frames(machine, time_based)
    cols: dict[str, Column] = {}
    for h in ROLLING_HOURS:
        for p in ("temp", "pressure"):
            cols[f"{p}_mean_{h}h"] = F.avg(f"{p}_mean_1h").over(frame(-(h - 1), 0))
            cols[f"{p}_max_{h}h"] = F.max(f"{p}_max_1h").over(frame(-(h - 1), 0))
            cols[f"{p}_std_{h}h"] = F.stddev_samp(f"{p}_mean_1h").over(frame(-(h - 1), 0))
    for p in ("temp", "pressure"):
        before = F.first(f"{p}_mean_1h").over(frame(-6, -6)) if time_based else F.lag(f"{p}_mean_1h", 6).over(w)
        cols[f"{p}_trend_6h"] = F.col(f"{p}_mean_1h") - before
    return cols


def _incident_windows(machine: str, include_current: bool, time_based: bool) -> dict[str, Column]:
    """W06-W10; the reference includes the current hour in lookbacks and labels (Q3)."""
    w, frame = _frames(machine, time_based)
    end, start = (0, 0) if include_current else (-1, 1)
    cnt = F.col("incident_count_1h")
    whole = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    cols = {
        "incident_count_prev_24h": whole(F.sum(cnt).over(frame(-23, end))),
        "incident_max_severity_prev_24h": F.max("incident_max_severity_1h").over(frame(-23, end)),
        "incident_count_prev_7d": whole(F.sum(cnt).over(frame(-(LOOKBACK_HOURS - 1), end))),
        **{f"{c}_count_prev_24h": whole(F.sum(c).over(frame(-23, end))) for c in X.INCIDENT_TYPE_COLUMNS},
        # the last incident hour in the bucket and its halo
        "__w_last_incident": F.last(F.when(cnt > 0, F.col("window_start")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, end)),
    }
    for h in LABEL_HOURS:
        future = F.sum(cnt).over(frame(start, start + h - 1))
        cols[f"future_incident_count_{h}h"] = whole(future)
        cols[f"label_failure_next_{h}h"] = F.coalesce(future > 0, F.lit(False))
    return cols


def split_thresholds(hourly: DataFrame) -> DataFrame:
    """0.70 / 0.85 linear quantiles of ``window_start`` over all rows.

    Aggregated to (hour, rows) first, so the percentile state is bounded by
    the number of distinct hours, then a frequency-weighted percentile.
    """
    per_hour = hourly.groupBy("window_start").agg(F.count(F.lit(1)).alias("_n"))
    us = F.unix_micros(F.col("window_start").cast("timestamp"))
    q = F.percentile(us, F.array(*[F.lit(p) for p in SPLIT_QUANTILES]), F.col("_n"))
    return per_hour.agg(q.alias("_q")).select(
        F.col("_q")[0].alias("split_q70_us"), F.col("_q")[1].alias("split_q85_us")
    )


def temporal_split(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Train / validation / test by the global quantile thresholds."""
    q70 = thresholds.select("split_q70_us").scalar()
    q85 = thresholds.select("split_q85_us").scalar()
    us = F.unix_micros(F.col("window_start").cast("timestamp"))
    return df.withColumn(
        "split_set",
        F.when(us < q70, F.lit("train")).when(us < q85, F.lit("validation")).otherwise(F.lit("test")),
    )


def weather_hourly_for_join(weather: DataFrame) -> DataFrame:
    """J04 right side: floor to the hour, first row per hour."""
    from forgeline.operators.dedup import keep_one_per_key

    w = weather.withColumn("window_start", X.hour_floor("observed_at"))
    kept = ["observed_at", "temp_celsius", "humidity_pct", "pressure_hpa"]
    w = keep_one_per_key(w.select("window_start", *kept), ["window_start"], [F.col(c) for c in kept], keep="first")
    return w.select(
        "window_start",
        F.col("temp_celsius").cast("double").alias("ambient_temp_c"),
        F.col("humidity_pct").cast("double").alias("ambient_humidity_pct"),
        F.col("pressure_hpa").cast("double").alias("ambient_pressure_hpa"),
    )


def build_gold(
    silver_sensors: DataFrame,
    silver_incidents: DataFrame,
    weather: DataFrame | None = None,
    machine: str = "machine_id_std",
    include_current: bool = True,
    time_based: bool = False,
    bucket_hours: int = BUCKET_HOURS,
) -> DataFrame:
    """The full Gold feature table (all intermediate columns kept)."""
    hourly = hourly_sensor_features(silver_sensors, machine)
    inc = hourly_incident_features(silver_incidents, machine)
    joined = hourly.join(inc, [machine, "window_start"], "left").withColumn(
        "incident_count_1h", F.coalesce(F.col("incident_count_1h"), F.lit(0)).cast("bigint")
    )
    for c in X.INCIDENT_TYPE_COLUMNS:
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("bigint"))
    gold = rolling_features(joined, machine, include_current, time_based, bucket_hours)
    if weather is not None:
        # one row per hour of the covered span (bounded by time, not data
        # volume); no hint: AQE broadcasts it from the measured size of the
        # deduplicated side and keeps a shuffle join for very long spans
        gold = gold.join(weather_hourly_for_join(weather), "window_start", "left")
    else:
        gold = gold.withColumns({
            "ambient_temp_c": F.lit(None).cast("double"),
            "ambient_humidity_pct": F.lit(None).cast("double"),
            "ambient_pressure_hpa": F.lit(None).cast("double"),
        })
    return temporal_split(gold, split_thresholds(hourly))


def dropped_incident_hours(silver_sensors: DataFrame, silver_incidents: DataFrame,
                           machine: str = "machine_id_std") -> DataFrame:
    """Incident hours without any sensor row: the Gold left join drops them (quirk Q5).

    Returned in the data-quality issue layout so the loss is reported.
    """
    hourly = hourly_sensor_features(silver_sensors, machine).select(machine, "window_start")
    inc = hourly_incident_features(silver_incidents, machine)
    lost = inc.join(hourly, [machine, "window_start"], "left_anti")
    return lost.select(
        F.lit("gold_machine_hourly_feature").alias("dataset_name"),
        F.lit("incident_hour_without_sensor_row").alias("rule_code"),
        F.lit("warning").alias("severity"),
        F.concat_ws("|", F.col(machine), F.col("window_start").cast("string")).alias("entity_key"),
        F.concat(F.lit("incidents="), F.col("incident_count_1h").cast("string")).alias("details"),
    )


GOLD_DECIMALS = {
    "(12,3)": [f"{p}_{s}_{h}h" for p in ("temp", "pressure") for s in ("mean", "max", "std") for h in ROLLING_HOURS]
    + ["temp_trend_6h", "pressure_trend_6h"],
    "(8,4)": ["temp_zscore_24h"],
    "(10,2)": ["hours_since_last_incident"],
    "(8,2)": ["ambient_temp_c", "ambient_pressure_hpa"],
    "(5,2)": ["ambient_humidity_pct"],
}


def gold_table(gold: DataFrame, machine_dim: DataFrame | None = None) -> DataFrame:
    """The persisted Gold column subset with storage types (P25)."""
    cols: list[Column] = [F.col("machine_id_std"), F.col("window_start"), F.col("window_end")]
    for prec, names in GOLD_DECIMALS.items():
        cols += [F.col(n).cast(f"decimal{prec}").alias(n) for n in names]
    cols += [
        F.col("incident_count_prev_24h").cast("int").alias("incident_count_prev_24h"),
        F.col("incident_max_severity_prev_24h").cast("short").alias("incident_max_severity_prev_24h"),
        F.col("incident_count_prev_7d").cast("int").alias("incident_count_prev_7d"),
    ]
    cols += [F.col(f"{c}_count_prev_24h").cast("int").alias(f"{c}_count_prev_24h") for c in X.INCIDENT_TYPE_COLUMNS]
    cols += [F.col(f"label_failure_next_{h}h") for h in LABEL_HOURS] + [F.col("split_set")]
    out = gold.select(*cols)
    if machine_dim is not None:
        out = out.join(machine_dim.select("machine_code", "machine_id"), F.col("machine_id_std") == F.col("machine_code"))
        out = out.drop("machine_code")
    return out
