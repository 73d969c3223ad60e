"""Registered queries: one per operator of SURVEY section 2, plus oracle SQL.

Every query reads the driver tables (through the raw-export views of
``forgeline.sources.fixtures``) and returns a DataFrame.  Computed columns
are aliased identically in the Spark plan and the DuckDB oracle; doubles are
rounded to 6 decimals on both sides and counts are BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.operators import dedup, features, units
from forgeline.plans import layers as L
from forgeline.plans.oracle import FLAGS, oracle
from forgeline.plans.registry import ORACLE, QUERIES, r6, register, s6


# ---------------------------------------------------------------- W11 / A05 / A06
def _t_norm(spark, sf):
    return L.chain(spark, sf).t_normalized()


@register("w11_unit_windows", oracle(
    "select machine_id_std, window_start, window_end, cast(points_converted as bigint) as points_converted, "
    + ", ".join(s6(c, c) for c in ("raw_mean", "converted_mean_celsius", "baseline_celsius"))
    + " from t_windows"))
def q_w11_unit_windows(spark, sf):
    _, win = _t_norm(spark, sf)
    return win.select(
        "machine_id_std", "window_start", "window_end", F.col("points_converted").cast("bigint").alias("points_converted"),
        *[r6(c).alias(c) for c in ("raw_mean", "converted_mean_celsius", "baseline_celsius")],
    )


@register("w11_unit_normalization", oracle(
    "select row_number, machine_id_std, event_ts, round(temperature_original, 6) as temperature_original, "
    "round(temperature_normalized, 6) as temperature_normalized, detected_unit, normalization_rule from t_norm"))
def q_w11_unit_normalization(spark, sf):
    norm, _ = _t_norm(spark, sf)
    return norm.select(
        "row_number", "machine_id_std", "event_ts", r6("temperature_original").alias("temperature_original"),
        r6("temperature_normalized").alias("temperature_normalized"), "detected_unit", "normalization_rule",
    )


@register("a05_machine_baseline", oracle("select machine_id_std, round(baseline_celsius, 6) as baseline_celsius from t_base"))
def q_a05_machine_baseline(spark, sf):
    b = units.machine_baseline(L.chain(spark, sf).t_parsed())
    return b.select("machine_id_std", r6("baseline_celsius").alias("baseline_celsius"))


@register("p16_fahrenheit_to_celsius", oracle(
    "select row_number, round((temperature - 32.0) * 5.0 / 9.0, 6) as celsius from t_parsed where temperature is not null"))
def q_p16(spark, sf):
    p = L.chain(spark, sf).t_parsed().where(F.col("temperature").isNotNull())
    return p.select("row_number", r6(X.fahrenheit_to_celsius("temperature")).alias("celsius"))


# ---------------------------------------------------------------- U01-U03
_DEDUP_OUT = "machine_id_std, event_ts, row_number, {v}, is_duplicate, dedupe_resolution, cast(records_in_group as bigint) as records_in_group"


@register("u01_sensor_dedup", oracle(
    "select " + _DEDUP_OUT.format(v="round(temperature_normalized, 6) as temperature_normalized") + " from t_dedup"))
def q_u01_sensor_dedup(spark, sf):
    d = L.chain(spark, sf).t_deduped()
    return d.select("machine_id_std", "event_ts", "row_number", r6("temperature_normalized").alias("temperature_normalized"),
                    "is_duplicate", "dedupe_resolution", F.col("records_in_group").cast("bigint").alias("records_in_group"))


@register("u01_pressure_dedup", oracle(
    "select " + _DEDUP_OUT.format(v="round(pressure_bar, 6) as pressure_bar") + " from p_dedup"))
def q_u01_pressure_dedup(spark, sf):
    d = L.chain(spark, sf).p_deduped()
    return d.select("machine_id_std", "event_ts", "row_number", r6("pressure_bar").alias("pressure_bar"),
                    "is_duplicate", "dedupe_resolution", F.col("records_in_group").cast("bigint").alias("records_in_group"))


@register("u02_incident_dedup", oracle(
    "select incident_id, row_number, machine_id_std, event_ts, cast(severity as bigint) as severity, is_duplicate, "
    "dedupe_resolution, cast(records_in_group as bigint) as records_in_group from i_dedup"))
def q_u02_incident_dedup(spark, sf):
    d = dedup.dedup_incidents(L.chain(spark, sf).i_parsed())
    return d.select("incident_id", "row_number", "machine_id_std", "event_ts", F.col("severity").cast("bigint").alias("severity"),
                    "is_duplicate", "dedupe_resolution", F.col("records_in_group").cast("bigint").alias("records_in_group"))


@register("u03_dedup_decisions", oracle(
    "select 'capteurs_temperature' as dataset_name, cast(machine_id_std as varchar) || '|' || cast(event_ts as varchar) as entity_key, "
    "cast(records_in_group as bigint) as records_in_group, dedupe_resolution as resolution, "
    "round(temperature_normalized, 6) as resolved_value from t_dedup where records_in_group > 1 "
    "union all select 'capteurs_pression', cast(machine_id_std as varchar) || '|' || cast(event_ts as varchar), "
    "cast(records_in_group as bigint), dedupe_resolution, round(pressure_bar, 6) from p_dedup where records_in_group > 1 "
    "union all select 'releves_incidents', incident_id, cast(records_in_group as bigint), dedupe_resolution, cast(null as double) "
    "from i_dedup where records_in_group > 1"))
def q_u03_dedup_decisions(spark, sf):
    c = L.chain(spark, sf)
    key = F.concat_ws("|", F.col("machine_id_std"), F.col("event_ts").cast("string")).alias("entity_key")
    t = dedup.dedup_decisions(c.t_deduped().withColumn("entity_key", key), "capteurs_temperature",
                              ["entity_key"], "temperature_normalized")
    p = dedup.dedup_decisions(c.p_deduped().withColumn("entity_key", key), "capteurs_pression",
                              ["entity_key"], "pressure_bar")
    i = dedup.dedup_decisions(c.i_silver().withColumn("entity_key", F.col("incident_id")),
                              "releves_incidents", ["entity_key"])
    out = t.unionByName(p).unionByName(i)
    return out.select("dataset_name", "entity_key", F.col("records_in_group").cast("bigint").alias("records_in_group"),
                      "resolution", r6("resolved_value").alias("resolved_value"))


# ---------------------------------------------------------------- Gold
def _gold(spark, sf, weather: bool = False):
    return L.chain(spark, sf).gold(weather)


_ROLL = [f"{p}_{s}_{h}h" for h in (6, 12, 24) for p in ("temp", "pressure") for s in ("mean", "max", "std")]
_INT_COLS = ["incident_count_prev_24h", "incident_max_severity_prev_24h", "incident_count_prev_7d",
             *[f"{f}_count_prev_24h" for f in FLAGS]]


_RAW_INT = {"incident_count_1h", "incident_max_severity_1h", "temp_missing_count", "pressure_missing_count", *FLAGS}


def _gold_cols_spark(cols: list[str]) -> list:
    out = []
    for c in cols:
        if c in _RAW_INT:
            out.append(F.col(c).cast("bigint").alias(c))
        elif c in ("machine_id_std", "window_start", "window_end", "split_set") or c.startswith("label_"):
            out.append(F.col(c))
        elif c in _INT_COLS or c.startswith("future_incident_count"):
            out.append(F.coalesce(F.col(c), F.lit(0) if c != "incident_max_severity_prev_24h" else F.lit(None)).cast("bigint").alias(c))
        else:
            out.append(r6(c).alias(c))
    return out


def _gold_cols_sql(cols: list[str]) -> str:
    out = []
    for c in cols:
        if c in _RAW_INT:
            out.append(f"cast({c} as bigint) as {c}")
        elif c in ("machine_id_std", "window_start", "window_end", "split_set"):
            out.append(c)
        elif c.startswith("label_failure_next_"):
            h = c.rsplit("_", 1)[1]
            out.append(f"coalesce(future_incident_count_{h} > 0, false) as {c}")
        elif c == "incident_max_severity_prev_24h":
            out.append(f"cast({c} as bigint) as {c}")
        elif c in _INT_COLS or c.startswith("future_incident_count"):
            out.append(f"cast(coalesce({c}, 0) as bigint) as {c}")
        elif c == "temp_zscore_24h":
            out.append("round(case when _z is not null then greatest(-10.0, least(10.0, _z)) end, 6) as temp_zscore_24h")
        else:
            out.append(f"round({c}, 6) as {c}")
    return ", ".join(out)


def _register_gold(name: str, cols: list[str]):
    full = ["machine_id_std", "window_start", *cols]
    sql = oracle(f"select {_gold_cols_sql(full)} from g_split")

    def fn(spark, sf):
        return _gold(spark, sf).select(*_gold_cols_spark(full))

    fn.__name__ = f"q_{name}"
    register(name, sql)(fn)


GOLD_COLUMNS = [
    "window_end", "temp_mean_1h", "temp_max_1h", "pressure_mean_1h", "pressure_max_1h", *_ROLL,
    "temp_trend_6h", "pressure_trend_6h", "temp_zscore_24h", *_INT_COLS, "hours_since_last_incident",
    *[f"label_failure_next_{h}h" for h in (6, 12, 24, 48)], "split_set",
]
_register_gold("m08_gold", GOLD_COLUMNS)
_register_gold("a01_temperature_hourly", ["temp_mean_1h", "temp_max_1h", "temp_missing_count"])
_register_gold("a02_pressure_hourly", ["pressure_mean_1h", "pressure_max_1h", "pressure_missing_count"])
_register_gold("j01_sensor_hourly_full_outer", ["temp_mean_1h", "pressure_mean_1h", "window_end"])
_register_gold("w01_rolling_mean", [c for c in _ROLL if "_mean_" in c])
_register_gold("w02_rolling_max", [c for c in _ROLL if "_max_" in c])
_register_gold("w03_rolling_std", [c for c in _ROLL if "_std_" in c])
_register_gold("w04_trend_6h", ["temp_trend_6h", "pressure_trend_6h"])
_register_gold("w05_zscore_24h", ["temp_zscore_24h"])
_register_gold("w06_incident_lookback", ["incident_count_prev_24h", "incident_count_prev_7d"])
_register_gold("w07_max_severity_24h", ["incident_max_severity_prev_24h"])
_register_gold("w08_type_counts_24h", [f"{f}_count_prev_24h" for f in FLAGS])
_register_gold("w09_hours_since_incident", ["hours_since_last_incident"])
_register_gold("w10_failure_labels", [f"future_incident_count_{h}h" for h in (6, 12, 24, 48)]
               + [f"label_failure_next_{h}h" for h in (6, 12, 24, 48)])
_register_gold("m06_temporal_split", ["split_set"])
_register_gold("j02_incident_hourly_left_join", ["incident_count_1h", "incident_max_severity_1h"])
_register_gold("j03_incident_type_sums_join", list(FLAGS))


@register("a03_incident_hourly", oracle(
    "select machine_id_std, window_start, cast(incident_count_1h as bigint) as incident_count_1h, "
    "cast(incident_max_severity_1h as bigint) as incident_max_severity_1h, "
    + ", ".join(f"cast({f} as bigint) as {f}" for f in FLAGS) + " from g_inc"))
def q_a03_incident_hourly(spark, sf):
    h = features.hourly_incident_features(L.chain(spark, sf).i_silver())
    return h.select("machine_id_std", "window_start", F.col("incident_count_1h").cast("bigint").alias("incident_count_1h"),
                    F.col("incident_max_severity_1h").cast("bigint").alias("incident_max_severity_1h"),
                    *[F.col(f).cast("bigint").alias(f) for f in FLAGS])


@register("a24_split_thresholds", oracle(
    "select round(quantile_cont(epoch_us(window_start), 0.7), 0) as split_q70_us, "
    "round(quantile_cont(epoch_us(window_start), 0.85), 0) as split_q85_us from g_hourly"))
def q_a24_split_thresholds(spark, sf):
    sensors = L.chain(spark, sf).sensors()
    th = features.split_thresholds(features.hourly_sensor_features(sensors))
    return th.select(F.round("split_q70_us", 0).alias("split_q70_us"), F.round("split_q85_us", 0).alias("split_q85_us"))


# the other query groups register themselves on import
from forgeline.plans import q_silver, q_weather, q_profile, q_tables  # noqa: E402,F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
