"""Queries: validation, scalar parsing, imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.operators import dims, impute, regression, validate
from forgeline.plans import layers as L
from forgeline.plans.oracle import DIGITS, FLAGS, blank, mcode, num, oracle, strip, ts_parse
from forgeline.plans.q_weather import _W_CTES, _store
from forgeline.plans.registry import big, r6, register, s6


def _raw(spark, sf):
    return L.chain(spark, sf).raw()


# ------------------------------------------------------------------ P01-P09
@register("p01_machine_code", oracle(
    f"select row_number, machine_id_raw, {mcode('machine_id_raw')} as machine_id_std from t_raw "
    f"union all select row_number, machine_id, {mcode('machine_id')} from i_raw"))
def q_p01(spark, sf):
    t, _, i = _raw(spark, sf)
    a = t.select("row_number", "machine_id_raw", X.machine_code("machine_id_raw").alias("machine_id_std"))
    b = i.select("row_number", F.col("machine_id").alias("machine_id_raw"), X.machine_code("machine_id").alias("machine_id_std"))
    return a.unionByName(b)


@register("p02_blank_to_null", oracle(
    f"select row_number, nullif({strip('temperature_raw')}, '') as temperature_clean from t_raw"))
def q_p02(spark, sf):
    t, _, _ = _raw(spark, sf)
    return t.select("row_number", X.blank_to_null("temperature_raw").alias("temperature_clean"))


@register("p03_timestamp_temperature", oracle(
    f"select row_number, {ts_parse('timestamp_raw')} as event_ts from t_raw"))
def q_p03(spark, sf):
    t, _, _ = _raw(spark, sf)
    return t.select("row_number", X.parse_timestamp("timestamp_raw").alias("event_ts"))


@register("p04_timestamp_pressure", oracle(
    f"select row_number, timestamp_raw, {ts_parse('timestamp_raw')} as event_ts from p_raw"))
def q_p04(spark, sf):
    _, p, _ = _raw(spark, sf)
    return p.select("row_number", "timestamp_raw", X.parse_timestamp("timestamp_raw").alias("event_ts"))


@register("p05_date_time_concat", oracle(
    f"select row_number, try_cast(trim(concat_ws(' ', nullif({strip('date')}, ''), coalesce(nullif({strip('time')}, ''), ''))) as timestamp) "
    "as occurred_at from i_raw"))
def q_p05(spark, sf):
    _, _, i = _raw(spark, sf)
    return i.select("row_number", X.combine_date_time("date", "time").alias("occurred_at"))


@register("p06_numeric_parse", oracle(
    f"select row_number, temperature_raw, round({num('temperature_raw')}, 6) as temperature, "
    f"({blank('temperature_raw')} or try_cast(nullif({strip('temperature_raw')}, '') as double) is not null) as strict_ok from t_raw"))
def q_p06(spark, sf):
    t, _, _ = _raw(spark, sf)
    return t.select("row_number", "temperature_raw", r6(X.parse_number("temperature_raw")).alias("temperature"),
                    X.is_numeric_text("temperature_raw").alias("strict_ok"))


@register("p07_missing_flag", oracle(
    f"select row_number, {num('pressure_raw')} is null as is_missing from p_raw"))
def q_p07(spark, sf):
    _, p, _ = _raw(spark, sf)
    return p.select("row_number", X.missing_flag(X.parse_number("pressure_raw")).alias("is_missing"))


@register("p08_incident_code", oracle(f"select row_number, nullif(upper({strip('incident_id')}), '') as incident_code from i_raw"))
def q_p08(spark, sf):
    _, _, i = _raw(spark, sf)
    return i.select("row_number", X.incident_code("incident_id").alias("incident_code"))


@register("p09_type_flags", oracle(
    "select row_number, " + ", ".join(f"cast(coalesce(try_cast({strip(f)} as int), 0) as bigint) as {f}" for f in FLAGS)
    + " from i_raw"))
def q_p09(spark, sf):
    _, _, i = _raw(spark, sf)
    return i.select("row_number", *[X.flag_int(f).cast("bigint").alias(f) for f in FLAGS])


# ------------------------------------------------------------------ P10-P12, K03, D01-D03
def _codes_sql(rules: list[tuple[str, str]]) -> str:
    parts = ", ".join(f"case when {cond} then '{code}' end" for code, cond in rules)
    return f"nullif(concat_ws(';', {parts}), '')"


def _sensor_rules_sql(value_raw: str) -> list[tuple[str, str]]:
    dig = f"try_cast(nullif({DIGITS.format(c='machine_id_raw')}, '') as bigint)"
    return [
        ("missing_machine_id", blank("machine_id_raw")),
        ("machine_id_without_digits", f"not {blank('machine_id_raw')} and {dig} is null"),
        ("missing_timestamp", blank("timestamp_raw")),
        ("unparsable_timestamp", f"not {blank('timestamp_raw')} and {ts_parse('timestamp_raw')} is null"),
        ("non_numeric_value", f"not ({blank(value_raw)} or try_cast(nullif({strip(value_raw)}, '') as double) is not null)"),
    ]


def _incident_rules_sql() -> list[tuple[str, str]]:
    dig = f"try_cast(nullif({DIGITS.format(c='machine_id')}, '') as bigint)"
    sev = f"try_cast(nullif({strip('severity')}, '') as int)"
    occ = f"try_cast(trim(concat_ws(' ', nullif({strip('date')}, ''), coalesce(nullif({strip('time')}, ''), ''))) as timestamp)"
    flag_bad = " or ".join(f"(nullif({strip(f)}, '') is not null and try_cast(nullif({strip(f)}, '') as int) is null)" for f in FLAGS)
    return [
        ("missing_incident_id", blank("incident_id")),
        ("missing_machine_id", blank("machine_id")),
        ("machine_id_without_digits", f"not {blank('machine_id')} and {dig} is null"),
        ("missing_date", blank("date")),
        ("missing_time", blank("time")),
        ("missing_severity", blank("severity")),
        ("unparsable_occurred_at", f"not {blank('date')} and not {blank('time')} and {occ} is null"),
        ("non_integer_severity", f"not {blank('severity')} and {sev} is null"),
        ("severity_out_of_range", f"{sev} is not null and not ({sev} between 1 and 5)"),
        ("non_integer_type_flag", f"({flag_bad})"),
    ]


def _validation_sql(src: str, rules) -> str:
    codes = _codes_sql(rules)
    return f"select row_number, {codes} is null as parse_ok, {codes} as rejected_reason from {src}"


@register("p10_temperature_validation", oracle(_validation_sql("t_raw", _sensor_rules_sql("temperature_raw"))))
def q_p10(spark, sf):
    t, _, _ = _raw(spark, sf)
    return validate.validate_temperature(t).select("row_number", "parse_ok", "rejected_reason")


@register("p11_pressure_validation", oracle(_validation_sql("p_raw", _sensor_rules_sql("pressure_raw"))))
def q_p11(spark, sf):
    _, p, _ = _raw(spark, sf)
    return validate.validate_pressure(p).select("row_number", "parse_ok", "rejected_reason")


@register("p12_incident_validation", oracle(_validation_sql("i_raw", _incident_rules_sql())))
def q_p12(spark, sf):
    _, _, i = _raw(spark, sf)
    return validate.validate_incidents(i).select("row_number", "parse_ok", "rejected_reason")


def _ledger_sql(name: str, src: str, rules) -> str:
    codes = _codes_sql(rules)
    return (f"select '{name}' as source_name, count(*) as rows_read, count(*) filter (where {codes} is null) as rows_loaded, "
            f"count(*) filter (where {codes} is not null) as rows_rejected, "
            f"case when count(*) filter (where {codes} is not null) = 0 then 'completed' else 'partial' end as status from {src}")


@register("k03_batch_ledger", oracle(
    _ledger_sql("capteurs_temperature", "t_raw", _sensor_rules_sql("temperature_raw")) + " union all "
    + _ledger_sql("capteurs_pression", "p_raw", _sensor_rules_sql("pressure_raw")) + " union all "
    + _ledger_sql("releves_incidents", "i_raw", _incident_rules_sql())))
def q_k03(spark, sf):
    t, p, i = _raw(spark, sf)
    parts = [
        validate.batch_counts(validate.validate_temperature(t), "capteurs_temperature", "fixture"),
        validate.batch_counts(validate.validate_pressure(p), "capteurs_pression", "fixture"),
        validate.batch_counts(validate.validate_incidents(i), "releves_incidents", "fixture"),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("source_name", big("rows_read"), big("rows_loaded"), big("rows_rejected"), "status")


def _counts_sql(name: str, src: str, rules, imputed: str) -> str:
    codes = _codes_sql(rules)
    return (f"select '{name}' as dataset_name, count(*) filter (where {codes} is null) as rows_loaded, "
            f"count(*) filter (where {codes} is not null) as rows_rejected, {imputed} as rows_imputed from {src}")


@register("a25_batch_counts", oracle(
    _counts_sql("capteurs_temperature", "t_raw", _sensor_rules_sql("temperature_raw"),
                "(select count(*) from t_silver where is_missing_v and sensor_value is not null)") + " union all "
    + _counts_sql("capteurs_pression", "p_raw", _sensor_rules_sql("pressure_raw"),
                  "(select count(*) from p_silver where is_missing_v and sensor_value is not null)") + " union all "
    + _counts_sql("releves_incidents", "i_raw", _incident_rules_sql(), "0")))
def q_a25(spark, sf):
    """Loaded, rejected and imputed rows of the three sources."""
    c = L.chain(spark, sf)
    t, p, i = c.raw()
    parts = []
    for name, checked, silver in (("capteurs_temperature", validate.validate_temperature(t), c.t_silver()),
                                  ("capteurs_pression", validate.validate_pressure(p), c.p_silver()),
                                  ("releves_incidents", validate.validate_incidents(i), None)):
        imputed = F.lit(0) if silver is None else silver.agg(F.count_if("was_imputed")).scalar()
        parts.append(validate.batch_counts(checked, name, "fixture").select(
            F.lit(name).alias("dataset_name"), big("rows_loaded"), big("rows_rejected"), imputed.cast("bigint").alias("rows_imputed")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("d01_constraint_violations", oracle(
    "select 'machine_code_format' as rule_code, count(*) filter (where not coalesce(regexp_matches(machine_id_std, '^MACH-[0-9]{2}$'), false)) as violations "
    "from (select distinct machine_id_std from s_sensors) "
    "union all select 'machine_capacity_positive', 0 union all select 'machine_criticality_known', 0 "
    "union all select 'severity_range', count(*) filter (where not coalesce(severity between 1 and 5, false)) from i_dedup "
    "union all select 'window_end_after_start', count(*) filter (where not coalesce(window_end > window_start, false)) from g_roll "
    "union all select 'unique_machine_hour', count(*) from (select machine_id_std, window_start from g_roll group by 1, 2 having count(*) > 1) "
    "union all select 'unique_incident_code', count(*) from (select incident_id from i_dedup group by 1 having count(*) > 1) "
    "union all select 'unique_weather_hour', count(*) from (select observed_at from w_hourly group by 1 having count(*) > 1) "
    "union all select 'unique_sensor_reading', count(*) from (select machine_id_std, event_ts, sensor_type from s_sensors group by 1, 2, 3 having count(*) > 1)",
    _W_CTES))
def q_d01(spark, sf):
    c = L.chain(spark, sf)
    codes = c.sensors().select(F.col("machine_id_std").alias("machine_code")).distinct()
    machines = codes.join(dims.machine_seed(spark), "machine_code", "left")
    rows = validate.all_constraints(machines, c.sensors(), c.i_silver(), c.gold(), _store(spark, sf))
    return rows.select("rule_code", big("violations"))


def _rejects_sql(dataset: str, codes: str, src: str) -> str:
    return (f"select '{dataset}' as dataset_name, unnest(string_split(r, ';')) as rule_code, 'error' as severity, cast(row_number as varchar) as entity_key "
            f"from (select row_number, {codes} as r from {src}) where r is not null")


@register("d02_quality_issues", oracle(
    "select dataset_name, rule_code, severity, entity_key, count(*) as n from ("
    + _rejects_sql("capteurs_temperature", _codes_sql(_sensor_rules_sql("temperature_raw")), "t_raw")
    + " union all " + _rejects_sql("capteurs_pression", _codes_sql(_sensor_rules_sql("pressure_raw")), "p_raw")
    + " union all " + _rejects_sql("releves_incidents", _codes_sql(_incident_rules_sql()), "i_raw")
    + " union all select 'capteurs_temperature', 'dedup_' || dedupe_resolution, 'info', machine_id_std || '|' || cast(event_ts as varchar) "
    "from t_dedup where records_in_group > 1 "
    "union all select 'capteurs_pression', 'dedup_' || dedupe_resolution, 'info', machine_id_std || '|' || cast(event_ts as varchar) "
    "from p_dedup where records_in_group > 1 "
    "union all select 'releves_incidents', 'dedup_' || dedupe_resolution, 'info', incident_id from i_dedup where records_in_group > 1 "
    "union all select 'gold_machine_hourly_feature', 'incident_hour_without_sensor_row', 'warning', machine_id_std || '|' || cast(window_start as varchar) "
    "from g_inc i where not exists (select 1 from g_hourly h where h.machine_id_std = i.machine_id_std and h.window_start = i.window_start)"
    ") group by all"))
def q_d02(spark, sf):
    c = L.chain(spark, sf)
    t, p, i = c.raw()
    from forgeline.operators.features import dropped_incident_hours

    out = validate.quality_issues(
        {"capteurs_temperature": validate.validate_temperature(t), "capteurs_pression": validate.validate_pressure(p),
         "releves_incidents": validate.validate_incidents(i)},
        {"capteurs_temperature": (c.t_deduped(), ["machine_id_std", "event_ts"]), "capteurs_pression": (c.p_deduped(), ["machine_id_std", "event_ts"]),
         "releves_incidents": (c.i_silver(), ["incident_id"])},
    ).unionByName(dropped_incident_hours(c.sensors(), c.i_silver()))
    return out.groupBy("dataset_name", "rule_code", "severity", "entity_key").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@register("d03_operator_pseudonym", oracle(
    "select row_number, case when operator_badge is not null then sha256('forgeline-salt' || operator_badge) end as badge_hash from i_raw"))
def q_d03(spark, sf):
    _, _, i = _raw(spark, sf)
    return i.select("row_number", validate.pseudonymise("operator_badge", "forgeline-salt").alias("badge_hash"))


# ------------------------------------------------------------------ P13-P29
@register("p13_drop_null_keys", oracle(f"select count(*) as rows_kept from t_raw where {mcode('machine_id_raw')} is not null and {ts_parse('timestamp_raw')} is not null"))
def q_p13(spark, sf):
    t, _, _ = _raw(spark, sf)
    k = t.select(X.machine_code("machine_id_raw").alias("m"), X.parse_timestamp("timestamp_raw").alias("ts")).dropna(subset=["m", "ts"])
    return k.agg(F.count(F.lit(1)).alias("rows_kept"))


@register("p14_hour_floor", oracle(
    "select row_number, date_trunc('hour', event_ts) as window_start, date_trunc('hour', event_ts) + interval 1 hour as window_end from i_parsed"))
def q_p14(spark, sf):
    i = L.chain(spark, sf).i_parsed()
    return i.select("row_number", X.hour_floor("event_ts").alias("window_start"),
                    X.plus_hours(X.hour_floor("event_ts"), 1).alias("window_end"))


_OFFSET_SQL = ("case when regexp_matches(timestamp_raw, '[+-][0-9]{2}:[0-9]{2}$') then "
               "(case when substr(timestamp_raw, -6, 1) = '-' then -1 else 1 end) * "
               "(cast(substr(timestamp_raw, -5, 2) as int) * 60 + cast(substr(timestamp_raw, -2, 2) as int)) else 0 end")


@register("p15_utc_wall_clock", oracle(
    f"select row_number, {ts_parse('timestamp_raw')} - to_minutes({_OFFSET_SQL}) as observed_utc, "
    f"{ts_parse('timestamp_raw')} - interval 2 hour as from_zone from p_raw"))
def q_p15(spark, sf):
    """Text with offsets to UTC wall clock; and naive times of a zone two hours ahead."""
    _, p, _ = _raw(spark, sf)
    return p.select("row_number", X.to_utc_wall_clock("timestamp_raw").alias("observed_utc"),
                    X.to_utc_wall_clock(X.parse_timestamp("timestamp_raw"), "Etc/GMT-2").alias("from_zone"))


@register("p17_default_fills", oracle(
    "select incident_id, coalesce(operator_name, 'UNKNOWN') as operator_name_clean, coalesce(operator_badge, 'UNKNOWN') as operator_badge_clean, "
    "comment as comment_clean from i_dedup"))
def q_p17(spark, sf):
    s = L.chain(spark, sf).i_silver()
    return s.select("incident_id", "operator_name_clean", "operator_badge_clean", "comment_clean")


@register("p18_severity_policy", oracle(
    "select incident_id, case when severity is null then 'reject_or_manual_rule' else 'keep_original' end as severity_imputation_policy from i_dedup"))
def q_p18(spark, sf):
    return L.chain(spark, sf).i_silver().select("incident_id", "severity_imputation_policy")


@register("p22_calendar_features", oracle(
    "select row_number, hour(event_ts) as hour, isodow(event_ts) - 1 as dayofweek, month(event_ts) as month, "
    "cast(floor(epoch(event_ts) / 3600) as bigint) as time_ordinal_hours from t_parsed"))
def q_p22(spark, sf):
    t = L.chain(spark, sf).t_parsed()
    f = X.calendar_features("event_ts")
    return t.select("row_number", *[v.cast("bigint").alias(k) for k, v in f.items()])


@register("p23_machine_category_code", oracle(
    "select machine_id_std, cast(dense_rank() over (order by machine_id_std) - 1 as double) as machine_code_numeric "
    "from (select distinct machine_id_std from t_dedup)"))
def q_p23(spark, sf):
    return regression.machine_codes(L.chain(spark, sf).t_deduped(), "machine_id_std")


@register("p25_decimal_rounding", oracle(
    "select machine_id_std, window_start, cast(cast(cast(temp_mean_24h as varchar) as decimal(12,3)) as double) as temp_mean_24h, "
    "cast(cast(cast(hours_since_last_incident as varchar) as decimal(10,2)) as double) as hours_since_last_incident from g_roll"))
def q_p25(spark, sf):
    from forgeline.operators.features import gold_table

    g = gold_table(L.chain(spark, sf).gold())
    return g.select("machine_id_std", "window_start", F.col("temp_mean_24h").cast("double").alias("temp_mean_24h"),
                    F.col("hours_since_last_incident").cast("double").alias("hours_since_last_incident"))


@register("p26_range_predicate", oracle(
    "select row_number, coalesce(temperature_normalized between 0 and 120, false) as in_range from t_dedup"))
def q_p26(spark, sf):
    return L.chain(spark, sf).t_deduped().select("row_number", X.in_range("temperature_normalized", 0.0, 120.0).alias("in_range"))


@register("p28_sensor_unification", oracle(
    "select machine_id_std, event_ts, sensor_type, round(sensor_value, 6) as sensor_value, is_missing from s_sensors"))
def q_p28(spark, sf):
    s = L.chain(spark, sf).sensors()
    return s.select("machine_id_std", "event_ts", "sensor_type", r6("sensor_value").alias("sensor_value"), "is_missing")


# ------------------------------------------------------------------ imputation
def _mask_u_sql() -> str:
    mnum = f"try_cast(nullif({DIGITS.format(c='machine_id_std')}, '') as bigint)"
    return f"cast(((cast(floor(epoch(event_ts) / 3600) as bigint) * 2654435761 + {mnum} * 40503) % 1000003) as double) / 1000003.0"


def _bench_ctes(p: str, src: str, target: str) -> list[tuple[str, str]]:
    return [
        (f"{p}_rank", f"""select *, case when {target} is not null then row_number() over (partition by {target} is not null
              order by {_mask_u_sql()}, machine_id_std, event_ts) end as _mrank,
            count({target}) over () as _nobs from {src}"""),
        (f"{p}_bench", f"""select * exclude (_mrank, _nobs), coalesce(_mrank <= least(_nobs, greatest(10, cast(floor(_nobs * 0.1) as bigint))), false) as is_masked,
            case when coalesce(_mrank <= least(_nobs, greatest(10, cast(floor(_nobs * 0.1) as bigint))), false) then null else {target} end as _bench_value
          from {p}_rank"""),
        (f"{p}_groups", f"""select b.*, coalesce(b._bench_value, gm._m, (select avg(_bench_value) from {p}_bench)) as _cand_mean,
            coalesce(b._bench_value, gd._d, (select median(_bench_value) from {p}_bench)) as _cand_median
          from {p}_bench b
          left join (select machine_id_std, avg(_bench_value) as _m from {p}_bench group by 1) gm using (machine_id_std)
          left join (select machine_id_std, median(_bench_value) as _d from {p}_bench group by 1) gd using (machine_id_std)"""),
        *_regression_ctes(p),
    ]


def _regression_ctes(p: str) -> list[tuple[str, str]]:
    """Least squares by residuals: each centred feature loses its projections on the ones before (Gram-Schmidt), over observed rows."""
    seen = "filter (where _obs) over ()"
    out = [
        (f"{p}_feat", f"""select g.*, _bench_value is not null as _obs, c._x1, cast(hour(event_ts) as double) as _x2,
            cast(isodow(event_ts) - 1 as double) as _x3, cast(month(event_ts) as double) as _x4, cast(floor(epoch(event_ts) / 3600) as double) as _x5
          from {p}_groups g left join (select machine_id_std, cast(dense_rank() over (order by machine_id_std) - 1 as double) as _x1
            from (select distinct machine_id_std from {p}_groups)) c using (machine_id_std)"""),
        (f"{p}_z", "select *, " + ", ".join(f"_x{i} - avg(_x{i}) {seen} as _z{i}" for i in range(1, 6)) + f", avg(_bench_value) {seen} as _y0 from {p}_feat"),
        (f"{p}_q1", f"select *, _z1 as _q1 from {p}_z"),
    ]
    for i in range(2, 6):
        minus = " ".join(f"- coalesce(sum(_z{i} * _q{j}) {seen} / nullif(sum(_q{j} * _q{j}) {seen}, 0), 0) * _q{j}" for j in range(1, i))
        out.append((f"{p}_q{i}", f"select *, _z{i} {minus} as _q{i} from {p}_q{i - 1}"))
    plus = " ".join(f"+ coalesce(sum(_bench_value * _q{j}) {seen} / nullif(sum(_q{j} * _q{j}) {seen}, 0), 0) * _q{j}" for j in range(1, 6))
    return [*out, (f"{p}_cands", f"select *, coalesce(_bench_value, _y0 {plus}) as _cand_iterative from {p}_q5")]


def _metrics_ctes(p: str, dataset: str, target: str, lo: float, hi: float) -> list[tuple[str, str]]:
    stack = " union all ".join(
        f"select is_masked, {target} as _truth, '{m}' as method, _cand_{m} as pred from {p}_cands" for m in impute.METHODS)
    return [
        (f"{p}_stack", stack),
        (f"{p}_m", f"""select method, count(*) filter (where is_masked) as masked_rows,
            avg(abs(case when is_masked then pred - _truth end)) as mae,
            sqrt(avg(case when is_masked then (pred - _truth) * (pred - _truth) end)) as rmse,
            median(abs(case when is_masked then pred - _truth end)) as medae,
            avg(case when is_masked then pred - _truth end) as bias,
            avg(case when coalesce(coalesce(_truth, pred) between {lo} and {hi}, false) then 0.0 else 1.0 end) as out_of_range_rate,
            abs(avg(coalesce(_truth, pred)) - (select avg({target}) from {p}_cands)) as _d1,
            abs(median(coalesce(_truth, pred)) - (select median({target}) from {p}_cands)) as _d2,
            abs(stddev_pop(coalesce(_truth, pred)) - (select stddev_pop({target}) from {p}_cands)) as _d3
          from {p}_stack group by method"""),
        (f"{p}_metrics", f"""select '{dataset}' as dataset_name, '{target}' as target_column, method, masked_rows,
            mae, rmse, medae, bias, out_of_range_rate,
            (coalesce(_d1, 0) + coalesce(_d2, 0) + coalesce(_d3, 0)) /
              nullif((case when _d1 is null then 0 else 1 end) + (case when _d2 is null then 0 else 1 end) + (case when _d3 is null then 0 else 1 end), 0)
              as distribution_drift
          from {p}_m"""),
    ]


_IMP_CTES = (_bench_ctes("ti", "t_dedup", "temperature_normalized")
             + _metrics_ctes("ti", "capteurs_temperature", "temperature_normalized", 0.0, 120.0)
             + _bench_ctes("pi", "p_dedup", "pressure_bar")
             + _metrics_ctes("pi", "capteurs_pression", "pressure_bar", 100.0, 250.0))

_METRIC_COLS = ["mae", "rmse", "medae", "bias", "out_of_range_rate", "distribution_drift"]


def _u(df):
    return impute.arithmetic_hash_unit("event_ts", X.machine_number("machine_id_std"))


def _t_metrics(spark, sf, methods=impute.METHODS):
    d = L.chain(spark, sf).t_deduped()
    return impute.evaluate_imputation(d, L.TEMPERATURE_CONTEXT, methods, u=_u(d))


def _p_metrics(spark, sf, methods=impute.METHODS):
    d = L.chain(spark, sf).p_deduped()
    return impute.evaluate_imputation(d, L.PRESSURE_CONTEXT, methods, u=_u(d))


def _metrics_out(m):
    return m.select("dataset_name", "target_column", "method", big("masked_rows"), *[F.round(c, 4).alias(c) for c in _METRIC_COLS])


_METRICS_SQL = ", ".join(["dataset_name", "target_column", "method", "cast(masked_rows as bigint) as masked_rows"]
                         + [f"round({c}, 4) as {c}" for c in _METRIC_COLS])


@register("w14_masked_sample", oracle(
    "select machine_id_std, event_ts, is_masked from ti_bench", _IMP_CTES))
def q_w14(spark, sf):
    d = L.chain(spark, sf).t_deduped()
    return impute.mask_observed(d, L.TEMPERATURE_CONTEXT, _u(d)).select("machine_id_std", "event_ts", "is_masked")


@register("a07_group_mean_impute", oracle(
    "select machine_id_std, event_ts, round(_cand_mean, 6) as candidate from ti_cands", _IMP_CTES))
def q_a07(spark, sf):
    d = L.chain(spark, sf).t_deduped()
    m = impute.mask_observed(d, L.TEMPERATURE_CONTEXT, _u(d))
    return impute.group_fill(m, "_bench_value", "machine_id_std", "mean", "candidate").select(
        "machine_id_std", "event_ts", r6("candidate").alias("candidate"))


@register("a08_group_median_impute", oracle(
    "select machine_id_std, event_ts, round(_cand_median, 6) as candidate from ti_cands", _IMP_CTES))
def q_a08(spark, sf):
    d = L.chain(spark, sf).t_deduped()
    m = impute.mask_observed(d, L.TEMPERATURE_CONTEXT, _u(d))
    return impute.group_fill(m, "_bench_value", "machine_id_std", "median", "candidate").select(
        "machine_id_std", "event_ts", r6("candidate").alias("candidate"))


@register("m03_imputation_benchmark", oracle(
    f"select {_METRICS_SQL} from ti_metrics union all select {_METRICS_SQL} from pi_metrics", _IMP_CTES))
def q_m03(spark, sf):
    return _metrics_out(_t_metrics(spark, sf)).unionByName(_metrics_out(_p_metrics(spark, sf)))


@register("a09_imputation_errors", oracle(
    "select method, round(mae, 4) as mae, round(rmse, 4) as rmse, round(medae, 4) as medae, round(bias, 4) as bias from ti_metrics", _IMP_CTES))
def q_a09(spark, sf):
    return _t_metrics(spark, sf).select("method", *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "medae", "bias")])


@register("a10_out_of_range_rate", oracle(
    "select method, round(out_of_range_rate, 6) as out_of_range_rate from pi_metrics", _IMP_CTES))
def q_a10(spark, sf):
    return _p_metrics(spark, sf).select("method", r6("out_of_range_rate").alias("out_of_range_rate"))


@register("a11_distribution_drift", oracle(
    "select method, round(distribution_drift, 4) as distribution_drift from ti_metrics", _IMP_CTES))
def q_a11(spark, sf):
    return _t_metrics(spark, sf).select("method", F.round("distribution_drift", 4).alias("distribution_drift"))


_CHOICE_SQL = ("select dataset_name, target_column, method as recommended_method, "
               + ", ".join(s6(c, c) for c in _METRIC_COLS)
               + " from (select *, row_number() over (partition by dataset_name, target_column order by out_of_range_rate, rmse, mae, "
               "distribution_drift, medae, method) as _rk from (select * from ti_metrics union all select * from pi_metrics)) where _rk = 1")


@register("w13_method_choice", oracle(_CHOICE_SQL, _IMP_CTES))
def q_w13(spark, sf):
    ch = impute.choose_method(_t_metrics(spark, sf).unionByName(_p_metrics(spark, sf)))
    return ch.select("dataset_name", "target_column", "recommended_method", *[r6(c).alias(c) for c in _METRIC_COLS])


@register("m05_decisions_with_policy", oracle(
    "select dataset_name, target_column, recommended_method from (" + _CHOICE_SQL + ") "
    "union all select 'releves_incidents', 'severity', 'rule_based_no_imputation'", _IMP_CTES))
def q_m05(spark, sf):
    ch = impute.choose_method(_t_metrics(spark, sf).unionByName(_p_metrics(spark, sf)))
    out = ch.unionByName(impute.severity_policy_row(spark), allowMissingColumns=True)
    return out.select("dataset_name", "target_column", "recommended_method")


@register("m04_apply_imputation", oracle(
    "select machine_id_std, event_ts, round(sensor_value, 6) as sensor_value, is_missing_v as is_missing, "
    "(is_missing_v and sensor_value is not null) as was_imputed from t_silver"))
def q_m04(spark, sf):
    s = L.chain(spark, sf).t_silver("mean")
    return s.select("machine_id_std", "event_ts", r6("sensor_value").alias("sensor_value"), "is_missing", "was_imputed")


@register("m01_imputation_features", oracle(
    "select d.machine_id_std, d.event_ts, c.machine_code_numeric, cast(hour(d.event_ts) as double) as hour, "
    "cast(isodow(d.event_ts) - 1 as double) as dayofweek, cast(month(d.event_ts) as double) as month, "
    "cast(floor(epoch(d.event_ts) / 3600) as double) as time_ordinal_hours from t_dedup d left join "
    "(select machine_id_std, cast(dense_rank() over (order by machine_id_std) - 1 as double) as machine_code_numeric "
    "from (select distinct machine_id_std from t_dedup)) c using (machine_id_std)"))
def q_m01(spark, sf):
    d = L.chain(spark, sf).t_deduped()
    f = regression.imputation_features(d, "machine_id_std", "event_ts")
    return f.select("machine_id_std", "event_ts", *regression.FEATURES)


@register("m02_regression_impute", oracle(
    "select machine_id_std, event_ts, is_masked, round(_cand_iterative, 4) as candidate from ti_cands", _IMP_CTES))
def q_m02(spark, sf):
    d = L.chain(spark, sf).t_deduped()
    m = impute.mask_observed(d, L.TEMPERATURE_CONTEXT, _u(d))
    out = regression.regression_fill(m, "_bench_value", "machine_id_std", "event_ts", "candidate")
    return out.select("machine_id_std", "event_ts", "is_masked", F.round("candidate", 4).alias("candidate"))


@register("m02_bayesian_ridge")
def q_m02_bayesian(spark, sf):
    """The iterative imputer's own estimator; SQL can't repeat the fit, tests/test_impute.py does in plain NumPy."""
    d = L.chain(spark, sf).t_deduped()
    m = impute.mask_observed(d, L.TEMPERATURE_CONTEXT, _u(d))
    out = regression.chained_fill(m, "_bench_value", "machine_id_std", "event_ts", "candidate")
    return out.select("machine_id_std", "event_ts", "is_masked", F.round("candidate", 4).alias("candidate"))


@register("d02_dropped_incident_hours", oracle(
    "select 'gold_machine_hourly_feature' as dataset_name, 'incident_hour_without_sensor_row' as rule_code, 'warning' as severity, "
    "machine_id_std || '|' || cast(window_start as varchar) as entity_key, 'incidents=' || cast(incident_count_1h as varchar) as details "
    "from g_inc i where not exists (select 1 from g_hourly h where h.machine_id_std = i.machine_id_std and h.window_start = i.window_start)"))
def q_d02_dropped(spark, sf):
    from forgeline.operators.features import dropped_incident_hours

    c = L.chain(spark, sf)
    return dropped_incident_hours(c.sensors(), c.i_silver())
