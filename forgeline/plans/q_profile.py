"""Queries: profiling, anomaly alerts, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.operators import impute
from forgeline.operators import profile as PR
from forgeline.plans import layers as L
from forgeline.plans.oracle import FLAGS, mcode, num, oracle, strip, ts_parse
from forgeline.plans.q_silver import _IMP_CTES, _METRIC_COLS, _t_metrics
from forgeline.plans.registry import big, r6, register, s6

T_BUSINESS = ["machine_id", "timestamp", "temperature"]
P_BUSINESS = ["machine_id", "timestamp", "pressure_bar"]
I_BUSINESS = ["incident_id", "machine_id", "date", "time", "severity", "operator_name", "operator_badge", "shift", "comment", *FLAGS]


def _datasets(spark, sf):
    """The three enriched datasets of the profiling notebook, stored once per session."""
    from forgeline.session import materialize

    c = L.chain(spark, sf)

    def build():
        t, p, i = c.raw()
        td = PR.enrich(t.select("row_number", F.col("machine_id_raw").alias("machine_id"), F.col("timestamp_raw").alias("timestamp"),
                                X.parse_number("temperature_raw").alias("temperature")), "capteurs_temperature.csv", ",")
        pd_ = PR.enrich(p.select("row_number", F.col("machine_id_raw").alias("machine_id"), F.col("timestamp_raw").alias("timestamp"),
                                 X.parse_number("pressure_raw").alias("pressure_bar")), "capteurs_pression.tsv", "\t")
        inc = i.select("row_number", *[x for x in I_BUSINESS if x not in FLAGS and x != "severity"],
                       F.col("severity").try_cast("int").alias("severity"), *[F.col(f).try_cast("int").alias(f) for f in FLAGS])
        idd = PR.enrich(inc, "releves_incidents.csv", ",")
        return tuple(materialize(d, n) for d, n in ((td, "ds_t"), (pd_, "ds_p"), (idd, "ds_i")))

    return c._get("profile_datasets", build)


_DS_CTES = [
    ("t_ds", f"""select row_number, machine_id_raw as machine_id, timestamp_raw as timestamp, {num('temperature_raw')} as temperature,
        machine_id_raw as machine_id_original, {mcode('machine_id_raw')} as machine_id_std, {ts_parse('timestamp_raw')} as event_ts from t_raw"""),
    ("p_ds", f"""select row_number, machine_id_raw as machine_id, timestamp_raw as timestamp, {num('pressure_raw')} as pressure_bar,
        machine_id_raw as machine_id_original, {mcode('machine_id_raw')} as machine_id_std, {ts_parse('timestamp_raw')} as event_ts from p_raw"""),
    ("i_ds", f"""select row_number, incident_id, machine_id, date, time, try_cast(severity as int) as severity, operator_name, operator_badge, shift, comment,
        {", ".join(f"try_cast({f} as int) as {f}" for f in FLAGS)},
        machine_id as machine_id_original, {mcode('machine_id')} as machine_id_std,
        try_cast(trim(concat_ws(' ', nullif({strip('date')}, ''), coalesce(nullif({strip('time')}, ''), ''))) as timestamp) as event_ts from i_raw"""),
]


def _overview_sql(name: str, src: str, business: list[str]) -> str:
    nulls = " + ".join(f"(case when {c} is null then 1 else 0 end)" for c in business)
    anyn = " or ".join(f"{c} is null" for c in business)
    cols = ", ".join(business)
    return (f"select '{name}' as dataset, count(*) as rows, cast({len(business)} as bigint) as columns, "
            f"count(*) - (select count(*) from (select distinct {cols} from {src})) as duplicates, "
            f"cast(sum({nulls}) as bigint) as missing_cells, count(*) filter (where {anyn}) as rows_with_missing, "
            f"count(distinct machine_id_original) as machines_raw, count(distinct machine_id_std) as machines_normalized, "
            f"min(event_ts) as start, max(event_ts) as \"end\" from {src}")


_OVERVIEW_SQL = " union all ".join([
    _overview_sql("capteurs_temperature", "t_ds", T_BUSINESS),
    _overview_sql("capteurs_pression", "p_ds", P_BUSINESS),
    _overview_sql("releves_incidents", "i_ds", I_BUSINESS),
])


def _overviews(spark, sf):
    td, pd_, idd = _datasets(spark, sf)
    return (PR.dataset_overview(td, "capteurs_temperature")
            .unionByName(PR.dataset_overview(pd_, "capteurs_pression"))
            .unionByName(PR.dataset_overview(idd, "releves_incidents")))


@register("a13_dataset_overview", oracle(_OVERVIEW_SQL, _DS_CTES))
def q_a13(spark, sf):
    return _overviews(spark, sf)


def _profile_sql(name: str, src: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
        lo, hi = f"({q1} - 1.5 * ({q3} - {q1}))", f"({q3} + 1.5 * ({q3} - {q1}))"
        parts.append(
            f"select '{name}' as dataset, '{c}' as column, count(*) filter (where {c} is null) as missing, "
            f"round(min({c}), 6) as min, round(median({c}), 6) as median, round(max({c}), 6) as max, round(avg({c}), 6) as mean, "
            f"round(stddev_pop({c}), 6) as std, round({lo}, 6) as iqr_lower, round({hi}, 6) as iqr_upper, "
            f"(select count(*) from {src} s2 where s2.{c} < (select {lo} from {src}) or s2.{c} > (select {hi} from {src})) as iqr_alerts "
            f"from {src} having count({c}) > 0")
    return " union all ".join(parts)


_PROFILE_SQL = " union all ".join([
    _profile_sql("capteurs_temperature", "t_ds", ["temperature"]),
    _profile_sql("capteurs_pression", "p_ds", ["pressure_bar"]),
    _profile_sql("releves_incidents", "i_ds", ["severity", *FLAGS]),
])


@register("a14_numeric_profile", oracle(_PROFILE_SQL, _DS_CTES))
def q_a14(spark, sf):
    td, pd_, idd = _datasets(spark, sf)
    out = (PR.numeric_profile(td, "capteurs_temperature", ["temperature"])
           .unionByName(PR.numeric_profile(pd_, "capteurs_pression", ["pressure_bar"]))
           .unionByName(PR.numeric_profile(idd, "releves_incidents", ["severity", *FLAGS])))
    return out.select("dataset", "column", big("missing"), *[r6(c).alias(c) for c in
                      ("min", "median", "max", "mean", "std", "iqr_lower", "iqr_upper")], big("iqr_alerts"))


_AUDIT_SQL = " union all ".join(
    f"select '{n}' as dataset, machine_id_original, machine_id_std, count(*) as rows from {s} where machine_id_original is not null group by all"
    for n, s in (("capteurs_temperature", "t_ds"), ("capteurs_pression", "p_ds"), ("releves_incidents", "i_ds")))


def _audits(spark, sf):
    td, pd_, idd = _datasets(spark, sf)
    return (PR.machine_id_audit(td, "capteurs_temperature").unionByName(PR.machine_id_audit(pd_, "capteurs_pression"))
            .unionByName(PR.machine_id_audit(idd, "releves_incidents")))


@register("a15_machine_id_audit", oracle(_AUDIT_SQL, _DS_CTES))
def q_a15(spark, sf):
    return _audits(spark, sf).select("dataset", "machine_id_original", "machine_id_std", big("rows"))


@register("l03_top_machine_ids", oracle(
    f"select dataset, machine_id_original, machine_id_std, rows from (select *, row_number() over (partition by dataset "
    f"order by rows desc, machine_id_original) as _rk from ({_AUDIT_SQL})) where _rk <= 10", _DS_CTES))
def q_l03(spark, sf):
    a = _audits(spark, sf)
    return PR.top_k_per_group(a, ["dataset"], [F.col("rows").desc(), F.col("machine_id_original")], 10).select(
        "dataset", "machine_id_original", "machine_id_std", big("rows"))


@register("a16_missing_per_column", oracle(
    " union all ".join(f"select '{c}' as column, count(*) filter (where {c} is null) as missing_values from i_ds" for c in I_BUSINESS),
    _DS_CTES))
def q_a16(spark, sf):
    _, _, idd = _datasets(spark, sf)
    return PR.missing_per_column(idd, I_BUSINESS)


@register("a17_daily_temperature_mean", oracle(
    "select cast(s.day as timestamp) as day, round(d.v, 6) as temperature from (select unnest(generate_series(min(cast(event_ts as date)), "
    "max(cast(event_ts as date)), interval 1 day)) as day from t_ds) s left join (select cast(event_ts as date) as day, avg(temperature) as v "
    "from t_ds where event_ts is not null group by 1) d on cast(s.day as date) = d.day", _DS_CTES))
def q_a17(spark, sf):
    td, _, _ = _datasets(spark, sf)
    r = PR.daily_resample(td, "event_ts", "temperature")
    return r.select(F.col("day").cast("timestamp_ntz").alias("day"), r6("temperature").alias("temperature"))


@register("a18_daily_incident_count", oracle(
    "select cast(s.day as timestamp) as day, coalesce(d.n, 0) as rows from (select unnest(generate_series(min(cast(event_ts as date)), "
    "max(cast(event_ts as date)), interval 1 day)) as day from i_ds) s left join (select cast(event_ts as date) as day, count(*) as n "
    "from i_ds where event_ts is not null group by 1) d on cast(s.day as date) = d.day", _DS_CTES))
def q_a18(spark, sf):
    _, _, idd = _datasets(spark, sf)
    r = PR.daily_resample(idd, "event_ts", None)
    return r.select(F.col("day").cast("timestamp_ntz").alias("day"), big("rows"))


@register("a19_global_iqr_alerts", oracle(
    "select round(min(temperature), 6) as min, round(max(temperature), 6) as max, round(avg(temperature), 6) as mean, "
    "round(q1 - 1.5 * (q3 - q1), 6) as iqr_lower, round(q3 + 1.5 * (q3 - q1), 6) as iqr_upper, "
    "count(*) filter (where temperature < q1 - 1.5 * (q3 - q1) or temperature > q3 + 1.5 * (q3 - q1)) as alerts "
    "from t_ds, (select quantile_cont(temperature, 0.25) as q1, quantile_cont(temperature, 0.75) as q3 from t_ds) "
    "where temperature is not null group by q1, q3", _DS_CTES))
def q_a19(spark, sf):
    td, _, _ = _datasets(spark, sf)
    a = PR.global_iqr_alerts(td, "temperature")
    return a.select(*[r6(c).alias(c) for c in ("min", "max", "mean", "iqr_lower", "iqr_upper")], big("alerts"))


_W12_CTES = _DS_CTES + [
    ("w12_scored", """select machine_id_std as machine_id, event_ts, row_number, temperature,
        count(temperature) over w as _n, avg(temperature) over w as _m, stddev_pop(temperature) over w as _s
      from t_ds where machine_id_std is not null and event_ts is not null and temperature is not null
      window w as (partition by machine_id_std order by event_ts, row_number rows between 167 preceding and current row)"""),
    ("w12_alerts", """select machine_id, event_ts, row_number, temperature,
        case when _n >= 24 then _m end as rolling_mean, case when _n >= 24 then nullif(_s, 0) end as rolling_std,
        (temperature - case when _n >= 24 then _m end) / case when _n >= 24 then nullif(_s, 0) end as rolling_zscore
      from w12_scored"""),
]
_W12_OUT = ("machine_id, event_ts, row_number, round(temperature, 6) as temperature, round(rolling_mean, 6) as rolling_mean, "
            "round(rolling_std, 6) as rolling_std, round(rolling_zscore, 6) as rolling_zscore, round(abs(rolling_zscore), 6) as abs_zscore")


def _alerts(spark, sf):
    td, _, _ = _datasets(spark, sf)
    return PR.rolling_zscore_alerts(td, "temperature")


def _alert_cols(a):
    return a.select("machine_id", "event_ts", "row_number", *[r6(c).alias(c) for c in
                    ("temperature", "rolling_mean", "rolling_std", "rolling_zscore", "abs_zscore")])


@register("w12_rolling_zscore_alerts", oracle(f"select {_W12_OUT} from w12_alerts where abs(rolling_zscore) > 4", _W12_CTES))
def q_w12(spark, sf):
    return _alert_cols(_alerts(spark, sf))


@register("a20_alerts_per_machine", oracle(
    "select machine_id, count(*) as alert_count from w12_alerts where abs(rolling_zscore) > 4 group by 1", _W12_CTES))
def q_a20(spark, sf):
    return _alerts(spark, sf).groupBy("machine_id").agg(F.count(F.lit(1)).cast("bigint").alias("alert_count"))


@register("l02_top_strange_temperatures", oracle(
    f"select {_W12_OUT} from w12_alerts where abs(rolling_zscore) > 4 order by abs(rolling_zscore) desc, machine_id, event_ts, row_number limit 20",
    _W12_CTES))
def q_l02(spark, sf):
    a = _alerts(spark, sf)
    return _alert_cols(PR.top_k(a, [F.col("abs_zscore").desc(), F.col("machine_id"), F.col("event_ts"), F.col("row_number")], 20))


_SAMPLE_ORDER = "order by (row_number * 2654435761) % 1000003, row_number limit"


@register("l04_fixed_size_sample", oracle(
    "select * from (select 'temperature' as sample, row_number, machine_id_std, event_ts, round(temperature, 6) as value from t_ds "
    f"where event_ts is not null and temperature is not null {_SAMPLE_ORDER} 8000) "
    "union all select * from (select 'pressure', row_number, machine_id_std, event_ts, round(pressure_bar, 6) from p_ds "
    f"where event_ts is not null and pressure_bar is not null {_SAMPLE_ORDER} 8000) "
    "union all select * from (select 'both', row_number, machine_id_std, event_ts, round(temperature, 6) from "
    "(select t.row_number, machine_id_std, event_ts, t.temperature, p.pressure_bar, p.row_number as p_row from t_ds t join p_ds p using (machine_id_std, event_ts) "
    "where t.temperature is not null and p.pressure_bar is not null) order by (row_number * 2654435761 + p_row) % 1000003, row_number, p_row limit 12000)", _DS_CTES))
def q_l04(spark, sf):
    """The three samples: each sensor's readings and the pairs measured at the same time."""
    td, pd_, _ = _datasets(spark, sf)
    h = F.pmod(F.col("row_number") * F.lit(2654435761), F.lit(1000003))

    def one(df, value, name):
        base = df.where(F.col("event_ts").isNotNull() & F.col(value).isNotNull())
        return PR.sample_rows(base, 8000, ["row_number"], hash_col=h).select(
            F.lit(name).alias("sample"), "row_number", "machine_id_std", "event_ts", r6(value).alias("value"))

    t = td.where(F.col("temperature").isNotNull()).select("row_number", "machine_id_std", "event_ts", "temperature")
    p = pd_.where(F.col("pressure_bar").isNotNull()).select(F.col("row_number").alias("p_row"), "machine_id_std", "event_ts")
    both = PR.sample_rows(t.join(p, ["machine_id_std", "event_ts"]), 12000, ["row_number", "p_row"],
                          hash_col=F.pmod(F.col("row_number") * F.lit(2654435761) + F.col("p_row"), F.lit(1000003)))
    return one(td, "temperature", "temperature").unionByName(one(pd_, "pressure_bar", "pressure")).unionByName(
        both.select(F.lit("both").alias("sample"), "row_number", "machine_id_std", "event_ts", r6("temperature").alias("value")))


@register("j05_exact_time_join", oracle(
    "select t.machine_id_std, t.event_ts, round(t.temperature, 6) as temperature, round(p.pressure_bar, 6) as pressure_bar "
    "from (select machine_id_std, event_ts, temperature from t_ds where machine_id_std is not null and event_ts is not null and temperature is not null) t "
    "join (select machine_id_std, event_ts, pressure_bar from p_ds where machine_id_std is not null and event_ts is not null and pressure_bar is not null) p "
    "using (machine_id_std, event_ts)", _DS_CTES))
def q_j05(spark, sf):
    td, pd_, _ = _datasets(spark, sf)
    j = PR.common_sensor_frame(td, pd_)
    return j.select("machine_id_std", "event_ts", r6("temperature").alias("temperature"), r6("pressure_bar").alias("pressure_bar"))


_COMMON_SQL = ("select machine_id_std from t_ds where machine_id_std is not null intersect select machine_id_std from p_ds "
               "where machine_id_std is not null intersect select machine_id_std from i_ds where machine_id_std is not null")


@register("j08_common_machines", oracle(_COMMON_SQL, _DS_CTES))
def q_j08(spark, sf):
    return PR.common_machines(list(_datasets(spark, sf)))


@register("b03_intersect", oracle("select count(*) as common_machines from (" + _COMMON_SQL + ")", _DS_CTES))
def q_b03(spark, sf):
    return PR.common_machines(list(_datasets(spark, sf))).agg(F.count(F.lit(1)).cast("bigint").alias("common_machines"))


@register("a21_coverage_window", oracle(
    "select case when max(start) <= min(\"end\") then max(start) end as common_start, case when max(start) <= min(\"end\") then min(\"end\") end as common_end, "
    "case when max(start) <= min(\"end\") then round((epoch(min(\"end\")) - epoch(max(start))) / 3600.0, 6) end as overlap_hours "
    f"from ({_OVERVIEW_SQL})", _DS_CTES))
def q_a21(spark, sf):
    c = PR.coverage_window(_overviews(spark, sf))
    return c.select("common_start", "common_end", r6("overlap_hours").alias("overlap_hours"))


@register("a22_normalization_summary", oracle(
    "select 'capteurs_temperature' as dataset_name, (select count(*) from t_raw) as rows_before, (select count(*) from t_dedup) as rows_after_dedup, "
    "(select count(*) from t_windows) as fahrenheit_windows_detected, (select count(*) from t_norm where detected_unit = 'F') as rows_converted_to_celsius "
    "union all select 'capteurs_pression', (select count(*) from p_raw), (select count(*) from p_dedup), 0, 0 "
    "union all select 'releves_incidents', (select count(*) from i_raw), (select count(*) from i_dedup), 0, 0"))
def q_a22(spark, sf):
    c = L.chain(spark, sf)
    t, p, i = c.raw()
    norm, win = c.t_normalized()
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    rows = [
        ("capteurs_temperature", n(t), n(c.t_deduped()), n(win), norm.where("detected_unit = 'F'").agg(F.count(F.lit(1))).scalar()),
        ("capteurs_pression", n(p), n(c.p_deduped()), F.lit(0), F.lit(0)),
        ("releves_incidents", n(i), n(c.i_silver()), F.lit(0), F.lit(0)),
    ]
    one = spark.range(1)
    parts = [one.select(F.lit(name).alias("dataset_name"), a.cast("bigint").alias("rows_before"), b.cast("bigint").alias("rows_after_dedup"),
                        w.cast("bigint").alias("fahrenheit_windows_detected"), cv.cast("bigint").alias("rows_converted_to_celsius"))
             for name, a, b, w, cv in rows]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("a23_silver_overview", oracle(
    "select 'capteurs_temperature' as dataset_name, count(*) as rows, count(*) filter (where is_missing_v and sensor_value is not null) as rows_imputed, "
    "count(*) filter (where is_duplicate) as duplicates_flagged from t_silver "
    "union all select 'capteurs_pression', count(*), count(*) filter (where is_missing_v and sensor_value is not null), count(*) filter (where is_duplicate) from p_silver "
    "union all select 'releves_incidents', count(*), 0, count(*) filter (where is_duplicate) from i_dedup"))
def q_a23(spark, sf):
    c = L.chain(spark, sf)

    def ov(df, name, imputed):
        return df.agg(F.count(F.lit(1)).alias("rows"), (F.count_if("was_imputed") if imputed else F.lit(0)).alias("rows_imputed"),
                      F.count_if("is_duplicate").alias("duplicates_flagged")).select(
            F.lit(name).alias("dataset_name"), big("rows"), big("rows_imputed"), big("duplicates_flagged"))

    return ov(c.t_silver(), "capteurs_temperature", True).unionByName(ov(c.p_silver(), "capteurs_pression", True)).unionByName(
        ov(c.i_silver(), "releves_incidents", False))


@register("b01_union_by_name", oracle(
    "select dataset_name, target_column, method as recommended_method, " + ", ".join(f"round({c}, 4) as {c}" for c in _METRIC_COLS)
    + " from ti_metrics union all select 'releves_incidents', 'severity', 'rule_based_no_imputation', "
    + ", ".join("null" for _ in _METRIC_COLS), _IMP_CTES))
def q_b01(spark, sf):
    m = _t_metrics(spark, sf).withColumnRenamed("method", "recommended_method").drop("masked_rows")
    out = m.unionByName(impute.severity_policy_row(spark).drop("decision_reason"), allowMissingColumns=True)
    return out.select("dataset_name", "target_column", "recommended_method", *[F.round(c, 4).alias(c) for c in _METRIC_COLS])

