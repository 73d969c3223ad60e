"""DuckDB oracle SQL mirroring the Spark plans (used by the correctness gate).

Every oracle query is ``WITH <all layer CTEs> <final select>``; DuckDB only
evaluates the CTEs the final select reaches.  The layer CTEs restate the
rules of each operator in plain SQL so the Spark DataFrame plans are checked
against an independent formulation.
"""

from __future__ import annotations

from forgeline.functions.expr import INCIDENT_TYPE_COLUMNS
from forgeline.sources import fixtures as fx

# white space as the engine strips it (the characters beyond 127 don't occur in the fixtures)
WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31)"


def strip(c: str) -> str:
    return f"trim({c}, {WS})"


def clean(c: str) -> str:
    """Raw text as Bronze stores it: stripped, blank as NULL."""
    return f"nullif({strip(c)}, '') as {c}"


DIGITS = "regexp_extract({c}, '([0-9]+)[^0-9]*$', 1)"


def mcode(c: str) -> str:
    d = DIGITS.format(c=c)
    return f"(case when try_cast(nullif({d}, '') as bigint) is not null then printf('MACH-%02d', try_cast(nullif({d}, '') as bigint)) end)"


def ts_parse(c: str) -> str:
    return f"try_cast(regexp_replace(replace({strip(c)}, 'T', ' '), '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$', '') as timestamp)"


def num(c: str) -> str:
    v = f"try_cast({strip(c)} as double)"
    return f"(case when not isnan({v}) and not isinf({v}) then {v} end)"


def blank(c: str) -> str:
    return f"(nullif({strip(c)}, '') is null)"


def sensor_valid(value_raw: str) -> str:
    return (
        f"not {blank('machine_id_raw')} and try_cast(nullif({DIGITS.format(c='machine_id_raw')}, '') as bigint) is not null"
        f" and not {blank('timestamp_raw')} and {ts_parse('timestamp_raw')} is not null"
        f" and ({blank(value_raw)} or try_cast(nullif({strip(value_raw)}, '') as double) is not null)"
    )


FLAGS = INCIDENT_TYPE_COLUMNS


def _incident_valid() -> str:
    sev = f"try_cast(nullif({strip('severity')}, '') as int)"
    occ = f"try_cast(trim(concat_ws(' ', nullif({strip('date')}, ''), coalesce(nullif({strip('time')}, ''), ''))) as timestamp)"
    flags = " and ".join(f"(nullif({strip(f)}, '') is null or try_cast({strip(f)} as int) is not null)" for f in FLAGS)
    return (
        f"not {blank('incident_id')} and not {blank('machine_id')}"
        f" and try_cast(nullif({DIGITS.format(c='machine_id')}, '') as bigint) is not null"
        f" and not {blank('date')} and not {blank('time')} and not {blank('severity')}"
        f" and {occ} is not null and {sev} is not null and {sev} between 1 and 5 and {flags}"
    )


def _dedup_cte(src: str, value: str, compare: list[str], carry: list[str]) -> str:
    strict = " and ".join(
        f"(min({c}) is not distinct from max({c}) and (count({c}) = 0 or count({c}) = count(*)))" for c in compare
    )
    firsts = ", ".join(f"arg_min_null({c}, row_number) as {c}" for c in carry)
    return f"""select machine_id_std, event_ts, {firsts},
    arg_min_null({value}, row_number) as _first_value,
    count(*) as records_in_group, count({value}) as _n_val, min({value}) as _vmin, max({value}) as _vmax,
    quantile_cont({value}, 0.5) as _vmed, {strict} as _strict
  from {src} group by machine_id_std, event_ts"""


def _resolve(value: str) -> str:
    return f"""*, case when records_in_group = 1 then 'unique' when _strict then 'strict_duplicate_drop'
      when _n_val = 0 then 'all_missing_keep_first' when _vmin = _vmax then 'keep_non_missing_value'
      else 'median_conflict_resolution' end as dedupe_resolution,
    case when records_in_group = 1 or _strict then _first_value when _n_val = 0 then null
      when _vmin = _vmax then _vmin else _vmed end as {value},
    records_in_group > 1 as is_duplicate"""


T_COLS = ["machine_id_raw", "timestamp_raw", "temperature_raw", "temperature", "is_missing",
          "temperature_original", "temperature_normalized", "detected_unit", "normalization_rule"]
P_COLS = ["machine_id_raw", "timestamp_raw", "pressure_raw", "pressure_bar", "is_missing"]

INC_COLS = ["row_number", "machine_id", "date", "time", "severity_raw", "operator_name", "operator_badge", "shift",
            "comment", *FLAGS, "machine_id_std", "event_ts", "severity"]


def _nn_count(cols: list[str]) -> str:
    return " + ".join(f"(case when {c} is not null then 1 else 0 end)" for c in cols if c != "row_number") + " + 1"


def layer_ctes() -> list[tuple[str, str]]:
    ctes: list[tuple[str, str]] = [
        ("t_raw", fx.sql_for_duckdb(fx.TEMPERATURE_RAW_SQL)),
        ("p_raw", fx.sql_for_duckdb(fx.PRESSURE_RAW_SQL)),
        ("i_raw", fx.sql_for_duckdb(fx.INCIDENT_RAW_SQL)),
        ("w_daily", fx.sql_for_duckdb(fx.WEATHER_DAILY_SQL)),
        ("w_cells", fx.sql_for_duckdb(fx.WEATHER_CELLS_SQL)),
        # temperature ------------------------------------------------------
        ("t_parsed", f"""select row_number, {clean('machine_id_raw')}, {clean('timestamp_raw')}, {clean('temperature_raw')},
            {mcode('machine_id_raw')} as machine_id_std, {ts_parse('timestamp_raw')} as event_ts,
            {num('temperature_raw')} as temperature, {num('temperature_raw')} is null as is_missing
          from t_raw where {sensor_valid('temperature_raw')}"""),
        ("t_base", """select machine_id_std, coalesce(quantile_cont(case when temperature between 10 and 80 then temperature end, 0.5),
            quantile_cont(temperature, 0.5)) as baseline_celsius
          from t_parsed where temperature is not null group by machine_id_std"""),
        ("t_s", """select p.*, b.baseline_celsius, (p.temperature - 32.0) * 5.0 / 9.0 as _conv,
            coalesce(p.temperature is not null and p.temperature between 80 and 180
              and (p.temperature - 32.0) * 5.0 / 9.0 between 10 and 80
              and abs((p.temperature - 32.0) * 5.0 / 9.0 - b.baseline_celsius) + 3 < abs(p.temperature - b.baseline_celsius), false) as _suspected
          from t_parsed p left join t_base b using (machine_id_std)"""),
        ("t_g", """select *, case when coalesce(epoch(event_ts) - epoch(lag(event_ts) over w) > 7200, false) or not _suspected then 1 else 0 end as _brk
          from t_s window w as (partition by machine_id_std order by event_ts, row_number)"""),
        ("t_seg", """select *, sum(_brk) over (partition by machine_id_std order by event_ts, row_number
            rows between unbounded preceding and current row) as _segment from t_g"""),
        ("t_run", """select *, sum(case when _suspected then 1 else 0 end) over (partition by machine_id_std, _segment) as _run_len from t_seg"""),
        ("t_norm", """select row_number, machine_id_raw, timestamp_raw, temperature_raw, machine_id_std, event_ts, temperature, is_missing,
            temperature as temperature_original,
            case when _suspected and _run_len >= 3 then _conv else temperature end as temperature_normalized,
            case when _suspected and _run_len >= 3 then 'F' else 'C' end as detected_unit,
            case when _suspected and _run_len >= 3 then 'fahrenheit_window_to_celsius' else 'identity' end as normalization_rule,
            _suspected and _run_len >= 3 as _converted, _suspected, _segment, baseline_celsius
          from t_run"""),
        ("t_windows", """select machine_id_std, min(event_ts) as window_start, max(event_ts) as window_end,
            count(*) as points_converted, avg(temperature) as raw_mean, avg(temperature_normalized) as converted_mean_celsius,
            any_value(baseline_celsius) as baseline_celsius
          from t_norm where _converted group by machine_id_std, _segment"""),
        ("t_dd", _dedup_cte("t_norm", "temperature_normalized",
                            [c for c in T_COLS], ["row_number", *[c for c in T_COLS if c != "temperature_normalized"]])),
        ("t_dedup", f"select {_resolve('temperature_normalized')} from t_dd"),
        # pressure ---------------------------------------------------------
        ("p_parsed", f"""select row_number, {clean('machine_id_raw')}, {clean('timestamp_raw')}, {clean('pressure_raw')},
            {mcode('machine_id_raw')} as machine_id_std, {ts_parse('timestamp_raw')} as event_ts,
            {num('pressure_raw')} as pressure_bar, {num('pressure_raw')} is null as is_missing
          from p_raw where {sensor_valid('pressure_raw')}"""),
        ("p_dd", _dedup_cte("p_parsed", "pressure_bar", P_COLS, ["row_number", *[c for c in P_COLS if c != "pressure_bar"]])),
        ("p_dedup", f"select {_resolve('pressure_bar')} from p_dd"),
        # incidents --------------------------------------------------------
        ("i_parsed", f"""select row_number, nullif(upper({strip('incident_id')}), '') as incident_id, machine_id, date, time,
            severity as severity_raw, operator_name, operator_badge, shift, comment,
            {", ".join(f"coalesce(try_cast({strip(f)} as int), 0) as {f}" for f in FLAGS)},
            {mcode('machine_id')} as machine_id_std,
            try_cast(trim(concat_ws(' ', nullif({strip('date')}, ''), coalesce(nullif({strip('time')}, ''), ''))) as timestamp) as event_ts,
            try_cast(nullif({strip('severity')}, '') as int) as severity
          from i_raw where {_incident_valid()}"""),
        ("i_ranked", f"""select *, count(*) over (partition by incident_id) as records_in_group,
            row_number() over (partition by incident_id order by {_nn_count(INC_COLS + ['incident_id'])} desc, row_number) as _rk
          from i_parsed"""),
        ("i_dedup", """select * exclude (_rk), records_in_group > 1 as is_duplicate,
            case when records_in_group > 1 then 'keep_most_complete_row' else 'unique' end as dedupe_resolution
          from i_ranked where _rk = 1"""),
        # silver with group-mean imputation --------------------------------
        ("t_gm", "select machine_id_std, avg(temperature_normalized) as _gm from t_dedup group by machine_id_std"),
        ("t_silver", """select d.*, coalesce(d.temperature_normalized, g._gm, (select avg(temperature_normalized) from t_dedup)) as sensor_value,
            d.temperature_normalized is null as is_missing_v, 'temperature' as sensor_type, 'C' as unit
          from t_dedup d left join t_gm g using (machine_id_std)"""),
        ("p_gm", "select machine_id_std, avg(pressure_bar) as _gm from p_dedup group by machine_id_std"),
        ("p_silver", """select d.*, coalesce(d.pressure_bar, g._gm, (select avg(pressure_bar) from p_dedup)) as sensor_value,
            d.pressure_bar is null as is_missing_v, 'pressure' as sensor_type, 'bar' as unit
          from p_dedup d left join p_gm g using (machine_id_std)"""),
        ("s_sensors", """select machine_id_std, event_ts, sensor_type, sensor_value, is_missing_v as is_missing from t_silver
          union all select machine_id_std, event_ts, sensor_type, sensor_value, is_missing_v as is_missing from p_silver"""),
        # gold -------------------------------------------------------------
        ("g_hourly", """select machine_id_std, date_trunc('hour', event_ts) as window_start,
            avg(case when sensor_type = 'temperature' then sensor_value end) as temp_mean_1h,
            max(case when sensor_type = 'temperature' then sensor_value end) as temp_max_1h,
            sum(case when sensor_type = 'temperature' then cast(is_missing as int) end) as temp_missing_count,
            sum(case when sensor_type = 'pressure' then cast(is_missing as int) end) as pressure_missing_count,
            avg(case when sensor_type = 'pressure' then sensor_value end) as pressure_mean_1h,
            max(case when sensor_type = 'pressure' then sensor_value end) as pressure_max_1h
          from s_sensors where sensor_value is not null group by 1, 2"""),
        ("g_inc", f"""select machine_id_std, date_trunc('hour', event_ts) as window_start,
            count(incident_id) as incident_count_1h, max(severity) as incident_max_severity_1h,
            {", ".join(f"sum({f}) as {f}" for f in FLAGS)}
          from i_dedup group by 1, 2"""),
        ("g_join", f"""select h.*, coalesce(i.incident_count_1h, 0) as incident_count_1h, i.incident_max_severity_1h,
            {", ".join(f"coalesce(i.{f}, 0) as {f}" for f in FLAGS)}
          from g_hourly h left join g_inc i using (machine_id_std, window_start)"""),
        ("g_roll", _gold_windows_sql()),
        ("g_split", """select g.*, case when epoch_us(window_start) < (select quantile_cont(epoch_us(window_start), 0.7) from g_hourly) then 'train'
            when epoch_us(window_start) < (select quantile_cont(epoch_us(window_start), 0.85) from g_hourly) then 'validation'
            else 'test' end as split_set from g_roll g"""),
    ]
    return ctes


def _gold_windows_sql() -> str:
    parts = []
    for h in (6, 12, 24):
        for p in ("temp", "pressure"):
            fr = f"(w rows between {h - 1} preceding and current row)"
            parts += [
                f"avg({p}_mean_1h) over {fr} as {p}_mean_{h}h",
                f"max({p}_max_1h) over {fr} as {p}_max_{h}h",
                f"stddev_samp({p}_mean_1h) over {fr} as {p}_std_{h}h",
            ]
    for p in ("temp", "pressure"):
        parts.append(f"{p}_mean_1h - lag({p}_mean_1h, 6) over w as {p}_trend_6h")
    parts += [
        "sum(incident_count_1h) over (w rows between 23 preceding and current row) as incident_count_prev_24h",
        "max(incident_max_severity_1h) over (w rows between 23 preceding and current row) as incident_max_severity_prev_24h",
        "sum(incident_count_1h) over (w rows between 167 preceding and current row) as incident_count_prev_7d",
        *[f"sum({f}) over (w rows between 23 preceding and current row) as {f}_count_prev_24h" for f in FLAGS],
        "(epoch(window_start) - epoch(last_value(case when incident_count_1h > 0 then window_start end ignore nulls) over "
        "(w rows between unbounded preceding and current row))) / 3600.0 as hours_since_last_incident",
    ]
    for h in (6, 12, 24, 48):
        parts.append(f"sum(incident_count_1h) over (w rows between current row and {h - 1} following) as future_incident_count_{h}h")
    inner = ",\n      ".join(parts)
    return f"""select *, (temp_mean_1h - temp_mean_24h) / nullif(temp_std_24h, 0) as _z from (
      select *, window_start + interval 1 hour as window_end,
      {inner}
      from g_join window w as (partition by machine_id_std order by window_start))"""


def oracle(final_select: str, extra: list[tuple[str, str]] | None = None) -> str:
    body = ",\n".join(f"{name} as (\n{sql}\n)" for name, sql in layer_ctes() + list(extra or []))
    return "with " + body + "\n" + final_select
