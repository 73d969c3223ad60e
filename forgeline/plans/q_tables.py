"""Queries: files, stored tables, sinks and dimensions.

These queries write the fixture layers to Parquet / CSV under the shared
checkpoint folder and read them back, so each one exercises the real reader
or writer.  Written paths are memoised per session and directory.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from forgeline.functions.expr import INCIDENT_TYPE_COLUMNS
from forgeline.operators import dedup, dims, parse, validate
from forgeline.operators import profile as PR
from forgeline.operators.features import GOLD_DECIMALS, LABEL_HOURS, gold_table
from forgeline.plans import layers as L
from forgeline.plans.oracle import clean, layer_ctes, oracle
from forgeline.plans.q_profile import _DS_CTES, I_BUSINESS
from forgeline.plans.q_silver import _CHOICE_SQL, _IMP_CTES, _codes_sql, _incident_rules_sql, _regression_ctes, _sensor_rules_sql, _u
from forgeline.plans.q_weather import _W_CTES, PAGE_CTES, PAGE_SHIFT_YEARS, _store, weather_pages
from forgeline.plans.registry import big, register
from forgeline.session import scratch_path
from forgeline.sources import files, fs, sinks

_ROOTS: dict[tuple, str] = {}


def _root(spark, sf) -> str:
    key = L.chain_key(spark, sf)
    if key not in _ROOTS:
        _ROOTS[key] = scratch_path(spark, f"tables-{uuid.uuid4().hex}")
    return _ROOTS[key]


def _once(spark, sf, name: str, write) -> str:
    path = os.path.join(_root(spark, sf), name)
    if not fs.exists(spark, os.path.join(path, "_SUCCESS")):
        write(path)
    return path


# ------------------------------------------------------------------ S01-S06
# the writer trims cells unless told not to
_KEEP = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _export_sources(spark, sf) -> str:
    """Write the three raw exports as delimited files (one folder per file stem)."""
    d = os.path.join(_root(spark, sf), "sources")
    if not fs.exists(spark, os.path.join(d, "_done")):
        t, p, i = L.chain(spark, sf).raw()
        # a forgotten copy beside the export is no source
        spark.createDataFrame([("x", "y", "z")], "machine_id string, timestamp string, temperature string").write.mode("overwrite").option(
            "header", True).csv(os.path.join(d, "capteurs_temperature.csv.bak"))
        t.select(F.col("machine_id_raw").alias("machine_id"), F.col("timestamp_raw").alias("timestamp"),
                 F.col("temperature_raw").alias("temperature")).write.mode("overwrite").options(**_KEEP).option("header", True).option(
            "sep", ";").csv(os.path.join(d, "capteurs_temperature.csv"))
        p.select(F.col("machine_id_raw").alias("machine_id"), F.col("timestamp_raw").alias("timestamp"),
                 F.col("pressure_raw").alias("pressure_bar")).write.mode("overwrite").options(**_KEEP).option("header", True).option(
            "sep", "\t").csv(os.path.join(d, "capteurs_pression.tsv"))
        i.drop("row_number").write.mode("overwrite").option("header", True).option("sep", ",").csv(
            os.path.join(d, "releves_incidents.csv"))
        fs.touch(spark, os.path.join(d, "_done"))
    return d


def _first_part(spark, path: str) -> str:
    parts = [full for name, full, size in fs.list_names(spark, path) if name.startswith("part-") and size > 0]
    return parts[0]


@register("s04_delimited_scan", oracle(
    "select machine_id_raw as machine_id, timestamp_raw as timestamp, temperature_raw as temperature, ';' as separator from t_raw "
    "union all select machine_id_raw, timestamp_raw, pressure_raw, chr(9) from p_raw"))
def q_s04(spark, sf):
    """S01 discovery, S03 delimiter sniffing, S04 all-string read, S06 value column choice."""
    d = _export_sources(spark, sf)
    found = files.find_source_files(d, spark)
    files.require_sources(found)
    out = None
    for kind in ("temperature", "pressure"):
        sep = files.sniff_delimiter(spark, _first_part(spark, found[kind]))
        df = files.read_delimited(spark, found[kind], sep)
        v = "temperature" if kind == "temperature" else files.value_column(df, "pressure_bar", "pressure")
        part = df.select("machine_id", "timestamp", F.col(v).alias("temperature"), F.lit(sep).alias("separator"))
        out = part if out is None else out.unionByName(part)
    return out


@register("s05_typed_enrich_scan", oracle(
    "select incident_id, machine_id_original, machine_id_std, event_ts, cast(severity as bigint) as severity, operator_name, comment, "
    + ", ".join(f"cast({c} as bigint) as {c}" for c in INCIDENT_TYPE_COLUMNS)
    + f", ',' as separator, true as from_part_file, {len(I_BUSINESS)} as business_columns from i_ds", _DS_CTES))
def q_s05(spark, sf):
    """The incident export read from its files, enriched, its numbers typed, its business columns told apart."""
    d = _export_sources(spark, sf)
    found = files.find_source_files(d, spark)
    sep = files.sniff_delimiter(spark, _first_part(spark, found["incident"]))
    df = files.read_delimited(spark, found["incident"], sep)
    part = df.select("source_file").first()[0]
    df = PR.enrich(df.drop("source_file"), part, sep)
    numbers = ["severity", *INCIDENT_TYPE_COLUMNS]
    df = df.withColumns({c: F.col(c).try_cast("int") for c in numbers})
    return df.select("incident_id", "machine_id_original", "machine_id_std", "event_ts", *[big(c) for c in ("severity",)], "operator_name", "comment",
                     *[big(c) for c in INCIDENT_TYPE_COLUMNS], "separator", F.col("source_file").startswith("part-").alias("from_part_file"),
                     F.lit(len(PR.business_columns(df))).cast("bigint").alias("business_columns"))


@register("s07_rows_of_part_files", oracle(
    """select machine_id_std, event_ts, round(case when records_in_group = 1 or _strict then _first_value when _n_val = 0 then null
      when _vmin = _vmax then _vmin else _vmed end, 6) as temperature, records_in_group, first_raw
    from (select machine_id_std, event_ts, arg_min_null(temperature, place) as _first_value, arg_min_null(machine_id_raw, place) as first_raw,
        count(*) as records_in_group, count(temperature) as _n_val, min(temperature) as _vmin, max(temperature) as _vmax,
        quantile_cont(temperature, 0.5) as _vmed,
        (min(machine_id_raw) = max(machine_id_raw) and min(timestamp_raw) = max(timestamp_raw) and min(temperature_raw) is not distinct from max(temperature_raw)
          and (count(temperature_raw) = 0 or count(temperature_raw) = count(*))) as _strict
      from (select *, (row_number % 3) * 10000000000 + row_number as place from t_parsed) group by 1, 2)"""))
def q_s07_parts(spark, sf):
    """Three part files that hold rows of the same keys: read, numbered per file, deduplicated in (file, number) order."""
    def write(path):
        t, _, _ = L.chain(spark, sf).raw()
        t = t.withColumn("_k", (F.col("row_number") % 3).cast("int"))
        parts = t.repartitionByRange(3, "_k").sortWithinPartitions("_k", "row_number")
        parts.select(F.col("machine_id_raw").alias("machine_id"), F.col("timestamp_raw").alias("timestamp"),
                     F.col("temperature_raw").alias("temperature")).write.mode("overwrite").options(**_KEEP).option("header", True).option("sep", ";").csv(path)

    path = _once(spark, sf, "parts/capteurs_temperature.csv", write)
    raw = files.temperature_bronze_input(files.with_file_row_number(files.read_delimited(spark, path, ";")))
    rows = parse.parse_temperature(sinks.stripped(validate.validate_temperature(raw)).where("parse_ok").drop("parse_ok", "rejected_reason"))
    out = dedup.dedup_sensor(rows, "temperature")
    return out.select("machine_id_std", "event_ts", F.round("temperature", 6).alias("temperature"), big("records_in_group"),
                      F.col("machine_id_raw").alias("first_raw"))


# ------------------------------------------------------------------ Bronze / Silver tables
def _bronze_path(spark, sf) -> str:
    def write(path):
        t, _, _ = L.chain(spark, sf).raw()
        sinks.write_bronze(validate.validate_temperature(t), os.path.dirname(path), os.path.basename(path), "fixture", "overwrite")
    return _once(spark, sf, "bronze_temperature", write)


_SEED_SQL = " union all ".join(f"select {n + 1} as machine_id, '{c[0]}' as machine_code" for n, c in enumerate(dims.MACHINE_SEED))
_T_CODES = _codes_sql(_sensor_rules_sql("temperature_raw"))
_P_CODES = _codes_sql(_sensor_rules_sql("pressure_raw"))
_I_CODES = _codes_sql(_incident_rules_sql())


@register("k01_bronze_append", oracle(
    f"select row_number, {clean('machine_id_raw')}, {clean('timestamp_raw')}, {clean('temperature_raw')}, {_T_CODES} is null as parse_ok, "
    f"{_T_CODES} as rejected_reason, 'fixture' as ingestion_batch_id from t_raw"))
def q_k01(spark, sf):
    b = spark.read.parquet(_bronze_path(spark, sf))
    return b.select("row_number", "machine_id_raw", "timestamp_raw", "temperature_raw", "parse_ok", "rejected_reason", "ingestion_batch_id")


@register("s08_bronze_accepted_scan", oracle(
    f"select row_number, {clean('machine_id_raw')}, {clean('timestamp_raw')}, {clean('temperature_raw')} from t_raw where {_T_CODES} is null"))
def q_s08(spark, sf):
    b = spark.read.parquet(_bronze_path(spark, sf))
    return files.accepted_rows(b, ["row_number", "machine_id_raw", "timestamp_raw", "temperature_raw"])


def _silver_path(spark, sf) -> str:
    def write(path):
        sinks.write_silver_sensors(L.chain(spark, sf).sensors(), os.path.dirname(path), "fixture")
    return _once(spark, sf, "silver_sensor_reading", write)


_DEC3 = "cast(cast(cast(sensor_value as varchar) as decimal(12,3)) as double)"


@register("k04_silver_sensor_write", oracle(
    f"select machine_id_std, event_ts as observed_at, sensor_type, {_DEC3} as sensor_value, is_missing, false as is_outlier from s_sensors"))
def q_k04(spark, sf):
    s = spark.read.parquet(_silver_path(spark, sf))
    return s.select("machine_id_std", "observed_at", "sensor_type", F.col("sensor_value").cast("double").alias("sensor_value"),
                    "is_missing", "is_outlier")


@register("s09_silver_by_sensor_type", oracle(
    f"select machine_id_std, event_ts, {_DEC3} as sensor_value, is_missing from s_sensors where sensor_type = 'pressure'"))
def q_s09(spark, sf):
    s = spark.read.parquet(_silver_path(spark, sf)).withColumnRenamed("observed_at", "event_ts")
    p = files.silver_by_type(s, "pressure")
    return p.select("machine_id_std", "event_ts", F.col("sensor_value").cast("double").alias("sensor_value"), "is_missing")


@register("s10_date_range_probe", oracle("select cast(min(cast(event_ts as date)) as timestamp) as start_date, cast(max(cast(event_ts as date)) as timestamp) as end_date from t_parsed"))
def q_s10(spark, sf):
    r = files.date_range(L.chain(spark, sf).t_parsed())
    return r.select(F.col("start_date").cast("timestamp_ntz").alias("start_date"), F.col("end_date").cast("timestamp_ntz").alias("end_date"))


@register("k05_silver_incident_write", oracle(
    "select upper(incident_id) as incident_code, machine_id_std, coalesce(operator_name, 'UNKNOWN') as operator_key, event_ts as occurred_at, "
    "cast(severity as bigint) as severity, true as is_label_event, "
    + ", ".join(f"cast({c} as bigint) as {c}" for c in INCIDENT_TYPE_COLUMNS) + " from i_dedup"))
def q_k05(spark, sf):
    def write(path):
        sinks.write_table(sinks.silver_incident_rows(L.chain(spark, sf).i_silver(), "fixture"), os.path.dirname(path),
                          os.path.basename(path))
    s = spark.read.parquet(_once(spark, sf, "silver_incident", write))
    return s.select("incident_code", "machine_id_std", "operator_key", "occurred_at", big("severity"), "is_label_event",
                    *[big(c) for c in INCIDENT_TYPE_COLUMNS])


def _dec(c: str, p: str) -> str:
    return f"cast(cast(cast({c} as varchar) as decimal{p}) as double) as {c}"


@register("k06_silver_weather_write", oracle(
    f"select observed_at, {_dec('temp_celsius', '(8,2)')}, {_dec('pressure_hpa', '(8,2)')}, {_dec('wind_speed_ms', '(8,2)')}, is_imputed from w_hourly",
    _W_CTES))
def q_k06(spark, sf):
    def write(path):
        sinks.write_table(sinks.silver_weather_rows(_store(spark, sf), "fixture"), os.path.dirname(path), os.path.basename(path))
    w = spark.read.parquet(_once(spark, sf, "silver_weather", write))
    return w.select("observed_at", *[F.col(c).cast("double").alias(c) for c in ("temp_celsius", "pressure_hpa", "wind_speed_ms")],
                    "is_imputed")


@register("s13_stored_weather_scan", oracle(
    "select count(*) as rows, min(observed_at) as first_hour, max(observed_at) as last_hour, count(*) filter (where is_imputed) as imputed from w_hourly",
    _W_CTES))
def q_s13(spark, sf):
    def write(path):
        _store(spark, sf).write.mode("overwrite").parquet(path)
    w = files.read_weather_store(spark, _once(spark, sf, "weather_store", write))
    return w.agg(F.count(F.lit(1)).cast("bigint").alias("rows"), F.min("observed_at").alias("first_hour"),
                 F.max("observed_at").alias("last_hour"), F.count_if("is_imputed").cast("bigint").alias("imputed"))


@register("k02_bronze_weather", oracle(
    "select cast(epoch(observed_at) / 3600 - (select min(epoch(observed_at) / 3600) from w_hourly) + 1 as bigint) as row_number, "
    "cast(observed_at as varchar) as timestamp_raw, round(temp_celsius, 6) as temperature, round(wind_speed_ms, 6) as wind, "
    "cast(null as varchar) as humidity_raw, is_imputed, true as parse_ok, 'fixture' as ingestion_batch_id from w_hourly", _W_CTES))
def q_k02(spark, sf):
    b = sinks.bronze_weather_rows(_store(spark, sf), "fixture")
    number = lambda c, out: F.round(F.col(c).cast("double"), 6).alias(out)
    return b.select(big("row_number"), "timestamp_raw", number("temp_raw", "temperature"), number("wind_speed_raw", "wind"), "humidity_raw", "is_imputed",
                    "parse_ok", "ingestion_batch_id")


def _gold_path(spark, sf) -> str:
    def write(path):
        sinks.write_table(gold_table(L.chain(spark, sf).gold()), os.path.dirname(path), os.path.basename(path))
    return _once(spark, sf, "gold_machine_hourly_feature", write)


def _gold_stored_sql(source: str = "g_split") -> str:
    """All stored Gold columns as doubles and bigints."""
    dec = lambda c, p: f"cast(cast(cast({c} as varchar) as decimal{p}) as double) as {c}"
    out = ["machine_id_std", "window_start", "window_end"]
    for precision, names in GOLD_DECIMALS.items():
        for c in names:
            if c == "temp_zscore_24h":
                out.append(dec("(case when _z is not null then greatest(-10.0, least(10.0, _z)) end)", precision).rsplit(" as ", 1)[0] + f" as {c}")
            elif not c.startswith("ambient_"):
                out.append(dec(c, precision))
    out += [f"cast(coalesce({c}, 0) as bigint) as {c}" for c in ("incident_count_prev_24h", "incident_count_prev_7d")]
    out += ["cast(incident_max_severity_prev_24h as bigint) as incident_max_severity_prev_24h"]
    out += [f"cast(coalesce({c}_count_prev_24h, 0) as bigint) as {c}_count_prev_24h" for c in INCIDENT_TYPE_COLUMNS]
    out += [f"coalesce(future_incident_count_{h}h > 0, false) as label_failure_next_{h}h" for h in LABEL_HOURS]
    return f"select {', '.join([*out, 'split_set'])} from {source}"


def _gold_stored(g):
    decimals = [F.col(c).cast("double").alias(c) for names in GOLD_DECIMALS.values() for c in names if not c.startswith("ambient_")]
    ints = ["incident_count_prev_24h", "incident_count_prev_7d", "incident_max_severity_prev_24h", *[f"{c}_count_prev_24h" for c in INCIDENT_TYPE_COLUMNS]]
    return g.select("machine_id_std", "window_start", "window_end", *decimals, *[big(c) for c in ints], *[f"label_failure_next_{h}h" for h in LABEL_HOURS], "split_set")


@register("k07_gold_write", oracle(_gold_stored_sql()))
def q_k07(spark, sf):
    return _gold_stored(spark.read.parquet(_gold_path(spark, sf)))


@register("k08_full_refresh", oracle("select count(*) as rows from g_roll"))
def q_k08(spark, sf):
    path = _gold_path(spark, sf)
    g = spark.read.parquet(path)
    # two full refreshes of the same table: the second replaces, never appends
    root = os.path.join(_root(spark, sf), f"refresh-{uuid.uuid4().hex}")
    sinks.write_table(g, root, "gold")
    sinks.write_table(g, root, "gold")
    return spark.read.parquet(sinks.table_path(root, "gold")).agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


# ------------------------------------------------------------------ the whole run
_RUNS: dict[tuple, tuple[str, dict]] = {}


def _run(spark, sf) -> tuple[str, dict]:
    """One batch run over the fixture, with weather pages and artifacts: (folder, summary)."""
    from forgeline.plans.pipeline import run_from_bronze_inputs

    key = L.chain_key(spark, sf)
    if key not in _RUNS:
        t, p, i = L.chain(spark, sf).raw()
        out = os.path.join(_root(spark, sf), f"run-{uuid.uuid4().hex}")
        counts = run_from_bronze_inputs(spark, t, p, i, out, weather_pages=weather_pages(spark, sf), batch_id="fixture", mask_hash=_u, estimator="least_squares",
                                        artifacts_dir=os.path.join(out, "artifacts"))
        _RUNS[key] = out, counts
    return _RUNS[key]


# what the run's weather must be: parsed days of the months of the sensors' range, the rest of the range from monthly means
RUN_CTES = _W_CTES + PAGE_CTES + [
    ("r_bounds", "select cast(min(cast(event_ts as date)) as timestamp) as s, cast(max(cast(event_ts as date)) as timestamp) as e from t_parsed"),
    ("r_hours", "select unnest(generate_series((select s from r_bounds), (select e from r_bounds) + interval 23 hour, interval 1 hour)) as observed_at"),
    ("r_days", f"""select day + interval {PAGE_SHIFT_YEARS} year as day, temp_celsius, round(wind_kmh / 3.6, 3) as wind_speed_ms,
        coalesce(round((p_min + p_max) / 2, 2), p_min, p_max) as pressure_hpa from w_cells_rec where day(day) % 9 <> 0
        and (year(day) + {PAGE_SHIFT_YEARS}, month(day)) in (select (year(observed_at), month(observed_at)) from r_hours)"""),
    ("r_means", "select month(day) as month, avg(temp_celsius) as temp_celsius, avg(pressure_hpa) as pressure_hpa, avg(wind_speed_ms) as wind_speed_ms from r_days group by 1"),
    ("r_weather", """select h.observed_at, case when d.day is null then m.temp_celsius else d.temp_celsius end as temp_celsius,
        case when d.day is null then m.pressure_hpa else d.pressure_hpa end as pressure_hpa,
        case when d.day is null then m.wind_speed_ms else d.wind_speed_ms end as wind_speed_ms, d.day is null as is_imputed
      from r_hours h left join r_days d on date_trunc('day', h.observed_at) = d.day left join r_means m on month(h.observed_at) = m.month"""),
]


@register("k10_run_summary", oracle(
    "select 'bronze_temperature' as stage, count(*) as rows from t_raw union all select 'bronze_pressure', count(*) from p_raw "
    "union all select 'bronze_incident', count(*) from i_raw union all select 'bronze_weather', count(*) from r_hours "
    "union all select 'silver_sensor_reading', count(*) from s_sensors union all select 'silver_temperature', count(*) from t_dedup "
    "union all select 'silver_pressure', count(*) from p_dedup union all select 'silver_weather', count(*) from r_hours "
    "union all select 'silver_incident', count(*) from i_dedup union all select 'gold_machine_hourly_feature', count(*) from g_roll "
    "union all select 'dim_machine', 15 union all select 'dim_operator', count(distinct coalesce(operator_name, 'UNKNOWN')) from i_dedup "
    "union all select 'rejected_weather', 0 "
    f"union all select 'rejected_capteurs_temperature', count(*) filter (where {_T_CODES} is not null) from t_raw "
    f"union all select 'rejected_capteurs_pression', count(*) filter (where {_P_CODES} is not null) from p_raw "
    f"union all select 'rejected_releves_incidents', count(*) filter (where {_I_CODES} is not null) from i_raw", RUN_CTES))
def q_k10(spark, sf):
    """The whole batch run (Bronze -> Silver -> Gold with weather): rows of its tables."""
    _, counts = _run(spark, sf)
    rows = [(k, int(v)) for k, v in counts.items() if not k.endswith("_method") and k != "data_quality_issue"]
    return spark.createDataFrame(rows, "stage string, rows bigint")


def _run_table(spark, sf, name: str):
    return spark.read.parquet(sinks.table_path(_run(spark, sf)[0], name))


@register("k10_run_weather", oracle(
    "select observed_at, " + ", ".join(f"round(cast(cast(cast({c} as varchar) as decimal(8,2)) as double), 1) as {c}" for c in ("temp_celsius", "pressure_hpa", "wind_speed_ms"))
    + ", is_imputed from r_weather", RUN_CTES))
def q_k10_weather(spark, sf):
    """Silver weather of the run: parsed from pages, gaps filled."""
    w = _run_table(spark, sf, "silver_weather")
    return w.select("observed_at", *[F.round(F.col(c).cast("double"), 1).alias(c) for c in ("temp_celsius", "pressure_hpa", "wind_speed_ms")], "is_imputed")


def _filled_ctes(p: str, src: str, value: str) -> list[tuple[str, str]]:
    """The three methods fitted on all observed rows of a sensor."""
    return [(f"{p}_groups", f"""select d.*, d.{value} as _bench_value, coalesce(d.{value}, gm._m, (select avg({value}) from {src})) as _cand_mean,
            coalesce(d.{value}, gm._d, (select median({value}) from {src})) as _cand_median
          from {src} d left join (select machine_id_std, avg({value}) as _m, median({value}) as _d from {src} group by 1) gm using (machine_id_std)"""),
            *_regression_ctes(p)]


def run_oracle(final_select: str) -> str:
    """The layers as a batch run builds them: each sensor filled by the method that its benchmark chose, Silver values rounded."""
    layers = layer_ctes()
    at = [n for n, _ in layers].index("s_sensors")
    pick = lambda p, dataset, kind: (
        f"select machine_id_std, event_ts, '{kind}' as sensor_type, cast(cast(cast(case (select recommended_method from r_choice where dataset_name = '{dataset}') "
        f"when 'mean' then _cand_mean when 'median' then _cand_median else _cand_iterative end as varchar) as decimal(12,3)) as double) as sensor_value, "
        f"_bench_value is null as is_missing from {p}_cands")
    own = [*_IMP_CTES, ("r_choice", _CHOICE_SQL), *_filled_ctes("tf", "t_dedup", "temperature_normalized"), *_filled_ctes("pf", "p_dedup", "pressure_bar"),
           ("s_sensors", pick("tf", "capteurs_temperature", "temperature") + " union all " + pick("pf", "capteurs_pression", "pressure"))]
    body = ",\n".join(f"{name} as (\n{sql}\n)" for name, sql in layers[:at] + own + layers[at + 1 :] + RUN_CTES)
    return "with " + body + "\n" + final_select


@register("k10_run_gold", run_oracle(
    "select g.machine_id_std, g.window_start, cast(cast(cast(g.temp_max_24h as varchar) as decimal(12,3)) as double) as temp_max_24h, "
    "cast(cast(cast(g.pressure_max_6h as varchar) as decimal(12,3)) as double) as pressure_max_6h, "
    "cast(g.incident_count_prev_24h as bigint) as incident_count_prev_24h, coalesce(g.future_incident_count_24h > 0, false) as label_failure_next_24h, "
    "g.split_set, cast(cast(cast(w.temp_celsius as varchar) as decimal(8,2)) as double) as ambient_temp_c, cast(d.machine_id as bigint) as machine_id from g_split g "
    f"left join r_weather w on w.observed_at = g.window_start join ({_SEED_SQL}) d on d.machine_code = g.machine_id_std"))
def q_k10_gold(spark, sf):
    """Values of the run's stored Gold table (made of rounded Silver), with ambient columns and machine ids."""
    g = _run_table(spark, sf, "gold_machine_hourly_feature")
    number = lambda c: F.col(c).cast("double").alias(c)
    return g.select("machine_id_std", "window_start", number("temp_max_24h"), number("pressure_max_6h"), big("incident_count_prev_24h"),
                    "label_failure_next_24h", "split_set", number("ambient_temp_c"), big("machine_id"))


@register("k09_run_artifacts", oracle(
    "select 'overview' as artifact, dataset_name as name, rows as a, imputed as b from ("
    "select 'capteurs_temperature' as dataset_name, count(*) as rows, count(*) filter (where is_missing_v and sensor_value is not null) as imputed from t_silver union all "
    "select 'capteurs_pression', count(*), count(*) filter (where is_missing_v and sensor_value is not null) from p_silver union all "
    "select 'releves_incidents', count(*), 0 from i_dedup) "
    "union all select 'deduplication_summary', 'capteurs_temperature:' || dedupe_resolution, count(*), cast(sum(records_in_group) as bigint) from t_dedup where records_in_group > 1 group by 2 "
    "union all select 'deduplication_summary', 'capteurs_pression:' || dedupe_resolution, count(*), cast(sum(records_in_group) as bigint) from p_dedup where records_in_group > 1 group by 2 "
    "union all select 'deduplication_summary', 'releves_incidents:' || dedupe_resolution, count(*), cast(sum(records_in_group) as bigint) from i_dedup where records_in_group > 1 group by 2 "
    "union all select 'temperature_normalization_windows', machine_id_std, count(*), cast(sum(points_converted) as bigint) from t_windows group by 2 "
    "union all select 'imputation_metrics', d || ':' || m, 1, 1 from (values ('capteurs_temperature'), ('capteurs_pression')) x(d), (values ('mean'), ('median'), ('iterative')) y(m) "
    "union all select 'imputation_decisions', d, 1, 1 from (values ('capteurs_temperature'), ('capteurs_pression'), ('releves_incidents')) x(d) "
    "union all select 'gold_preview', 'rows', least(20, count(*)), least(20, count(*)) from g_roll"))
def q_k09(spark, sf):
    """The six report tables of a run, read back from their files."""
    folder = os.path.join(_run(spark, sf)[0], "artifacts")
    read = lambda n: spark.read.option("header", True).csv(os.path.join(folder, n))
    one = F.lit(1)

    def rows(name, df, label, a, b):
        return df.select(F.lit(name).alias("artifact"), label.alias("name"), F.expr(a).cast("bigint").alias("a") if isinstance(a, str) else a.cast("bigint").alias("a"),
                         F.expr(b).cast("bigint").alias("b") if isinstance(b, str) else b.cast("bigint").alias("b"))

    windows = read("temperature_normalization_windows").groupBy("machine_id_std").agg(F.count(one).alias("n"), F.sum(F.col("points_converted").cast("bigint")).alias("p"))
    preview = read("gold_preview").agg(F.count(one).alias("n"))
    parts = [rows("overview", read("overview"), F.col("dataset_name"), "rows", "rows_imputed"),
             rows("deduplication_summary", read("deduplication_summary"), F.concat_ws(":", "dataset_name", "resolution"), "groups", "records"),
             rows("temperature_normalization_windows", windows, F.col("machine_id_std"), "n", "p"),
             rows("imputation_metrics", read("imputation_metrics"), F.concat_ws(":", "dataset_name", "method"), one, one),
             rows("imputation_decisions", read("imputation_decisions"), F.col("dataset_name"), one, one),
             rows("gold_preview", preview, F.lit("rows"), "n", "n")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ dimensions


@register("j06_dimension_lookup", oracle(
    f"select s.machine_id_std, s.event_ts, s.sensor_type, cast(d.machine_id as bigint) as machine_id from s_sensors s join ({_SEED_SQL}) d "
    "on s.machine_id_std = d.machine_code"))
def q_j06(spark, sf):
    s = L.chain(spark, sf).sensors()
    j = dims.lookup(s, dims.machine_seed(spark), "machine_id_std", "machine_code", "machine_id", "inner")
    return j.select("machine_id_std", "event_ts", "sensor_type", big("machine_id"))


@register("j07_dimension_upsert", oracle(
    "select operator_key, cast(row_number() over (order by second, operator_key) as bigint) as operator_id from "
    "(select coalesce(operator_name, 'UNKNOWN') as operator_key, min(case when incident_id < 'INC-000000500' then 0 else 1 end) as second from i_dedup group by 1) "
    f"union all select machine_code, cast(machine_id as bigint) from ({_SEED_SQL})"))
def q_j07(spark, sf):
    """Two loads of stored dimensions: ids of the first stay, keys that the second brings follow."""
    inc = L.chain(spark, sf).i_silver().select("incident_id", F.col("operator_name_clean").alias("operator_key"))
    path = os.path.join(_root(spark, sf), f"dims-{uuid.uuid4().hex}")
    first = inc.where(F.col("incident_id") < "INC-000000500").select("operator_key")
    dims.synced(spark, os.path.join(path, "operator"), dims.empty_operator_dim(spark), first, "operator_key", "operator_id")
    ops = dims.synced(spark, os.path.join(path, "operator"), dims.empty_operator_dim(spark), inc.select("operator_key"), "operator_key", "operator_id")
    codes = L.chain(spark, sf).sensors().select(F.col("machine_id_std").alias("machine_code"))
    machines = dims.synced(spark, os.path.join(path, "machine"), dims.machine_seed(spark), codes, "machine_code", "machine_id")
    return ops.select("operator_key", big("operator_id")).unionByName(
        machines.select(F.col("machine_code").alias("operator_key"), big("machine_id").alias("operator_id")))


@register("s07_file_row_number", oracle("select count(*) as rows, true as numbering_contiguous from t_raw"))
def q_s07(spark, sf):
    """Row numbers per exported file: every file numbered 1..n without gaps or repeats."""
    d = _export_sources(spark, sf)
    found = files.find_source_files(d, spark)
    df = files.with_file_row_number(files.read_delimited(spark, found["temperature"], ";"))
    per_file = df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_number").alias("d"),
                                             F.min("row_number").alias("lo"), F.max("row_number").alias("hi"))
    ok = (F.col("n") == F.col("d")) & (F.col("lo") == 1) & (F.col("hi") == F.col("n"))
    return per_file.agg(F.sum("n").cast("bigint").alias("rows"), F.bool_and(ok).alias("numbering_contiguous"))
