"""Raw sensor exports derived from the driver tables (FIXTURES.md section 5).

The engine's real inputs are delimited files; the driver ships TPC-H-like
parquet tables instead.  These views re-shape those tables into the three
raw exports (all columns strings, exactly as a CSV reader would give them)
so every operator runs over data that grows with the driver's tables.

Each view is a SQL template that is valid in Spark SQL and in DuckDB; the
same text feeds the Spark plan (tables bound as DataFrames through
``spark.sql(..., events=df)``) and the DuckDB oracle (plain table names).
``MC`` below stands for the machine number ``user_id % 15 + 1``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from forgeline.session import pin_session

_MC = "lpad(cast(user_id % 15 + 1 as string), 2, '0')"

# T: raw temperature export; even events, some Fahrenheit days, junk values,
# blanks, three spellings of the machine id, and re-sent duplicate rows.
TEMPERATURE_RAW_SQL = f"""
select event_id as row_number,
  case event_id % 6 when 0 then 'MACH_' || {_MC} when 2 then 'M-' || {_MC} else 'MACH-' || {_MC} end as machine_id_raw,
  case when event_id % 58 = 0 then chr(9) else '' end || cast(date_trunc('hour', ts) as string) as timestamp_raw,
  case when event_id % 80 = 0 then chr(9) || ' ' when event_id % 40 = 0 then '' when event_id % 194 = 2 then 'abc'
       when user_id % 15 % 3 = 0 and day(ts) between 6 and 9
         then cast(round((28 + (event_id % 21) * 0.5) * 1.8 + 32, 2) as string)
       else cast(28 + (event_id % 21) * 0.5 as string) end as temperature_raw
from {{events}} where event_id % 2 = 0
union all
select event_id + 100000000 as row_number, 'MACH-' || {_MC} as machine_id_raw,
  cast(date_trunc('hour', ts) as string) as timestamp_raw,
  cast(28 + (event_id % 21) * 0.5 as string) as temperature_raw
from {{events}} where event_id % 2 = 0 and event_id % 6 = 4 and event_id % 40 <> 0 and event_id % 100 < 10
"""

# P: raw pressure export; odd events, ISO 'T' separators, 'Z' and '+01:00'
# suffixes, blank values.
PRESSURE_RAW_SQL = f"""
select event_id as row_number, 'MACH-' || {_MC} as machine_id_raw,
  replace(cast(date_trunc('hour', ts) as string), ' ', case when event_id % 8 = 1 then 'T' else ' ' end)
    || case when event_id % 10 = 3 then '+01:00' when event_id % 10 = 7 then 'Z' else '' end as timestamp_raw,
  case when event_id % 46 = 1 then '' else cast(185 + (user_id % 15) + (event_id % 41) * 0.25 as string) end as pressure_raw
from {{events}} where event_id % 2 = 1
"""

# I: raw incident export; every error event, grouped into incident ids of ten
# consecutive events (so ids repeat with different completeness), an
# unparsable machine, out-of-range severities, missing operators and comments.
INCIDENT_RAW_SQL = f"""
select event_id as row_number,
  'inc-' || lpad(cast(event_id - event_id % 10 as string), 9, '0') as incident_id,
  case when event_id % 50 = 7 then 'unknown' else 'M-' || {_MC} end as machine_id,
  cast(cast(ts as date) as string) as date,
  substr(cast(date_trunc('hour', ts) as string), 12, 5) as time,
  case when event_id % 31 = 0 then '9' else cast(event_id % 5 + 1 as string) end as severity,
  case when event_id % 3 = 0 then null else 'op' || cast(user_id % 7 as string) end as operator_name,
  case when event_id % 4 = 1 then null else 'B' || lpad(cast(user_id % 97 as string), 4, '0') end as operator_badge,
  case when hour(ts) < 8 then 'night' when hour(ts) < 16 then 'morning' else 'evening' end as shift,
  case when event_id % 4 = 0 then null else 'note ' || cast(event_id % 13 as string) end as comment,
  case when event_id % 2 = 0 then '1' else '0' end as type_surchauffe,
  case when event_id % 3 = 0 then '1' else '0' end as type_baisse_pression,
  case when event_id % 4 = 0 then '1' else '0' end as type_vibration,
  case when event_id % 5 = 0 then '1' else '0' end as type_bruit_mecanique,
  case when event_id % 6 = 0 then '1' else '0' end as type_surconsommation,
  case when event_id % 7 = 0 then '1' else '0' end as type_blocage_mecanique,
  case when event_id % 8 = 0 then '1' else '0' end as type_alarme_capteur,
  case when event_id % 9 = 0 then '1' else '0' end as type_arret_urgence,
  case when event_id % 10 = 0 then '1' else '0' end as type_defaut_qualite
from {{events}} where event_type = 'error'
"""

# W: daily ambient weather, every order day.
WEATHER_DAILY_SQL = """
select cast(o_orderdate as date) as day, avg(o_custkey % 400) / 10.0 as temp_celsius,
  1000 + count(*) as pressure_hpa, avg(o_custkey % 40) as wind_kmh
from {orders} group by cast(o_orderdate as date)
"""

# Weather page cells as text, one row per order day, as scraped from a
# daily table: day label, mean temperature '13,5 °C' style, wind km/h,
# pressure min / max with '--' gaps.
WEATHER_CELLS_SQL = """
select cast(o_orderdate as date) as day,
  'J. ' || lpad(cast(day(cast(o_orderdate as date)) as string), 2, '0') as day_label,
  replace(cast(round(avg(o_custkey % 400) / 10.0, 1) as string), '.', ',') || ' °C' as t_mean_text,
  cast(count(*) % 30 as string) || ' km/h' as wind_text,
  case when count(*) % 7 = 0 then '--' else cast(995 + count(*) as string) end as p_min_text,
  case when count(*) % 5 = 0 then '' else cast(1005 + count(*) as string) end as p_max_text
from {orders} group by cast(o_orderdate as date)
"""

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _view(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    pin_session(spark)
    return spark.sql(sql, **{table: read_table(spark, sf_dir, table)})


def temperature_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, TEMPERATURE_RAW_SQL, "events")


def pressure_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, PRESSURE_RAW_SQL, "events")


def incident_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, INCIDENT_RAW_SQL, "events")


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, WEATHER_DAILY_SQL, "orders")


def weather_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, WEATHER_CELLS_SQL, "orders")


def sql_for_duckdb(template: str) -> str:
    """The same view text with plain table names, for the DuckDB oracle."""
    return template.format(events="events", orders="orders")
