"""Sinks and table maintenance.

Facts are Parquet tables under one root; every write is a distributed
DataFrame write (no driver-side row loops).  Full refresh (K08) is
``mode("overwrite")`` per fact table; dimensions are kept.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.functions.expr import INCIDENT_TYPE_COLUMNS, blank_to_null, ordinal_hours

from forgeline.operators.dims import lookup
from forgeline.operators.validate import pseudonymise
from forgeline.sources import fs

FACT_TABLES = [
    "bronze_temperature", "bronze_pressure", "bronze_incident", "bronze_weather",
    "silver_sensor_reading", "silver_incident", "silver_weather", "gold_machine_hourly_feature",
]


def table_path(root: str, name: str) -> str:
    return os.path.join(root, name)


# K01 ---------------------------------------------------------------------
def stripped(validated: DataFrame) -> DataFrame:
    """Raw text as Bronze keeps it: stripped, blank cells as NULL."""
    text = [f.name for f in validated.schema.fields if f.dataType.simpleString() == "string" and f.name not in ("source_file", "rejected_reason")]
    return validated.withColumns({c: blank_to_null(c) for c in text})


def bronze_rows(validated: DataFrame, batch_id: str) -> DataFrame:
    """Every row, accepted or not, with the batch id."""
    return stripped(validated).withColumn("ingestion_batch_id", F.lit(batch_id))


def write_bronze(validated: DataFrame, root: str, name: str, batch_id: str, mode: str = "append") -> DataFrame:
    out = bronze_rows(validated, batch_id)
    out.write.mode(mode).parquet(table_path(root, name))
    return out


# K02 ---------------------------------------------------------------------
def bronze_weather_rows(weather: DataFrame, batch_id: str) -> DataFrame:
    """Stringified metrics + ``is_imputed``; all rows accepted.  Rows are one per hour, numbered by it."""
    return weather.select(
        F.lit(batch_id).alias("ingestion_batch_id"),
        (ordinal_hours("observed_at") - weather.agg(F.min(ordinal_hours("observed_at"))).scalar() + 1).alias("row_number"),
        F.col("observed_at").cast("string").alias("timestamp_raw"),
        F.col("temp_celsius").cast("string").alias("temp_raw"),
        F.col("humidity_pct").cast("string").alias("humidity_raw"),
        F.col("pressure_hpa").cast("string").alias("pressure_raw"),
        F.col("wind_speed_ms").cast("string").alias("wind_speed_raw"),
        "is_imputed",
        F.lit(True).alias("parse_ok"),
        F.lit(None).cast("string").alias("rejected_reason"),
    )


# K04 / K05 / K06 ---------------------------------------------------------
def silver_sensor_rows(silver: DataFrame, batch_id: str) -> DataFrame:
    """Storage layout: value as Numeric(12,3), flags, unit, batch (quirk Q6)."""
    return silver.select(
        "machine_id_std", F.col("event_ts").alias("observed_at"), "sensor_type",
        F.col("sensor_value").cast("decimal(12,3)").alias("sensor_value"), "unit",
        "is_missing", "is_duplicate", F.lit(False).alias("is_outlier"), F.lit(batch_id).alias("ingestion_batch_id"),
    )


def write_silver_sensors(silver: DataFrame, root: str, batch_id: str) -> None:
    silver_sensor_rows(silver, batch_id).write.mode("overwrite").partitionBy("sensor_type").parquet(
        table_path(root, "silver_sensor_reading"))


def operator_key(salt: str | None = None):
    """The stored operator key: the clear name, or with a salt its pseudonym."""
    return pseudonymise("operator_name_clean", salt) if salt else F.col("operator_name_clean")


def silver_incident_rows(incidents: DataFrame, batch_id: str, operators: DataFrame | None = None, machines: DataFrame | None = None,
                         salt: str | None = None) -> DataFrame:
    """K05; with the dimensions, operator and machine ids are looked up (unknown operators stay NULL)."""
    incidents = incidents.drop("machine_id").withColumn("operator_key", operator_key(salt))  # the raw machine text gives way to the id
    ids = []
    if operators is not None:
        incidents = lookup(incidents, operators, "operator_key", "operator_key", "operator_id", "left")
        ids.append("operator_id")
    if machines is not None:
        incidents = lookup(incidents, machines, "machine_id_std", "machine_code", "machine_id", "left")
        ids.append("machine_id")
    return incidents.select(
        F.col("incident_id").alias("incident_code"), "machine_id_std", "operator_key", *ids,
        F.col("event_ts").alias("occurred_at"), F.col("severity").cast("short").alias("severity"), "shift",
        F.col("comment_clean").alias("comment"), F.lit(True).alias("is_label_event"),
        *[F.col(c).cast("short").alias(c) for c in INCIDENT_TYPE_COLUMNS], F.lit(batch_id).alias("ingestion_batch_id"),
    )


def silver_weather_rows(weather: DataFrame, batch_id: str) -> DataFrame:
    return weather.select(
        "observed_at",
        F.col("temp_celsius").cast("decimal(8,2)").alias("temp_celsius"),
        F.col("humidity_pct").cast("decimal(5,2)").alias("humidity_pct"),
        F.col("pressure_hpa").cast("decimal(8,2)").alias("pressure_hpa"),
        F.col("wind_speed_ms").cast("decimal(8,2)").alias("wind_speed_ms"),
        "is_imputed", F.lit(batch_id).alias("ingestion_batch_id"),
    )


# K07 / K08 ---------------------------------------------------------------
def write_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> None:
    """Full refresh of one fact table; a write that fails leaves the one of the run before."""
    fs.replace_table(df, table_path(root, name), partition_by)


# K09 ---------------------------------------------------------------------
def write_artifact_csv(df: DataFrame, run_dir: str, name: str, one_file: bool = False) -> str:
    """One folder of CSV files; ``one_file`` only for tables of bounded size (one row per method, a top-k preview)."""
    path = os.path.join(run_dir, name)
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)
    return path


# K10 ---------------------------------------------------------------------
def run_summary(spark, counts: dict[str, DataFrame]) -> DataFrame:
    """(stage, rows) from one count aggregate per stage, as one small DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(F.lit(stage).alias("stage"), "rows")
             for stage, df in counts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
