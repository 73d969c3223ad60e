"""Dimensions: machine seed, lookup and upsert.

Dimensions are small (one row per machine or operator), so lookups broadcast
them; the upsert assigns ids to new keys after the current maximum.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgeline.session import materialize
from forgeline.sources import fs

MACHINE_SCHEMA = ("machine_id long, machine_code string, commissioning_date date, max_daily_capacity int, model string, "
                  "production_line string, location string, criticality string, is_active boolean")

# Fixed values that must equal the reference for right results: the machine
# dimension seed (code, commissioning date, daily capacity, model, line,
# location, criticality).
MACHINE_SEED = [
    ("MACH-01", "2021-05-12", 770, "InduPress-X2", "Ligne-A", "Atelier-2", "MEDIUM"),
    ("MACH-02", "2024-09-07", 800, "InduPress-X2", "Ligne-A", "Atelier-1", "LOW"),
    ("MACH-03", "2019-07-23", 1405, "InduPress-X1", "Ligne-B", "Atelier-1", "HIGH"),
    ("MACH-04", "2023-01-07", 750, "InduPress-Z1", "Ligne-C", "Atelier-3", "LOW"),
    ("MACH-05", "2024-03-11", 1380, "InduPress-X2", "Ligne-C", "Atelier-1", "HIGH"),
    ("MACH-06", "2022-01-01", 1351, "InduPress-X3", "Ligne-A", "Atelier-1", "LOW"),
    ("MACH-07", "2025-05-25", 1428, "InduPress-Z1", "Ligne-A", "Atelier-3", "MEDIUM"),
    ("MACH-08", "2023-10-18", 1158, "InduPress-X1", "Ligne-B", "Atelier-2", "HIGH"),
    ("MACH-09", "2023-01-15", 1056, "InduPress-X2", "Ligne-B", "Atelier-3", "MEDIUM"),
    ("MACH-10", "2021-04-16", 778, "InduPress-X3", "Ligne-A", "Atelier-3", "LOW"),
    ("MACH-11", "2022-09-15", 984, "InduPress-X2", "Ligne-B", "Atelier-1", "MEDIUM"),
    ("MACH-12", "2024-02-21", 838, "InduPress-Z1", "Ligne-B", "Atelier-2", "MEDIUM"),
    ("MACH-13", "2019-12-30", 907, "InduPress-X3", "Ligne-C", "Atelier-3", "MEDIUM"),
    ("MACH-14", "2021-10-21", 1191, "InduPress-X2", "Ligne-A", "Atelier-3", "LOW"),
    ("MACH-15", "2022-03-16", 1027, "InduPress-X2", "Ligne-A", "Atelier-3", "MEDIUM"),
]
CRITICALITY_VALUES = ("LOW", "MEDIUM", "HIGH")


def machine_seed(spark: SparkSession) -> DataFrame:
    """The seed rows with ids 1..15."""
    rows = [(i + 1, code, dt.date.fromisoformat(d), cap, model, line, loc, crit, True)
            for i, (code, d, cap, model, line, loc, crit) in enumerate(MACHINE_SEED)]
    return spark.createDataFrame(rows, MACHINE_SCHEMA)


def upsert_keys(dim: DataFrame, keys: DataFrame, key: str, id_col: str) -> DataFrame:
    """Add missing keys (sorted) with ids after the current maximum; keep existing ids.

    New keys are range-partitioned and stored, numbered inside their
    partitions and shifted by the partitions' counts (one row per partition),
    so no task numbers them all.
    """
    new = keys.select(key).where(F.col(key).isNotNull()).distinct().join(dim.select(key), key, "left_anti")
    new = materialize(new.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "new-keys")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = new.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    base = F.coalesce(dim.agg(F.max(id_col)).scalar(), F.lit(0))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(key))
    numbered = new.withColumn("_place", place).join(shifts, "_part").select(
        key, (base + F.col("_shift") + F.col("_place")).cast("long").alias(id_col), F.lit(True).alias("is_active"))
    return dim.unionByName(numbered, allowMissingColumns=True)


def synced(spark: SparkSession, path: str, seed: DataFrame, keys: DataFrame, key: str, id_col: str) -> DataFrame:
    """The stored dimension (the seed at first) with new keys added, written back and read.

    Ids given once are kept in every later run, also when writing fails: the
    stored table is only replaced by a whole one.
    """
    known = spark.read.parquet(path) if fs.recovered(spark, path) else seed
    fs.replace_table(upsert_keys(known, keys, key, id_col), path)
    return spark.read.parquet(path)


def lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, id_col: str, how: str = "inner") -> DataFrame:
    """Code -> id.  ``inner`` drops unmatched rows (machines), ``left`` keeps them with NULL (operators).

    No broadcast hint: a dimension is usually tiny and AQE broadcasts it from
    its measured size, but a large operator dimension falls back to a
    shuffle join instead of being forced into every executor.
    """
    d = dim.select(F.col(dim_key).alias(fact_key), id_col)
    return facts.join(d, fact_key, how)


def empty_operator_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "operator_id long, operator_key string, badge_hash string, is_active boolean")
