"""Delimited source files.

Readers keep every column as a string (Bronze keeps raw text).  The
delimiter is detected from the first lines, then the CSV reader parses the
whole file in parallel.  Row numbers are the 1-based position in the file,
computed without a global sort: a count per block is prefix-summed and added to
the position inside each block.
"""

from __future__ import annotations

import csv
import os
from collections import Counter

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgeline.session import materialize
from forgeline.sources import fs

# Fixed values that must equal the reference for right results.
SOURCE_STEMS = {
    "temperature": "capteurs_temperature",
    "pressure": "capteurs_pression",
    "incident": "releves_incidents",
}
DELIMITER_CANDIDATES = [";", ",", "\t", "|"]

SNIFF_LINES, SNIFF_WIDTH = 100, 10_000  # lines of a source, and characters of a line, that the delimiter is detected from
BROADCAST_BLOCKS = 100_000  # file blocks (8 MB of offsets)


# S01 / S02 ---------------------------------------------------------------
def find_source_files(data_dir: str, spark: SparkSession) -> dict[str, str]:
    """``{kind: path}`` by file stem; dotfiles skipped, last sorted match wins.

    The stem is the name without its last suffix, so ``x.csv.bak`` is not
    ``x``.  The folder is listed through Hadoop's FileSystem (any shared store).
    """
    found: dict[str, str] = {}
    for name, path, _ in fs.list_names(spark, data_dir):
        if name.startswith("."):
            continue
        stem = os.path.splitext(name)[0]
        for kind, want in SOURCE_STEMS.items():
            if stem == want:
                found[kind] = path
    return found


def require_sources(found: dict[str, str], required=("temperature", "pressure", "incident")) -> None:
    missing = sorted(set(required) - set(found))
    if missing:
        raise FileNotFoundError(f"missing source files: {', '.join(missing)}")


# S03 ---------------------------------------------------------------------
def sniff_delimiter(spark: SparkSession, path: str, default: str = ",") -> str:
    """The candidate under which a sample of the first lines agrees best on the number of fields."""
    lines = spark.read.text(path).select(F.substring("value", 1, SNIFF_WIDTH)).limit(SNIFF_LINES).collect()
    return best_delimiter([r[0] or "" for r in lines], default)


def best_delimiter(lines: list[str], default: str = ",") -> str:
    """Quote-aware: delimiters and line ends inside quotes count for nothing.

    The candidate with the largest share of records of the most common width
    wins, then the wider records, then the order of the candidates; one that
    separates nothing doesn't count.
    """
    best, found = (0.0, 0), default
    for d in DELIMITER_CANDIDATES:
        records = [len(r) for r in csv.reader([line + "\n" for line in lines], delimiter=d) if r]
        if len(lines) == SNIFF_LINES and len(records) > 1:
            records.pop()  # the sample may end inside a record
        width, times = Counter(records).most_common(1)[0] if records else (0, 0)
        score = (times / max(1, len(records)), width)
        if width > 1 and score > best:
            best, found = score, d
    return found


# S04 / S06 / S07 ---------------------------------------------------------
def read_delimited(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """All-string scan with stripped header names, blanks kept as ''.

    A folder's files must agree in their header line: another column order
    raises instead of being read into the wrong columns.
    """
    sep = sep or sniff_delimiter(spark, path)
    df = (
        spark.read.option("header", True).option("sep", sep).option("inferSchema", False)
        .option("emptyValue", "").option("nullValue", None).option("mode", "PERMISSIVE").option("enforceSchema", False)
        .csv(path)
    )
    df = df.toDF(*[c.strip() for c in df.columns])
    return df.withColumn("source_file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def with_file_row_number(df: DataFrame, out: str = "row_number") -> DataFrame:
    """1-based position of each row in its source file, without a global sort.

    The text is scanned once: rows are stored with their file, the start of the
    block they were read from (the hidden ``_metadata`` column) and an id that
    grows inside a task.  Rows of one block are contiguous in the task that
    reads it, so the position inside a block is the distance to its smallest
    id; the stored blocks' counts, one row per block and prefix-summed in file
    order, give the rest.  Up to ``BROADCAST_BLOCKS`` blocks those offsets are
    broadcast and no row is shuffled; beyond, they are joined by size.
    """
    file, block, place, first, offset = (_unused(df, c) for c in ("_file", "_block", "_place", "_first", "_offset"))
    tagged = df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias(block), F.monotonically_increasing_id().alias(place))
    rows = materialize(tagged, "numbered-lines")
    blocks = rows.groupBy(file, block).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias(first))
    w = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(file, block, first, F.coalesce(F.sum("n").over(w), F.lit(0)).alias(offset))
    offsets = materialize(offsets, "line-offsets")
    if offsets.count() <= BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    number = (F.col(offset) + F.col(place) - F.col(first) + 1).cast("bigint")
    return rows.join(offsets, [file, block]).withColumn(out, number).drop(file, block, place, first, offset)


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = "_" + name
    return name


def value_column(df: DataFrame, preferred: str, fallback: str) -> str:
    """``pressure_bar`` if present, else ``pressure``."""
    return preferred if preferred in df.columns else fallback


def column_or_blank(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def temperature_bronze_input(df: DataFrame) -> DataFrame:
    return df.select("row_number", column_or_blank(df, "machine_id").alias("machine_id_raw"),
                     column_or_blank(df, "timestamp").alias("timestamp_raw"),
                     column_or_blank(df, "temperature").alias("temperature_raw"), "source_file")


def pressure_bronze_input(df: DataFrame) -> DataFrame:
    v = value_column(df, "pressure_bar", "pressure")
    return df.select("row_number", column_or_blank(df, "machine_id").alias("machine_id_raw"),
                     column_or_blank(df, "timestamp").alias("timestamp_raw"),
                     column_or_blank(df, v).alias("pressure_raw"), "source_file")


def incident_bronze_input(df: DataFrame) -> DataFrame:
    from forgeline.functions.expr import INCIDENT_TYPE_COLUMNS

    cols = ["incident_id", "machine_id", "date", "time", "severity", "operator_name", "operator_badge", "shift", "comment"]
    return df.select("row_number", *[column_or_blank(df, c).alias(c) for c in cols],
                     *[column_or_blank(df, c).alias(c) for c in INCIDENT_TYPE_COLUMNS], "source_file")


# S08 / S09 / S10 / S13 ---------------------------------------------------
def accepted_rows(bronze: DataFrame, payload: list[str]) -> DataFrame:
    """Bronze rows with ``parse_ok`` (pushed down to the Parquet scan)."""
    return bronze.where(F.col("parse_ok")).select(*payload)


def silver_by_type(silver: DataFrame, sensor_type: str) -> DataFrame:
    """Silver is partitioned by ``sensor_type``: this prunes to one partition."""
    return silver.where(F.col("sensor_type") == sensor_type).select(
        "machine_id_std", "event_ts", "sensor_value", "is_missing", "is_duplicate")


def date_range(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Min / max date of parsed timestamps; today when there is none."""
    d = F.to_date(ts)
    return df.agg(F.coalesce(F.min(d), F.current_date()).alias("start_date"),
                  F.coalesce(F.max(d), F.current_date()).alias("end_date"))


WEATHER_SCHEMA = ("observed_at timestamp_ntz, temp_celsius double, humidity_pct double, pressure_hpa double, "
                  "wind_speed_ms double, is_imputed boolean")


def read_weather_store(spark: SparkSession, path: str) -> DataFrame:
    """Stored hourly weather, or an empty frame with the schema."""
    if not fs.exists(spark, path):
        return spark.createDataFrame([], WEATHER_SCHEMA)
    return spark.read.schema(WEATHER_SCHEMA).parquet(path)
