"""Row validation, data-quality assertions and the batch ledger.

Validation keeps every raw row and adds ``parse_ok`` plus a stable list of
rule codes (quirk Q15: codes instead of library error text).  Codes are
``when`` expressions joined by ``concat_ws`` (which skips NULLs), so the
whole check is one projection inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.operators.dims import CRITICALITY_VALUES

# Width of the reason column.  All codes of a source together are shorter (a unit test adds them up), so it never cuts.
MAX_REASON_CHARS = 512
MACHINE_CODE_FORMAT = "^MACH-[0-9]{2}$"


def _with_codes(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    # concat_ws skips NULLs, so failed rules join into "code;code" in one codegen'd expression
    codes = F.concat_ws(";", *[F.when(cond, F.lit(code)) for code, cond in rules])
    reason = F.nullif(F.substring(codes, 1, MAX_REASON_CHARS), F.lit(""))
    return df.withColumn("rejected_reason", reason).withColumn("parse_ok", F.col("rejected_reason").isNull())


def _machine_rules(c: str) -> list[tuple[str, Column]]:
    blank = X.blank_to_null(c).isNull()
    return [
        ("missing_machine_id", blank),
        ("machine_id_without_digits", ~blank & X.machine_number(c).isNull()),
    ]


def _sensor_rules(value_raw: str) -> list[tuple[str, Column]]:
    ts_blank = X.blank_to_null("timestamp_raw").isNull()
    return _machine_rules("machine_id_raw") + [
        ("missing_timestamp", ts_blank),
        ("unparsable_timestamp", ~ts_blank & X.parse_timestamp("timestamp_raw").isNull()),
        ("non_numeric_value", ~X.is_numeric_text(value_raw)),
    ]


def validate_temperature(raw: DataFrame) -> DataFrame:
    """P10."""
    return _with_codes(raw, _sensor_rules("temperature_raw"))


def validate_pressure(raw: DataFrame) -> DataFrame:
    """P11 (offset-tolerant timestamps)."""
    return _with_codes(raw, _sensor_rules("pressure_raw"))


def validate_incidents(raw: DataFrame) -> DataFrame:
    """Required fields, parsable date + time, integer severity in 1..5, integer flags."""
    def blank(c: str) -> Column:
        return X.blank_to_null(c).isNull()

    sev = X.blank_to_null("severity").try_cast("int")
    rules = [("missing_incident_id", blank("incident_id"))] + _machine_rules("machine_id") + [
        ("missing_date", blank("date")),
        ("missing_time", blank("time")),
        ("missing_severity", blank("severity")),
        ("unparsable_occurred_at", ~blank("date") & ~blank("time") & X.combine_date_time("date", "time").isNull()),
        ("non_integer_severity", ~blank("severity") & sev.isNull()),
        ("severity_out_of_range", sev.isNotNull() & ~sev.between(1, 5)),
    ]
    flags = [c for c in X.INCIDENT_TYPE_COLUMNS if c in raw.columns]
    if flags:
        bad_flag = reduce(
            lambda a, b: a | b,
            [X.blank_to_null(c).isNotNull() & X.blank_to_null(c).try_cast("int").isNull() for c in flags],
        )
        rules.append(("non_integer_type_flag", bad_flag))
    return _with_codes(raw, rules)


# K03 ---------------------------------------------------------------------
def batch_counts(validated: DataFrame, source_name: str, batch_id: str) -> DataFrame:
    """One ledger row: rows read / loaded / rejected and the load status."""
    return validated.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("parse_ok")).alias("rows_loaded"),
        F.count_if(~F.col("parse_ok")).alias("rows_rejected"),
    ).select(
        F.lit(batch_id).alias("ingestion_batch_id"),
        F.lit(source_name).alias("source_name"),
        "rows_read", "rows_loaded", "rows_rejected",
        F.when(F.col("rows_rejected") == 0, F.lit("completed")).otherwise(F.lit("partial")).alias("status"),
    )


# D01 ---------------------------------------------------------------------
def constraint_violations(checks: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Row-level rules: ``{rule_code: (frame, predicate that must hold)}`` -> counts."""
    parts = [
        df.agg(F.count_if(~F.coalesce(pred, F.lit(False))).cast("bigint").alias("violations")).select(
            F.lit(code).alias("rule_code"), "violations"
        )
        for code, (df, pred) in checks.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def uniqueness_violations(df: DataFrame, keys: list[str], rule_code: str) -> DataFrame:
    """Keys occurring more than once (one aggregate, map-side combined)."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
        .select(F.lit(rule_code).alias("rule_code"), "violations")
    )


def all_constraints(machines: DataFrame, sensors: DataFrame, incidents: DataFrame, gold: DataFrame, weather: DataFrame,
                    ts: str = "event_ts", incident_key: str = "incident_id") -> DataFrame:
    """D01 in full: nine rules over the dimension, Silver and Gold tables -> (rule_code, violations).

    A machine that came with the data has no capacity or criticality yet:
    those rules apply to known values.
    """
    known = lambda c, ok: F.col(c).isNull() | ok
    rows = constraint_violations({
        "machine_code_format": (machines, F.col("machine_code").rlike(MACHINE_CODE_FORMAT)),
        "machine_capacity_positive": (machines, known("max_daily_capacity", F.col("max_daily_capacity") > 0)),
        "machine_criticality_known": (machines, known("criticality", F.col("criticality").isin(*CRITICALITY_VALUES))),
        "severity_range": (incidents, F.col("severity").between(1, 5)),
        "window_end_after_start": (gold, F.col("window_end") > F.col("window_start")),
    })
    for frame, keys, rule in ((gold, ["machine_id_std", "window_start"], "unique_machine_hour"), (incidents, [incident_key], "unique_incident_code"),
                              (weather, ["observed_at"], "unique_weather_hour"), (sensors, ["machine_id_std", ts, "sensor_type"], "unique_sensor_reading")):
        rows = rows.unionByName(uniqueness_violations(frame, keys, rule))
    return rows


def violations_as_issues(violations: DataFrame) -> DataFrame:
    """Broken constraints (D01) in the data-quality issue layout."""
    return violations.where("violations > 0").select(
        F.lit("constraints").alias("dataset_name"), "rule_code", F.lit("error").alias("severity"), F.lit("").alias("entity_key"),
        F.concat(F.lit("violations="), F.col("violations").cast("string")).alias("details"))


# D02 ---------------------------------------------------------------------
DQ_SCHEMA = "dataset_name string, rule_code string, severity string, entity_key string, details string"


def rejects_as_issues(validated: DataFrame, dataset_name: str, key_col: str = "row_number") -> DataFrame:
    """Rejected rows in the data-quality issue layout, one row per rule code."""
    return validated.where(~F.col("parse_ok")).select(
        F.lit(dataset_name).alias("dataset_name"),
        F.explode(F.split("rejected_reason", ";")).alias("rule_code"),
        F.lit("error").alias("severity"),
        F.col(key_col).cast("string").alias("entity_key"),
        F.lit("row rejected at Bronze validation").alias("details"),
    )


def decisions_as_issues(decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Dedup decisions (U03) in the data-quality issue layout."""
    return decisions.select(
        "dataset_name",
        F.concat(F.lit("dedup_"), F.col("resolution")).alias("rule_code"),
        F.lit("info").alias("severity"),
        F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("entity_key"),
        F.concat(F.lit("records_in_group="), F.col("records_in_group").cast("string")).alias("details"),
    )


def quality_issues(validated: dict[str, DataFrame], deduped: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Rejects and dedup decisions of every source in the issue layout."""
    from forgeline.operators.dedup import dedup_decisions

    parts = [rejects_as_issues(df, name) for name, df in validated.items()]
    parts += [decisions_as_issues(dedup_decisions(df, name, keys), keys) for name, (df, keys) in deduped.items()]
    return reduce(DataFrame.unionByName, parts)


# D03 ---------------------------------------------------------------------
def pseudonymise(c: Column | str, salt: str) -> Column:
    """Salted SHA-256 of an operator badge or name (option; parity keeps clear keys)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isNotNull(), F.sha2(F.concat(F.lit(salt), col), 256))
