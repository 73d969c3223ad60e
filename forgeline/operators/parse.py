"""Bronze strings -> typed Silver inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.functions import expr as X


def parse_temperature(raw: DataFrame, value_raw: str = "temperature_raw", value: str = "temperature") -> DataFrame:
    """Typed temperature rows; rows without machine or timestamp dropped."""
    v = X.parse_number(value_raw)
    return raw.withColumns({
        "machine_id_std": X.machine_code("machine_id_raw"),
        "event_ts": X.parse_timestamp("timestamp_raw"),
        value: v,
        "is_missing": X.missing_flag(v),
    }).dropna(subset=["machine_id_std", "event_ts"])


def parse_pressure(raw: DataFrame) -> DataFrame:
    """Typed pressure rows; the value column is ``pressure_bar`` (S06 picks it)."""
    value_raw = "pressure_bar" if "pressure_bar" in raw.columns and "pressure_raw" not in raw.columns else "pressure_raw"
    return parse_temperature(raw, value_raw=value_raw, value="pressure_bar")


def parse_incidents(raw: DataFrame) -> DataFrame:
    """Typed incident rows keyed by the upper-cased incident id."""
    cols = {
        "incident_id": X.incident_code("incident_id"),
        "machine_id_std": X.machine_code("machine_id"),
        "event_ts": X.combine_date_time("date", "time"),
        "severity": X.blank_to_null("severity").try_cast("int"),
    }
    cols.update({c: X.flag_int(F.col(c)) if c in raw.columns else F.lit(0) for c in X.INCIDENT_TYPE_COLUMNS})
    return raw.withColumns(cols).dropna(subset=["machine_id_std", "event_ts", "incident_id"])


def incident_silver_candidate(incidents: DataFrame) -> DataFrame:
    """Operator defaults and the severity policy."""
    return incidents.withColumns({
        "operator_name_clean": X.default_unknown("operator_name"),
        "operator_badge_clean": X.default_unknown("operator_badge"),
        "comment_clean": F.col("comment"),
        "severity_imputation_policy": X.severity_policy("severity"),
    })
