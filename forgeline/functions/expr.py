"""Scalar Column -> Column expressions.

Every function returns a native Spark expression, so it stays inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for right results.
MACHINE_CODE_PREFIX = "MACH-"
WHITE_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
TEMPERATURE_RANGE = (0.0, 120.0)
PRESSURE_RANGE = (100.0, 250.0)
INCIDENT_TYPE_COLUMNS = [
    "type_surchauffe",
    "type_baisse_pression",
    "type_vibration",
    "type_bruit_mecanique",
    "type_surconsommation",
    "type_blocage_mecanique",
    "type_alarme_capteur",
    "type_arret_urgence",
    "type_defaut_qualite",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P02 ---------------------------------------------------------------------
def strip(c: Column | str) -> Column:
    """Without white space at either end (not only spaces)."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def blank_to_null(c: Column | str) -> Column:
    """Strip, then turn an empty string into NULL."""
    return F.nullif(strip(c), F.lit(""))


# P01 ---------------------------------------------------------------------
def machine_number(c: Column | str) -> Column:
    """Last run of digits as a number; NULL when there is none.

    The last run is the first run of the reversed text, so the pattern is a
    plain left-to-right match with no backtracking over the tail.
    """
    digits = F.reverse(F.regexp_extract(F.reverse(_col(c)), r"[0-9]+", 0))
    return _try_cast(F.nullif(digits, F.lit("")), "bigint")


def machine_code(c: Column | str) -> Column:
    """``MACH-%02d`` of the last digit run; NULL for NULL, blank or digit-free input."""
    s = machine_number(c).cast("string")
    # zero-padded to at least two digits; concat keeps NULL for NULL input
    return F.concat(F.lit(MACHINE_CODE_PREFIX), F.lpad(s, F.greatest(F.lit(2), F.length(s)), F.lit("0")))


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


# P03 / P04 ---------------------------------------------------------------
def clean_timestamp_text(c: Column | str) -> Column:
    """``T`` -> space and drop a trailing ``Z`` or ``+hh:mm`` (keeps wall clock).

    Same result as removing ``(Z|[+-][0-9]{2}:[0-9]{2})$``, written with
    suffix tests on the last six characters instead of a scanning regex.
    """
    s = F.replace(strip(c), F.lit("T"), F.lit(" "))
    n = F.length(s)
    offset = F.substring(s, -6, 6).rlike(r"^[+-][0-9]{2}:[0-9]{2}$")
    return (
        F.when(s.endswith("Z"), F.substring(s, F.lit(1), n - 1))
        .when(offset, F.substring(s, F.lit(1), n - 6))
        .otherwise(s)
    )


def parse_timestamp(c: Column | str) -> Column:
    """Lenient timestamp parse to ``timestamp_ntz``; unparsable -> NULL."""
    return _try_cast(clean_timestamp_text(c), "timestamp_ntz")


# P05 ---------------------------------------------------------------------
def combine_date_time(date_col: Column | str, time_col: Column | str) -> Column:
    """``"{date} {time}"`` parsed; NULL when the date is missing."""
    d = blank_to_null(date_col)
    t = F.coalesce(blank_to_null(time_col), F.lit(""))
    return F.when(d.isNotNull(), _try_cast(F.trim(F.concat_ws(" ", d, t)), "timestamp_ntz"))


# P06 ---------------------------------------------------------------------
def parse_number(c: Column | str) -> Column:
    """Lenient numeric parse: NULL for blank, junk, NaN and infinities."""
    v = _try_cast(strip(c), "double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def is_numeric_text(c: Column | str) -> Column:
    """Strict check used by row validation: blank or a parsable number."""
    s = blank_to_null(c)
    return s.isNull() | _try_cast(s, "double").isNotNull()


# P07 ---------------------------------------------------------------------
def missing_flag(c: Column | str) -> Column:
    return _col(c).isNull()


# P08 ---------------------------------------------------------------------
def incident_code(c: Column | str) -> Column:
    return F.nullif(F.upper(strip(c)), F.lit(""))


# P09 ---------------------------------------------------------------------
def flag_int(c: Column | str) -> Column:
    """Type flag: blank or absent -> 0, else integer."""
    return F.coalesce(_try_cast(strip(c), "int"), F.lit(0))


# P14 ---------------------------------------------------------------------
def hour_floor(ts: Column | str) -> Column:
    """Floor to the hour, staying ``timestamp_ntz`` (session zone is UTC)."""
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def plus_hours(ts: Column | str, hours: int) -> Column:
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(hours))


# P15 ---------------------------------------------------------------------
def to_utc_wall_clock(ts: Column | str, source_zone: str | None = None) -> Column:
    """Time, or text with an optional offset, -> naive UTC wall clock.

    Without an offset the time is taken as UTC, or as ``source_zone``'s.  The
    session zone is UTC, so the zoned time's wall clock is UTC.
    """
    c = _col(ts).try_cast("timestamp")
    if source_zone:
        c = F.to_utc_timestamp(c, source_zone)
    return c.cast("timestamp_ntz")


# P16 ---------------------------------------------------------------------
def fahrenheit_to_celsius(c: Column | str) -> Column:
    return (_col(c) - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)


# P17 ---------------------------------------------------------------------
def default_unknown(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("UNKNOWN"))


# P18 ---------------------------------------------------------------------
def severity_policy(severity: Column | str) -> Column:
    return F.when(_col(severity).isNull(), F.lit("reject_or_manual_rule")).otherwise(F.lit("keep_original"))


# P19 ---------------------------------------------------------------------
def locale_number(c: Column | str) -> Column:
    """``13,5 °C`` -> 13.5; ``--`` and blank -> NULL; leading number only."""
    s = F.replace(strip(c), F.lit(","), F.lit("."))
    lead = F.regexp_extract(s, r"^-?[0-9]+(\.[0-9]+)?", 0)
    return _try_cast(F.nullif(lead, F.lit("")), "double")


# P20 ---------------------------------------------------------------------
def kmh_to_ms(c: Column | str) -> Column:
    return F.round(_col(c) / F.lit(3.6), 3)


# P21 ---------------------------------------------------------------------
def pressure_mid(p_min: Column | str, p_max: Column | str) -> Column:
    a, b = _col(p_min), _col(p_max)
    return F.coalesce(F.round((a + b) / F.lit(2.0), 2), a, b)


# P22 ---------------------------------------------------------------------
def ordinal_hours(ts: Column | str) -> Column:
    """Whole hours since the epoch (true hours; see quirk Q11)."""
    return F.floor(F.unix_seconds(_col(ts).cast("timestamp")) / F.lit(3600)).cast("bigint")


def calendar_features(ts: Column | str) -> dict[str, Column]:
    c = _col(ts)
    return {
        "hour": F.hour(c),
        "dayofweek": F.weekday(c),  # Monday = 0
        "month": F.month(c),
        "time_ordinal_hours": ordinal_hours(c),
    }


# P24 ---------------------------------------------------------------------
def safe_ratio_clipped(num: Column, den: Column, lo: float = -10.0, hi: float = 10.0) -> Column:
    """``num / den`` with ``den == 0`` -> NULL, clipped to [lo, hi], NULL kept NULL.

    ``greatest``/``least`` skip NULLs, so the clip is guarded (trap T2).
    """
    r = num / F.nullif(den, F.lit(0.0))
    return F.when(r.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), r)))


# P26 ---------------------------------------------------------------------
def in_range(c: Column | str, lo: float, hi: float) -> Column:
    """Inclusive between; NULL counts as outside."""
    return F.coalesce(_col(c).between(lo, hi), F.lit(False))

