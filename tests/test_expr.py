"""Scalar expressions: branch rows of FIXTURES.md section 4."""

import datetime as dt

from pyspark.sql import functions as F

from forgeline.functions import expr as X
from forgeline.operators import validate


def _one(spark, rows, schema, col):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_machine_code_branches(spark):
    vals = ["MACH-01", "MACH_01", "M-03", "machine 12 bis 7", "MACH-123", "abc", "", None]
    got = _one(spark, [(v,) for v in vals], "x string", X.machine_code("x"))
    assert got == ["MACH-01", "MACH-01", "MACH-03", "MACH-07", "MACH-123", None, None, None]


def test_timestamp_cleaning(spark):
    vals = ["2025-08-26 00:00:00", "2025-08-26T00:00:00", "2025-08-26T00:00:00Z", "2025-09-08T17:00:00+01:00",
            "2025-04-14 15:15", "bad"]
    got = _one(spark, [(v,) for v in vals], "x string", X.parse_timestamp("x"))
    assert got[:5] == [dt.datetime(2025, 8, 26), dt.datetime(2025, 8, 26), dt.datetime(2025, 8, 26),
                       dt.datetime(2025, 9, 8, 17), dt.datetime(2025, 4, 14, 15, 15)]
    assert got[5] is None


def test_numeric_parse_lenient_and_strict(spark):
    vals = ["39.47", " 3 ", "", "abc", "NaN", "1e5", "Infinity"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    rows = df.select(X.parse_number("x").alias("v"), X.is_numeric_text("x").alias("ok")).collect()
    assert [r.v for r in rows] == [39.47, 3.0, None, None, None, 100000.0, None]
    assert [r.ok for r in rows] == [True, True, True, False, True, True, True]


def test_incident_validation_branches(spark):
    base = dict(incident_id="inc-1", machine_id="M-01", date="2025-01-01", time="10:00", severity="3")
    cases = [dict(severity="0"), dict(severity="1"), dict(severity="5"), dict(severity="6"), dict(severity="3.0"),
             dict(severity="x"), dict(severity=""), dict(date=""), dict(time=""), dict(incident_id=" ")]
    rows = [{**base, **c} for c in cases]
    df = spark.createDataFrame(rows, "incident_id string, machine_id string, date string, time string, severity string")
    got = [(r.parse_ok, r.rejected_reason) for r in validate.validate_incidents(df).collect()]
    assert [g[0] for g in got] == [False, True, True, False, False, False, False, False, False, False]
    assert got[0][1] == "severity_out_of_range"
    assert got[4][1] == "non_integer_severity"
    assert got[6][1] == "missing_severity"
    assert got[7][1] == "missing_date"


def test_sensor_validation_codes(spark):
    df = spark.createDataFrame([("MACH-01", "2025-01-01 00:00:00", "1.5"), ("abc", "bad", "x"), ("", "", "")],
                               "machine_id_raw string, timestamp_raw string, temperature_raw string")
    got = [r.rejected_reason for r in validate.validate_temperature(df).collect()]
    assert got == [None, "machine_id_without_digits;unparsable_timestamp;non_numeric_value", "missing_machine_id;missing_timestamp"]


def test_locale_number_wind_and_pressure(spark):
    df = spark.createDataFrame([("13,5 °C", "10", "1000", "1010"), ("--", "", "1000", None), ("", "-2", None, None),
                                ("-2", "36", "--", "1012")], "t string, w string, a string, b string")
    rows = df.select(X.locale_number("t").alias("t"), X.kmh_to_ms(X.locale_number("w")).alias("w"),
                     X.pressure_mid(X.locale_number("a"), X.locale_number("b")).alias("p")).collect()
    assert [r.t for r in rows] == [13.5, None, None, -2.0]
    assert [r.w for r in rows] == [2.778, None, -0.556, 10.0]
    assert [r.p for r in rows] == [1005.0, 1000.0, None, 1012.0]


def test_safe_ratio_clip_guards_nulls(spark):
    df = spark.createDataFrame([(1.0, 0.0), (50.0, 1.0), (-50.0, 1.0), (None, 1.0), (2.0, 4.0)], "n double, d double")
    got = [r[0] for r in df.select(X.safe_ratio_clipped(F.col("n"), F.col("d"))).collect()]
    assert got == [None, 10.0, -10.0, None, 0.5]


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),)], "ts timestamp_ntz")  # a Monday
    r = df.select(*[v.alias(k) for k, v in X.calendar_features("ts").items()]).first()
    assert (r.hour, r.dayofweek, r.month) == (5, 0, 1)
    assert r.time_ordinal_hours == int(dt.datetime(2024, 1, 1, 5).replace(tzinfo=dt.timezone.utc).timestamp() // 3600)
