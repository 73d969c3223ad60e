"""Gold windows: golden rows from the reference run artifacts, branch rows, invariants."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from forgeline.operators import features

# Golden rows (reference run report, machine MACH-01): hourly means in,
# 24-row rolling statistics out.  Columns: window_start, temp_mean_1h,
# pressure_mean_1h, temp_mean_24h, temp_max_24h, temp_std_24h,
# pressure_mean_24h, pressure_std_24h.
GOLDEN = [
    ("2025-06-11 20:00", 39.98, None, 39.98, 39.98, None, None, None),
    ("2025-07-09 06:00", 35.3, None, 37.64, 39.98, 3.3092597359530447, None, None),
    ("2025-08-10 22:00", 103.95, None, 59.74333333333333, 103.95, 38.355542406975985, None, None),
    ("2025-08-26 00:00", 39.47, 195.687, 54.675, 103.95, 32.916820927908574, 195.687, None),
    ("2025-08-26 01:00", 38.25, 195.567, 51.39, 103.95, 29.437967830677444, 195.627, 0.08485281374238891),
    ("2025-08-26 02:00", 37.41, 196.608, 49.06, 103.95, 26.94157679127189, 195.95400000000004, 0.5695498222280442),
    ("2025-08-26 03:00", 37.66, 196.891, 47.43142857142857, 103.95, 24.96877078043119, 196.18825, 0.6601138159438779),
    ("2025-08-26 04:00", 37.43, 196.308, 46.18125, 103.95, 23.38547194764916, 196.2122, 0.5741782824175696),
    ("2025-08-26 05:00", 37.16, 196.744, 45.178888888888885, 103.95, 22.080824511578168, 196.30083333333334, 0.5575659303317037),
    ("2025-08-26 06:00", 36.12, 196.633, 44.272999999999996, 103.95, 21.014174078993026, 196.34828571428574, 0.5242409478746997),
    ("2025-08-26 07:00", 35.6, 196.765, 43.484545454545454, 103.95, 20.10657174340587, 196.400375, 0.5072215457061742),
    ("2025-08-26 08:00", 34.91, 197.583, 42.77, 103.95, 19.330000705450775, 196.5317777777778, 0.6168587313513761),
    ("2025-08-26 09:00", 36.45, 197.715, 42.28384615384615, 103.95, 18.589889966709297, 196.6501, 0.6915466482216881),
    ("2025-08-26 10:00", 36.61, 196.479, 41.878571428571426, 103.95, 17.92484560909494, 196.63454545454545, 0.6580839404872747),
    ("2025-08-26 11:00", 35.6, 196.734, 41.46, 103.95, 17.34872082563191, 196.64283333333333, 0.6281149045623106),
    ("2025-08-26 12:00", 35.86, 196.72, 41.11, 103.95, 16.81882595981856, 196.64876923076923, 0.601754954812184),
    ("2025-08-26 13:00", 36.87, 197.004, 40.86058823529412, 103.95, 16.317195098495116, 196.67414285714287, 0.5858907560475455),
    ("2025-08-26 14:00", 38.3, 197.36, 40.718333333333334, 103.95, 15.841505517431845, 196.7198666666667, 0.5916999561392772),
    ("2025-08-26 15:00", 38.12, 196.154, 40.58157894736842, 103.95, 15.406712196369297, 196.6845, 0.5888811991112094),
    ("2025-08-26 16:00", 38.17, 195.999, 40.461, 103.95, 15.00548492701042, 196.64417647058823, 0.5939267879223481),
]


def _ts(s):
    return dt.datetime.fromisoformat(s)


def _silver(spark, rows):
    return spark.createDataFrame(rows, "machine_id_std string, event_ts timestamp_ntz, sensor_type string, sensor_value double, is_missing boolean")


def _incidents(spark, rows):
    cols = ", ".join(f"{c} int" for c in features.X.INCIDENT_TYPE_COLUMNS)
    full = [r + (0,) * 9 for r in rows]
    return spark.createDataFrame(full, f"machine_id_std string, event_ts timestamp_ntz, incident_id string, severity int, {cols}")


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)


def test_golden_rolling_rows(spark):
    rows = []
    for g in GOLDEN:
        rows.append(("MACH-01", _ts(g[0]), "temperature", g[1], False))
        if g[2] is not None:
            rows.append(("MACH-01", _ts(g[0]), "pressure", g[2], False))
    gold = features.build_gold(_silver(spark, rows), _incidents(spark, [])).orderBy("window_start").collect()
    assert len(gold) == len(GOLDEN)
    for r, g in zip(gold, GOLDEN):
        got = (r.temp_mean_24h, r.temp_max_24h, r.temp_std_24h, r.pressure_mean_24h, r.pressure_std_24h)
        assert all(_close(a, b) for a, b in zip(got, g[3:])), (g[0], got)
        assert r.split_set in ("train", "validation", "test")


def test_zscore_constant_series_and_clip(spark):
    t0 = dt.datetime(2025, 1, 1)
    rows = [("MACH-02", t0 + dt.timedelta(hours=h), "temperature", 40.0, False) for h in range(5)]
    rows += [("MACH-03", t0 + dt.timedelta(hours=h), "temperature", 40.0 + (h % 2) * 0.001, False) for h in range(30)]
    rows += [("MACH-03", t0 + dt.timedelta(hours=30), "temperature", 1000.0, False)]
    g = {(r.machine_id_std, r.window_start): r for r in features.build_gold(_silver(spark, rows), _incidents(spark, [])).collect()}
    assert all(g[("MACH-02", t0 + dt.timedelta(hours=h))].temp_zscore_24h is None for h in range(5))
    z = g[("MACH-03", t0 + dt.timedelta(hours=30))].temp_zscore_24h
    assert z is not None and 4.0 < z <= 10.0


def test_incident_lookbacks_and_labels(spark):
    t0 = dt.datetime(2025, 1, 1)
    sensor = [("MACH-01", t0 + dt.timedelta(hours=h), "temperature", 40.0, False) for h in range(60)]
    inc = [("MACH-01", t0 + dt.timedelta(minutes=10), "I1", 3),          # first hour
           ("MACH-01", t0 + dt.timedelta(hours=30, minutes=5), "I2", 5),  # middle
           ("MACH-01", t0 + dt.timedelta(hours=59), "I3", 2),            # last hour
           ("MACH-01", t0 + dt.timedelta(hours=100), "I4", 4)]           # no sensor row: dropped
    g = features.build_gold(_silver(spark, sensor), _incidents(spark, inc)).orderBy("window_start").collect()
    assert len(g) == 60
    assert g[0].incident_count_prev_24h == 1 and g[0].hours_since_last_incident == 0.0
    assert g[5].hours_since_last_incident == 5.0 and g[23].incident_count_prev_24h == 1 and g[24].incident_count_prev_24h == 0
    assert g[30].incident_max_severity_prev_24h == 5 and g[31].incident_max_severity_prev_24h == 5
    assert g[25].label_failure_next_6h and not g[24].label_failure_next_6h and g[24].label_failure_next_12h
    assert g[59].label_failure_next_6h and g[59].incident_count_prev_7d == 3
    for r in g:  # label nesting invariant
        assert (not r.label_failure_next_6h or r.label_failure_next_12h) and (not r.label_failure_next_12h or r.label_failure_next_24h)
        assert (not r.label_failure_next_24h or r.label_failure_next_48h)


def test_fixture_invariants(spark):
    from forgeline.plans import layers as L

    g = L.FixtureChain(spark, "/root/testdata/sf0.001").gold()
    bad = g.where((F.col("temp_max_6h") > F.col("temp_max_12h")) | (F.col("temp_max_12h") > F.col("temp_max_24h"))).count()
    assert bad == 0
    assert g.count() == g.select("machine_id_std", "window_start").distinct().count()
    # split is ordered in time
    r = g.groupBy("split_set").agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi")).collect()
    d = {x.split_set: x for x in r}
    assert d["train"].hi < d["validation"].lo <= d["validation"].hi < d["test"].lo


def test_time_based_frames_and_exclusive_lookbacks(spark):
    t0 = dt.datetime(2025, 1, 1)
    hours = [0, 1, 2, 50, 51]
    sensor = [("MACH-01", t0 + dt.timedelta(hours=h), "temperature", float(10 * (i + 1)), False) for i, h in enumerate(hours)]
    inc = [("MACH-01", t0 + dt.timedelta(hours=1), "I1", 3)]
    rows_g = {r.window_start: r for r in features.build_gold(_silver(spark, sensor), _incidents(spark, inc)).collect()}
    time_g = {r.window_start: r for r in features.build_gold(_silver(spark, sensor), _incidents(spark, inc), time_based=True).collect()}
    excl_g = {r.window_start: r for r in features.build_gold(_silver(spark, sensor), _incidents(spark, inc), include_current=False).collect()}
    h50 = t0 + dt.timedelta(hours=50)
    assert rows_g[h50].temp_mean_24h == 25.0          # rows 10,20,30,40: the gap is ignored
    assert time_g[h50].temp_mean_24h == 40.0          # only hour 50 lies within 24 hours
    assert rows_g[h50].incident_count_prev_24h == 1 and time_g[h50].incident_count_prev_24h == 0
    h1 = t0 + dt.timedelta(hours=1)
    assert rows_g[h1].label_failure_next_6h and not excl_g[h1].label_failure_next_6h
    assert rows_g[h1].incident_count_prev_24h == 1 and excl_g[h1].incident_count_prev_24h == 0
    assert excl_g[t0].label_failure_next_6h


def _random_series(spark, hours=400, machines=2):
    import random

    rng = random.Random(11)
    t0, sensors, incidents = dt.datetime(2025, 1, 1), [], []
    for m in range(machines):
        h = 0
        for i in range(hours):
            h += 1 if rng.random() < 0.9 else rng.randint(2, 90)
            at = t0 + dt.timedelta(hours=h, minutes=rng.randint(0, 59))
            sensors.append((f"MACH-{m:02d}", at, rng.choice(["temperature", "pressure"]), None if rng.random() < 0.05 else round(rng.uniform(20, 60), 2), False))
            if (i < 20 or i > 330) and rng.random() < 0.1:  # buckets without an incident in between
                incidents.append((f"MACH-{m:02d}", at, f"I{m}-{i}", rng.randint(1, 5)))
    return _silver(spark, sensors), _incidents(spark, incidents)


@pytest.mark.parametrize(("include_current", "time_based"), [(True, False), (False, False), (True, True), (False, True)])
def test_small_buckets_give_the_same_gold(spark, include_current, time_based):
    """Buckets of a few rows, shorter than every frame, with the last incident carried over several of them."""
    sensors, incidents = _random_series(spark)
    whole, small = (features.build_gold(sensors, incidents, include_current=include_current, time_based=time_based, bucket_hours=b) for b in (1 << 20, 7))
    key = lambda r: (r.machine_id_std, r.window_start)
    a, b = sorted(whole.collect(), key=key), sorted(small.collect(), key=key)
    assert whole.columns == small.columns and len(a) == len(b) and sum(r.hours_since_last_incident is not None for r in a) > 300
    for x, y in zip(a, b):
        for c in whole.columns:
            assert _close(x[c], y[c]) if isinstance(x[c], float) else x[c] == y[c], (c, key(x))


def test_no_window_over_a_machine(spark):
    sensors, incidents = _random_series(spark, hours=5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = features.build_gold(sensors, incidents)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    windows = [ln for ln in plan.splitlines() if ln.strip().lstrip(":+- ").startswith("Window [")]
    assert windows and all("__w_chunk" in ln or "__w_bucket" in ln or "__w_in" in ln or "of_1" in ln for ln in windows)
    assert any("temp_mean_24h" in ln and "__w_bucket" in ln for ln in windows)
