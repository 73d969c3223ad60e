"""W11 Fahrenheit windows: branch rows and golden counts."""

import datetime as dt

from forgeline.operators import units
from forgeline.plans import layers as L

SCHEMA = "row_number long, machine_id_std string, event_ts timestamp_ntz, temperature double"


def _rows(spec, start=dt.datetime(2025, 1, 1)):
    """spec: list of (hour offset, value)."""
    return [(i, "MACH-01", start + dt.timedelta(hours=h), v) for i, (h, v) in enumerate(spec)]


def _norm(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out, win = units.normalize_temperature_units(df, **kw)
    got = {r.row_number: r.detected_unit for r in out.collect()}
    return got, win.collect()


BASE = [(h, 37.0 + (h % 3) * 0.5) for h in range(0, 30)]  # normal readings, baseline ~37.5


def test_run_of_three_converted_run_of_two_kept(spark):
    spec = BASE + [(40, 99.0), (41, 99.5), (42, 98.6), (50, 37.0), (60, 99.0), (61, 99.2), (70, 37.2)]
    got, win = _norm(spark, _rows(spec))
    n = len(BASE)
    assert [got[n], got[n + 1], got[n + 2]] == ["F", "F", "F"]
    assert got[n + 4] == "C" and got[n + 5] == "C"
    assert len(win) == 1 and win[0].points_converted == 3


def test_gap_rules(spark):
    # gap of exactly 2h keeps the run; a 3h gap breaks it
    spec = BASE + [(40, 99.0), (42, 99.5), (44, 98.6), (60, 99.0), (63, 99.5), (66, 98.6)]
    got, win = _norm(spark, _rows(spec))
    n = len(BASE)
    assert [got[n + i] for i in range(3)] == ["F"] * 3
    assert [got[n + 3 + i] for i in range(3)] == ["C"] * 3
    assert len(win) == 1


def test_null_and_normal_value_break_runs(spark):
    spec = BASE + [(40, 99.0), (41, 99.5), (42, None), (43, 98.6), (50, 99.0), (51, 37.0), (52, 99.5), (53, 99.1)]
    got, win = _norm(spark, _rows(spec))
    assert "F" not in got.values()
    assert win == []


def test_isolated_spike_stays_unconverted(spark):
    spec = BASE + [(40, 103.95)]
    got, _ = _norm(spark, _rows(spec))
    assert set(got.values()) == {"C"}


def test_baseline_falls_back_to_overall_median(spark):
    rows = _rows([(0, 95.0), (1, 96.0), (2, 97.0)])
    b = units.machine_baseline(spark.createDataFrame(rows, SCHEMA)).first()
    assert b.baseline_celsius == 96.0


def test_null_machine_and_all_null_pass_through(spark):
    rows = [(1, None, dt.datetime(2025, 1, 1), 99.0), (2, "MACH-02", dt.datetime(2025, 1, 1), None),
            (3, "MACH-02", dt.datetime(2025, 1, 1, 1), None)]
    got, win = _norm(spark, rows)
    assert got == {1: "C", 2: "C", 3: "C"} and win == []


def test_small_chunks_match_day_chunks(spark):
    spec = BASE + [(40, 99.0), (41, 99.5), (42, 98.6), (43, 99.1), (47, 37.0)]
    a, _ = _norm(spark, _rows(spec), chunk_unit="day")
    b, _ = _norm(spark, _rows(spec), chunk_unit="hour")
    assert a == b


def test_golden_counts_sf001(spark):
    c = L.FixtureChain(spark, "/root/testdata/sf0.01")
    norm, win = c.t_normalized()
    assert win.count() == 32
    assert norm.where("detected_unit = 'F'").count() == 143


def _reference(rows):
    """(row numbers converted, runs as (start, end, points)) by a scan of each machine's rows in order."""
    base = {}
    for m in {r[1] for r in rows}:
        usual = sorted(r[3] for r in rows if r[1] == m and r[3] is not None and 10 <= r[3] <= 80) or sorted(r[3] for r in rows if r[1] == m and r[3] is not None)
        base[m] = (usual[(len(usual) - 1) // 2] + usual[len(usual) // 2]) / 2 if usual else None
    converted, runs = set(), []
    for m in base:
        run = []

        def close():
            if len(run) >= 3:
                converted.update(r[0] for r in run)
                runs.append((m, run[0][2], run[-1][2], len(run)))
            run.clear()

        before = None
        for r in sorted((r for r in rows if r[1] == m), key=lambda r: (r[2], r[0])):
            v, b = r[3], base[m]
            c = None if v is None else (v - 32) * 5 / 9
            hot = v is not None and 80 <= v <= 180 and 10 <= c <= 80 and abs(c - b) + 3 < abs(v - b)
            if not hot or (before is not None and (r[2] - before) > dt.timedelta(hours=2)):
                close()
            if hot:
                run.append(r)
            before = r[2]
        close()
    return converted, sorted(runs)


def test_runs_that_cross_chunks(spark):
    """Runs over many chunks, over chunks of one row, with ties, gaps of exactly two hours at a chunk's edge and runs of two."""
    import random

    rng = random.Random(2)
    start, rows = dt.datetime(2025, 3, 1), []
    for m in ("MACH-01", "MACH-02", "MACH-03"):
        at, hot = start, False
        for _ in range(500):
            at += dt.timedelta(minutes=rng.choice([0, 1, 20, 60, 119, 120, 120, 121, 300]))
            hot = hot if rng.random() < 0.85 else not hot
            rows.append((len(rows), m, at, None if rng.random() < 0.03 else 98.0 + rng.random() if hot else 37.0 + rng.random()))
    rng.shuffle(rows)
    want, runs = _reference(rows)
    assert len(runs) > 30 and any(r[2].date() > r[1].date() for r in runs)
    for unit in ("day", "hour", "minute", "month"):
        out, win = units.normalize_temperature_units(spark.createDataFrame(rows, SCHEMA), chunk_unit=unit)
        got = out.collect()
        assert len(got) == len(rows) and {r.row_number for r in got if r.detected_unit == "F"} == want
        assert sorted((r.machine_id_std, r.window_start, r.window_end, r.points_converted) for r in win.collect()) == runs


def test_raw_rows_are_sorted_once(spark):
    df = spark.createDataFrame(_rows(BASE), SCHEMA).repartition(2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        out, _ = units.normalize_temperature_units(df)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sorts = [ln for ln in plan.splitlines() if "Sort [" in ln and "__w11_chunk" in ln]
    assert len(sorts) == 1 and "__w11_run" not in plan  # the run's number is only computed for the summary
    assert not any("Join" in ln and ("segment" in ln or "__w11_chunk" in ln) for ln in plan.splitlines())
