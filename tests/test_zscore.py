"""Rolling z-scores against a plain scan, over chunks of every size."""

import datetime as dt
import random

import numpy as np
import pytest

from forgeline.operators import profile

SCHEMA = "machine_id_std string, event_ts timestamp_ntz, source_file string, row_number long, temperature double, _home int"


def _rows(seed=1):
    rng = random.Random(seed)
    out = []
    for m, n in (("MACH-01", 900), ("MACH-02", 250), ("MACH-03", 10), (None, 40)):
        at, number = dt.datetime(2025, 1, 1), [0, 0, 0]
        for _ in range(n):  # ties over part files: row numbers restart in every one
            at += dt.timedelta(minutes=rng.choice([0, 0, 1, 30, 60, 60 * 24, 60 * 24 * 9]))
            v = None if rng.random() < 0.03 else rng.gauss(40, 1) + (25 if rng.random() < 0.02 else 0)
            part = rng.randrange(3)
            number[part] += 1
            out.append((m, at, f"part-{part}", number[part], v, 5))
    rng.shuffle(out)
    return out


def _scan(rows, window, least, threshold):
    want = {}
    for m in {r[0] for r in rows} - {None}:
        series = sorted((r for r in rows if r[0] == m and r[4] is not None), key=lambda r: r[1:4])
        for i, r in enumerate(series):
            frame = [x[4] for x in series[max(0, i - window + 1) : i + 1]]
            if len(frame) >= least and np.std(frame) > 0:
                z = (r[4] - np.mean(frame)) / np.std(frame)
                if abs(z) > threshold:
                    want[(m, *r[1:4])] = z
    return want


@pytest.mark.parametrize("unit", ["minute", "day", "month", "year"])
def test_matches_a_scan(spark, unit):
    rows = _rows()
    want = _scan(rows, 168, 24, 0.3)
    df = spark.createDataFrame(rows, SCHEMA).drop("_home")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")  # some partitions are joined, others are not
    try:
        got = profile.rolling_zscore_alerts(df, threshold=0.3, chunk_unit=unit).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    mine = {(r.machine_id, r.event_ts, r.source_file, r.row_number): r.rolling_zscore for r in got}
    assert len(got) == len(mine) == len(want) > 100 and set(mine) == set(want)
    assert all(abs(mine[k] - want[k]) < 1e-9 for k in want)
