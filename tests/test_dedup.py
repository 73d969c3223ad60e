"""U01 / U02 branch rows (FIXTURES.md section 4)."""

import datetime as dt

from forgeline.operators import dedup

T0 = dt.datetime(2025, 1, 1)
SCHEMA = "row_number long, machine_id_raw string, machine_id_std string, event_ts timestamp_ntz, temperature_raw string, temperature double"


def _case(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = dedup.dedup_sensor(df, "temperature").collect()
    return {(r.machine_id_std, r.event_ts): r for r in out}


def test_sensor_dedup_branches(spark):
    h = lambda i: T0 + dt.timedelta(hours=i)
    rows = [
        (1, "MACH-01", "MACH-01", h(0), "30", 30.0),                              # single
        (2, "MACH-01", "MACH-01", h(1), "30", 30.0), (3, "MACH-01", "MACH-01", h(1), "30", 30.0),   # strict
        (4, "MACH-01", "MACH-01", h(2), "", None), (5, "MACH-01", "MACH-01", h(2), "", None),        # strict NULLs
        (6, "MACH-01", "MACH-01", h(3), "", None), (7, "MACH-01", "MACH-01", h(3), "31", 31.0),     # NULL + value
        (8, "MACH-01", "MACH-01", h(4), "32.0", 32.0), (9, "MACH-01", "MACH-01", h(4), "32", 32.0), # two spellings
        (10, "MACH-01", "MACH-01", h(5), "", None), (11, "MACH-01", "MACH-01", h(5), " ", None),    # no value
        (12, "MACH-01", "MACH-01", h(6), "30", 30.0), (13, "MACH-01", "MACH-01", h(6), "34", 34.0), # median of two
        (14, "MACH-01", "MACH-01", h(7), "30", 30.0), (15, "MACH-01", "MACH-01", h(7), "31", 31.0),
        (16, "MACH-01", "MACH-01", h(7), "39", 39.0),                                                # median of three
        (17, "MACH_01", "MACH-01", h(8), "30", 30.0), (18, "M-01", "MACH-01", h(8), "30", 30.0),     # spelling differs
    ]
    got = _case(spark, rows)
    res = {i: (got[("MACH-01", h(i))].dedupe_resolution, got[("MACH-01", h(i))].temperature) for i in range(9)}
    assert res[0] == ("unique", 30.0)
    assert res[1] == ("strict_duplicate_drop", 30.0)
    assert res[2] == ("strict_duplicate_drop", None)
    assert res[3] == ("keep_non_missing_value", 31.0)
    assert res[4] == ("keep_non_missing_value", 32.0)
    assert res[5] == ("all_missing_keep_first", None)
    assert res[6] == ("median_conflict_resolution", 32.0)
    assert res[7] == ("median_conflict_resolution", 31.0)
    assert res[8] == ("keep_non_missing_value", 30.0)
    first = got[("MACH-01", h(8))]
    assert first.machine_id_raw == "MACH_01" and first.row_number == 17 and first.records_in_group == 2
    assert not got[("MACH-01", h(0))].is_duplicate and got[("MACH-01", h(1))].is_duplicate


def test_incident_dedup_most_complete_then_first(spark):
    rows = [
        (1, "INC-1", "op1", None, "a"), (2, "INC-1", "op1", "B1", "a"),     # second more complete
        (3, "INC-2", "op1", None, "a"), (4, "INC-2", None, "B1", "a"),      # tie -> first
        (5, "INC-3", "op1", "B1", None),                                     # single
        (6, "INC-4", None, None, None), (7, "INC-4", "x", None, None), (8, "INC-4", None, "y", "z"),
    ]
    df = spark.createDataFrame(rows, "row_number long, incident_id string, operator_name string, operator_badge string, comment string")
    got = {r.incident_id: r for r in dedup.dedup_incidents(df).collect()}
    assert got["INC-1"].row_number == 2 and got["INC-1"].dedupe_resolution == "keep_most_complete_row"
    assert got["INC-2"].row_number == 3
    assert got["INC-3"].dedupe_resolution == "unique" and not got["INC-3"].is_duplicate
    assert got["INC-4"].row_number == 8 and got["INC-4"].records_in_group == 3


def test_one_row_per_key_on_fixture(spark):
    from forgeline.plans import layers as L

    d = L.FixtureChain(spark, "/root/testdata/sf0.001").t_deduped()
    assert d.count() == d.select("machine_id_std", "event_ts").distinct().count()


def test_golden_resolution_counts_sf001(spark):
    """FIXTURES.md section 5: dedup classes of the raw temperature values at sf0.01."""
    from forgeline.plans import layers as L

    d = dedup.dedup_sensor(L.FixtureChain(spark, "/root/testdata/sf0.01").t_parsed(), "temperature")
    got = {r[0]: r[1] for r in d.groupBy("dedupe_resolution").count().collect()}
    assert got == {"unique": 3173, "strict_duplicate_drop": 95, "keep_non_missing_value": 71,
                   "median_conflict_resolution": 716}


def test_a_small_filter_changes_nothing(spark):
    """With 64 bits nearly every key is a false positive: those groups of one are unique."""
    from forgeline.plans import layers as L

    rows = L.FixtureChain(spark, "/root/testdata/sf0.001").p_parsed()
    a, b, c = (sorted(map(str, dedup.dedup_sensor(rows, "pressure_bar", filter_bits=bits).collect())) for bits in (None, 64, dedup.FILTER_BITS))
    assert a == b == c and a


def test_null_keys_and_single_rows(spark):
    t0 = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([(1, None, t0, 1.0), (2, None, t0, 3.0), (3, "MACH-01", None, 5.0), (4, "MACH-01", t0, None)],
                               "row_number long, machine_id_std string, event_ts timestamp_ntz, temperature double")
    for bits in (None, 64, dedup.FILTER_BITS):
        got = {(r.machine_id_std, r.event_ts): (r.temperature, r.dedupe_resolution, r.is_duplicate, r.records_in_group) for r in dedup.dedup_sensor(df, "temperature", filter_bits=bits).collect()}
        assert got == {(None, t0): (2.0, "median_conflict_resolution", True, 2), ("MACH-01", None): (5.0, "unique", False, 1), ("MACH-01", t0): (None, "unique", False, 1)}
