"""Physical plan properties: pushdown, pruning, no cartesian products, bounded exchanges."""

import pytest
from pyspark.sql import functions as F

from forgeline.plans import layers as L

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _names():
    from forgeline.plans.queries import queries

    return sorted(queries())


@pytest.mark.parametrize("name", _names())
def test_no_cartesian_products(spark, name):
    from forgeline.plans.queries import queries

    plan = _plan(queries()[name](spark, SF))
    assert not any(op in plan for op in FORBIDDEN), plan


def test_bronze_scan_pushes_parse_ok_and_prunes_columns(spark):
    from __spark_entry__ import queries

    plan = _plan(queries()["s08_bronze_accepted_scan"](spark, SF))
    assert "PushedFilters: [IsNotNull(parse_ok), EqualTo(parse_ok,true)]" in plan
    assert "ReadSchema: struct<row_number:bigint,machine_id_raw:string,timestamp_raw:string,temperature_raw:string,parse_" in plan
    assert "rejected_reason" not in plan.split("ReadSchema")[1] and "ingestion_batch_id" not in plan.split("ReadSchema")[1]


def test_silver_by_type_prunes_partitions(spark):
    from __spark_entry__ import queries

    plan = _plan(queries()["s09_silver_by_sensor_type"](spark, SF))
    assert "PartitionFilters: [isnotnull(sensor_type" in plan and "(sensor_type" in plan and "= pressure)" in plan


def test_gold_plan_shuffles_hourly_rows_only(spark):
    from forgeline.operators.features import build_gold

    c = L.FixtureChain(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(build_gold(c.sensors(), c.i_silver()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # partial + final hourly aggregates, one exchange per aggregate input, one by machine for the windows
    assert plan.count("HashAggregate") >= 4
    assert "Window [" in plan and "SortMergeJoin" in plan or "BroadcastHashJoin" in plan
    assert not any(op in plan for op in FORBIDDEN)


def test_dedup_reads_once_and_joins_nothing(spark):
    """U01 is one aggregate; with a filter, single rows pass and only rows that it contains are shuffled whole."""
    from forgeline.operators.dedup import FILTER_BITS, dedup_sensor

    rows = L.FixtureChain(spark, SF).p_parsed()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan, filtered = _plan(dedup_sensor(rows, "pressure_bar")), _plan(dedup_sensor(rows, "pressure_bar", filter_bits=FILTER_BITS))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for p in (plan, filtered):
        assert "Window" not in p and "partial_" in p
        assert len([ln for ln in p.splitlines() if "Exchange hashpartitioning(machine_id_std" in ln]) == 1
    assert "Join" not in plan and plan.count("FileScan") == 1
    assert all("_word" in ln for ln in filtered.splitlines() if "Join" in ln) and "getbit" in filtered  # the filter's words, no readings


def test_quantiles_never_gather_a_group(spark):
    """No percentile over raw values; only buckets and their distinct values are ordered."""
    from forgeline.functions.quantiles import exact_quantiles
    from forgeline.operators import impute, profile, units

    c = L.FixtureChain(spark, SF)
    t = c.t_parsed()
    frames = [units.machine_baseline(t), impute.group_fill(t, "temperature", "machine_id_std", "median", "f"),
              profile.numeric_profile(t, "t", ["temperature"]), profile.global_iqr_alerts(t, "temperature"), exact_quantiles(t, "temperature", [0.5])]
    for df in frames:
        plan = _plan(df)
        assert "percentile" not in plan and "median(" not in plan
        assert all("_b" in ln for ln in _window_lines(plan))


def _window_lines(plan: str) -> list[str]:
    return [ln for ln in plan.splitlines() if ln.strip().lstrip(":+- ").startswith("Window [")]


def test_unit_windows_never_window_a_whole_machine(spark):
    """W11 orders raw readings only inside (machine, day) chunks or over chunk summaries."""
    from forgeline.operators import units

    c = L.FixtureChain(spark, SF)
    out, _ = units.normalize_temperature_units(c.t_parsed())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = _window_lines(_plan(out))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # chunks of readings, or the baseline's value buckets
    assert lines and all("_chunk" in ln or "_b#" in ln for ln in lines), lines


def test_zscore_alerts_deal_readings_once(spark):
    """Windows run over chunks, and readings cross one exchange; the tails are a filter on it."""
    from forgeline.operators import profile
    from forgeline.plans.q_profile import _datasets

    td, _, _ = _datasets(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(profile.rolling_zscore_alerts(td, "temperature"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = _window_lines(plan)
    assert lines and all("_chunk" in ln for ln in lines), lines
    dealt = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(machine_id_std" in ln and "_chunk" in ln]
    assert sum("ReusedExchange" in ln for ln in dealt) == 1  # the tails read what was dealt for the result
    new = [ln for ln in dealt if "ReusedExchange" not in ln]
    assert sum("ENSURE_REQUIREMENTS" in ln for ln in new) == 1 and sum("REPARTITION_BY_COL" in ln for ln in new) == 2  # counts; readings, copied tails


def test_values_of_a_machine_go_to_its_rows(spark):
    """One row a machine is broadcast; a shuffle by machine would put a machine's readings into one task."""
    from forgeline.operators import impute, regression, units

    t = L.FixtureChain(spark, SF).t_parsed()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [units.normalize_temperature_units(t)[0], impute.group_fill(t, "temperature", "machine_id_std", "mean", "f"), impute.group_fill(t, "temperature", "machine_id_std", "median", "f"),
                  regression.regression_fill(t, "temperature", "machine_id_std", "event_ts", "f"), regression.imputation_features(t, "machine_id_std", "event_ts")]
        for df in frames:
            assert "SortMergeJoin" not in _plan(df) and "ShuffledHashJoin" not in _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
