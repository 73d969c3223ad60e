"""Exact distributed quantiles against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgeline.functions.quantiles import exact_quantiles, ordered_bits


def _check(spark, groups, probs=(0.0, 0.25, 0.5, 0.85, 1.0), digits=(22, 21, 21)):
    rows = [(g, None if v is None else float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, "v", list(probs), ["g"], digits).collect()}
    clean = {g: [v for v in vs if v is not None and not np.isnan(v)] for g, vs in groups.items()}
    assert set(got) == {g for g, vs in clean.items() if vs}
    for g, r in got.items():
        assert r.n == len(clean[g])
        for i, p in enumerate(probs):
            assert r[f"q{i}"] == pytest.approx(np.quantile(clean[g], p), rel=1e-12, abs=1e-12)
    everything = [v for vs in clean.values() for v in vs]
    one = exact_quantiles(df, "v", [0.3], None, digits).collect()
    assert one[0].q0 == pytest.approx(np.quantile(everything, 0.3)) if everything else one == []


def test_distinct_doubles_ties_and_outliers(spark):
    rng = np.random.default_rng(3)
    _check(spark, {"distinct": rng.standard_normal(500).tolist(), "ties": rng.integers(0, 4, 300).tolist(), "one": [7.5], "two": [1.0, 2.0],
                   "outlier": [*rng.random(200).tolist(), 1e300], "hot": [3.0] * 400 + [1.0, 9.0], "nothing": [None], None: [1.0, 5.0, None, float("nan")]})


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(df, "v", [0.5]).collect() == [] and exact_quantiles(df, "v", [0.5], ["g"]).collect() == []


EXTREMES = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.0, 1 + 2**-52, 1 - 2**-53, 2.0, 4.0, 8.0 - 2**-50, 1e12, 1e300, 1.7976931348623157e308, float("inf"), float("-inf")]


def test_ordered_bits_are_the_pattern(spark):
    rng = np.random.default_rng(5)
    values = [*EXTREMES, *(-np.array(EXTREMES)).tolist(), *[2.0**e for e in range(-1074, 1024)], *np.nextafter([2.0**e for e in range(-1000, 1024)], 0).tolist(),
              *(rng.standard_normal(2000) * 10.0 ** rng.integers(-300, 300, 2000)).tolist()]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {(r.v, r.b) for r in df.select("v", ordered_bits(df.v).alias("b")).collect()}
    for v, b in got:
        pattern = int(np.abs(np.float64(v)).view(np.int64))
        assert b == (-pattern if v < 0 else pattern), v


def test_infinite_values_count(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in [inf, 1.0, 2.0, 3.0, -inf]], "v double")
    assert tuple(exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0]).first())[1:] == (-inf, 1.0, 2.0, 3.0, inf)


@pytest.mark.parametrize("digits", [(16, 16, 16, 16), (30, 34)])
def test_other_digits(spark, digits):
    rng = np.random.default_rng(4)
    _check(spark, {"a": rng.standard_normal(200).tolist(), "b": [-1e300, 1e-300, 5.0, 5.0]}, digits=digits)


def test_an_outlier_leaves_the_others_spread(spark):
    """With one value of 1e12 no digit holds more than a small share of the rest, so no task orders it all."""
    rng = np.random.default_rng(6)
    values = [*rng.uniform(10, 80, 20_000).tolist(), 1e12]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", F.shiftright(ordered_bits(F.col("v")), 42).alias("digit"))
    assert df.groupBy("digit").count().agg(F.max("count")).first()[0] < 100
    assert exact_quantiles(df, "v", [0.5]).first().q0 == pytest.approx(np.quantile(values, 0.5), rel=1e-15)


def test_rows_that_count_for_several_groups(spark):
    """``into``: every value counts for its group and for all, flagged ones for a third group; rows are not repeated for it."""
    rng = np.random.default_rng(8)
    rows = [(("a", "b", None)[i % 3], bool(i % 4 == 0), float(v)) for i, v in enumerate(rng.standard_normal(300))]
    df = spark.createDataFrame(rows, "g string, flag boolean, v double")
    group = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    both = [group("own", F.col("g")), group("all", F.lit("-"))]
    into = F.when(F.col("flag"), F.array(*both, group("flagged", F.lit("-")))).otherwise(F.array(*both))
    out = exact_quantiles(df, "v", [0.25, 0.5], ["g", "flag"], into=into)
    assert out.columns == ["kind", "name", "n", "q0", "q1"]
    got = {(r.kind, r["name"]): (r.n, r.q0, r.q1) for r in out.collect()}
    want = {("own", g): [v for x, _, v in rows if x == g] for g in ("a", "b", None)} | {("all", "-"): [v for *_, v in rows], ("flagged", "-"): [v for _, f, v in rows if f]}
    assert set(got) == set(want)
    for k, values in want.items():
        assert got[k] == (len(values), pytest.approx(np.quantile(values, 0.25)), pytest.approx(np.quantile(values, 0.5)))


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_rows_are_never_sent_or_sorted_whole(spark, tmp_path, threshold):
    """Stored rows that look small to the planner stay where they are: the few hits go to them, whatever the broadcast threshold."""
    spark.range(20_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 50).cast("double").alias("v")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        q = exact_quantiles(df, "v", [0.5], ["g"])
        joins = [ln for ln in q._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in ln]
        assert len(joins) == 2 and all("BroadcastHashJoin" in ln and "BuildRight" in ln for ln in joins), joins
        assert {r.g: r.q0 for r in q.collect()} == {g: float(np.median([i % 50 for i in range(g, 20_000, 3)])) for g in range(3)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
