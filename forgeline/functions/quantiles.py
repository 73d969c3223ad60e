"""Exact quantiles without one task per group: radix selection.

A double is read as a 64-bit integer in the same order (its bit pattern).  The
values are counted by their first digit, a running total over the digits finds
those that hold the wanted ranks, and only their values are counted by the next
digit, until a digit is one value.  Digits have at most 22 bits, so the counts
that one task orders are bounded whatever the values: one value of 1e12 or an
infinite one takes a digit of its own and leaves the others where they are.
What crosses a shuffle is pre-aggregated counts; what is sent to all tasks is the
digits that hold a wanted rank, at most two rows a group and quantile.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = (22, 21, 21)  # bits of the digits, the first ones first
_LEAST_NORMAL, _LEAST = 2.0**-1022, 2.0**-1074


def ordered_bits(v: Column) -> Column:
    """A long per double, in the order of the doubles: the IEEE pattern of the magnitude, negative for negative values.

    Every step is exact: dividing by a power of two only changes the exponent,
    and the exponent from the logarithm is corrected where that rounds.
    """
    a = F.abs(v)
    power = lambda e: F.pow(F.lit(2.0), e)
    guess = F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(a)).cast("double")))
    exponent = F.when(power(guess) > a, guess - 1).when(a >= power(guess + 1), guess + 1).otherwise(guess)
    normal = (exponent + 1023).cast("long") * (1 << 52) + ((a / power(exponent) - 1) * float(1 << 52)).cast("long")
    magnitude = F.when(a == float("inf"), F.lit(2047 << 52)).when(a < _LEAST_NORMAL, (a / _LEAST).cast("long")).otherwise(normal)
    return F.when(v < 0, -magnitude).otherwise(magnitude)


def exact_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None, digits: tuple[int, ...] = DIGITS,
                    into: Column | None = None) -> DataFrame:
    """One row per group of ``by`` (or one for all): ``n`` and linearly interpolated quantiles ``q0``, ``q1``, ...

    NULL and NaN values don't count, infinite ones do; a group without values
    has no row.  ``into``, an array of structs made from the ``by`` columns,
    names the groups that a row counts for, if those are others or several: the
    result has its fields instead of ``by``.  Counts are handed on to groups,
    not rows, so a row is read once however many groups it counts for.
    """
    if sum(digits) != 64:
        raise ValueError("digits must cover 64 bits")
    by = list(by or [])
    keys = [f"_k{i}" for i in range(len(by))] or ["_k0"]
    named = [F.col(b).alias(k) for b, k in zip(by, keys)] or [F.lit(0).alias("_k0")]
    v = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(v)).select(*named, v.alias("_v"))
    # never null: no filter computes the bits once more before a join
    rows = rows.withColumn("_bits", F.coalesce(ordered_bits(F.col("_v")), F.lit(0).cast("long")))

    def digit(i: int) -> Column:
        return (F.col("_v") if i == len(digits) - 1 else F.shiftright("_bits", 64 - sum(digits[: i + 1]))).alias("_b")

    def same(left: str, right: str, columns: list[str]) -> Column:
        return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in columns])

    counts = rows.select(*keys, digit(0)).groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_c"))
    members, groups = None, keys
    if into is not None:
        told = counts.select(*[F.col(k).alias(b) for b, k in zip(by, keys)], "_b", "_c").select("*", F.explode(into).alias("_g"))
        by_group = told.select("_g.*").columns
        groups = [f"_g{i}" for i in range(len(by_group))]
        to = [F.col("_g").getField(c).alias(g) for c, g in zip(by_group, groups)]
        members = told.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], *to).distinct()
        counts = told.select(*to, "_b", "_c").groupBy(*groups, "_b").agg(F.sum("_c").alias("_c"))
        by = by_group

    def ranks(p: float) -> tuple[Column, Column, Column]:
        """(lower rank, upper rank, weight of the upper value)."""
        position = F.lit(float(p)) * (F.col("_n") - 1)
        return F.floor(position).cast("long"), F.ceil(position).cast("long"), position - F.floor(position)

    every = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = counts.withColumn("_n", F.sum("_c").over(every)).withColumn("_from", F.lit(0).cast("long"))
    wanted = F.array(*[r for p in probs for r in ranks(p)[:2]])
    inside = groups
    for i in range(len(digits)):
        if i:  # only values whose digits so far hold a wanted rank
            left = 64 - sum(digits[:i])
            if members is not None:
                hit = members.alias("m").join(F.broadcast(hit.alias("h")), same("m", "h", groups)).select(*[F.col(f"m.{k}") for k in keys], *[F.col(f"h.{c}") for c in [*groups, "_b", "_n", "_before"]])
            # stored rows can look small to the planner, so it might collect and send those instead of the hits
            open_ = rows.alias("r").join(F.broadcast(hit.alias("h")), same("r", "h", keys) & (F.shiftright("r._bits", left) == F.col("h._b")))
            open_ = open_.select(*[F.col(f"h.{g}").alias(g) for g in groups], "r._bits", "r._v", "h._n", F.col("h._before").alias("_from"))
            inside = [*groups, "_n", "_from"]
            counts = open_.select(*inside, digit(i)).groupBy(*inside, "_b").agg(F.count(F.lit(1)).alias("_c"))
        running = Window.partitionBy(*inside).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.col("_from") + F.coalesce(F.sum("_c").over(running), F.lit(0)))
        hit = counts.where(F.exists(wanted, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c"))))
    keys = groups

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_c")), F.col("_b")))

    picked = hit.groupBy(*keys, "_n").agg(*[x for i, p in enumerate(probs) for x in (at(ranks(p)[0]).alias(f"_low{i}"), at(ranks(p)[1]).alias(f"_high{i}"))])
    out = [F.col(k).alias(b) for b, k in zip(by, keys)] + [F.col("_n").alias("n")]
    for i, p in enumerate(probs):
        low, high, weight = F.col(f"_low{i}"), F.col(f"_high{i}"), ranks(p)[2]
        between = F.when(low == high, low).otherwise(low * (1 - weight) + high * weight)  # an infinite value times 0 is none
        out.append(between.alias(f"q{i}"))
    return picked.select(*out)
