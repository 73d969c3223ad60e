"""Operator 9: mixing sources to target weights by iterative proportional fitting.

Token counts are summed over the cells (source, language, topic).  The cells'
sampling probabilities are raked in turn to each dimension's target shares of
the kept tokens, never above 1, until all marginals fit.  A document is kept if
a hash of its id (and text) lies below its cell's probability, so the same
document is drawn in every run and the kept tokens follow the targets in
expectation.

Targets not given are the observed shares raised to ``TEMPERATURE``, which
lifts small categories, but none above all its tokens: a category too small for
its lifted share is kept whole.  ``keep_share`` is the largest share of all
tokens kept: less is kept where a category has too few tokens for a given
target.  Targets that contradict each other at every total are met as nearly as
possible, with a warning.

Only the cells reach the driver: the product of three category lists, checked
against ``MAX_CELLS``.

Edge cases: a null category is a category of its own; a target for an absent
category is left out and the others scaled; a null or empty text has no
tokens and is drawn with its cell's probability; without any tokens all
documents are kept.  Repeated rows share one draw; an empty table gives an
empty result; other columns are passed through, whatever their names.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgeline.llm.common import plainly_named

TEMPERATURE = 0.7
KEEP_SHARE = 0.8
MAX_CELLS = 1_000_000
BROADCAST_CELLS = 10_000
ROUNDS = 500
STEP = 1e-3
FIT = 1e-5  # a share this near its target is met
MISS = 1e-3  # a share farther from its target is told
NULL = "\0null"

_DIMS = ("__source", "__language", "__topic")


# Fixed bytes whose share tells forms of text apart.
_SIGNS = b"0123456789#$%&*+=<>{}|"
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def topic_of(text: str | None) -> str:
    """A coarse topic from a text's form, for tables without one: legal, symbols, capitals, lines or prose."""
    if text is None:
        return "none"
    data = text.encode()
    size, low = len(data), data.lower()
    if b"license" in low or b"licence" in low or b"copyright" in low:
        return "legal"
    if size - len(data.translate(None, _SIGNS)) > 0.04 * size:
        return "symbols"
    if size - len(data.translate(None, _CAPITALS)) > 0.4 * size:
        return "capitals"
    return "lines" if size < 60 * (1 + data.count(b"\n")) else "prose"


def described(docs: DataFrame) -> DataFrame:
    """``docs`` with __form (the topic by form) and __tokens (words) of every whole text."""
    at = docs.columns.index("text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([topic_of(t) for t in texts], pa.string()), pa.array([len((t or "").encode().split()) for t in texts], pa.int64())],
                names=[*batch.schema.names, "__form", "__tokens"])

    return docs.mapInArrow(describe, T.StructType([*docs.schema.fields, T.StructField("__form", T.StringType()), T.StructField("__tokens", T.LongType())]))


@dataclass(frozen=True)
class Raked:
    probabilities: np.ndarray
    rounds: int
    worst: float  # largest difference of a marginal share from its target


def tempered(totals: dict[str, float], temperature: float) -> dict[str, float]:
    powers = {k: v**temperature for k, v in totals.items() if v > 0}
    return {k: p / sum(powers.values()) for k, p in powers.items()}


def limited(shares: dict[str, float], totals: dict[str, float], total: float) -> dict[str, float]:
    """``shares`` of a total, but no category above all its tokens; the others share the rest in proportion."""
    whole: dict[str, float] = {}
    while True:
        rest = {k: s for k, s in shares.items() if k not in whole}
        scale = (1 - sum(whole.values())) / sum(rest.values()) if rest else 0.0
        more = {k: totals[k] / total for k, s in rest.items() if s * scale * total > totals[k] * (1 + 1e-12)}
        if not more:
            return whole | {k: s * scale for k, s in rest.items()}
        whole |= more


def _fitted(codes: list[tuple[np.ndarray, np.ndarray]], tokens: np.ndarray, total: float, cap: bool) -> Raked:
    """Probabilities of the form min(1, product of one factor per category) for a total; without ``cap`` they may exceed 1.

    The factor of a capped category is found by Newton's method from below:
    its tokens are concave in the factor, so the steps never overshoot.
    """
    r = np.full(len(tokens), total / tokens.sum())
    p, worst, n = r, np.inf, 0
    for n in range(1, ROUNDS + 1):
        before = p
        for own, share in codes:
            goal, k = share * total, len(share)
            mass = np.bincount(own, tokens * r, k)
            factor = np.where(mass > 0, goal / np.where(mass > 0, mass, 1), 1.0)
            while cap:
                over = r * factor[own] > 1
                free, held = np.bincount(own, np.where(over, 0, tokens * r), k), np.bincount(own, np.where(over, tokens, 0), k)
                new = np.where(free > 0, np.maximum(goal - held, 0) / np.where(free > 0, free, 1), factor)
                if (new <= factor * (1 + 1e-12)).all():
                    break
                factor = np.maximum(new, factor)
            r = np.minimum(r * factor[own], 1e100)
        p = np.minimum(r, 1.0) if cap else r
        worst = max((float(np.abs(np.bincount(own, tokens * p, len(share)) / total - share).max(initial=0)) for own, share in codes), default=0.0)
        if worst < 1e-9 or np.abs(p - before).max(initial=0) < 1e-10:
            break
    return Raked(p, n, worst)


def rake(cells: list[tuple[str, ...]], tokens: np.ndarray, targets: list[dict[str, float]], wanted: float) -> Raked:
    """Sampling probabilities of the cells, at most 1: raked to every dimension's targets at the largest total up to ``wanted`` that allows them.

    No total above available / target share of a category can meet its target;
    where cells reach 1 jointly, the total is lowered further by bisection, to
    ``STEP`` of itself.  Targets that contradict each other at every total are
    met as nearly as raking without a cap does.
    """
    if not tokens.sum():
        return Raked(np.ones(len(cells)), 0, 0.0)
    if wanted <= 0:
        return Raked(np.zeros(len(cells)), 0, 0.0)
    codes, high = [], min(wanted, float(tokens.sum()))
    for d, target in enumerate(targets):
        names = sorted({c[d] for c in cells})
        at = {n: i for i, n in enumerate(names)}
        own = np.array([at[c[d]] for c in cells], dtype=np.int64)
        there = np.bincount(own, tokens, len(names))
        share = np.array([target.get(n, 0.0) for n in names]) * (there > 0)
        share = share / share.sum() if share.sum() else share
        codes.append((own, share))
        high = min([high, *(there[share > 0] / share[share > 0]).tolist()])
    found = _fitted(codes, tokens, high, cap=False)
    least, top = found.worst, float(found.probabilities[tokens > 0].max())
    if top > 1 + 1e-9:
        low = high / top  # here no cell is capped
        found = Raked(found.probabilities / top, found.rounds, least)
        total = high
        while high - low > STEP * high:
            tried = _fitted(codes, tokens, total, cap=True)
            if tried.worst <= least + FIT:
                found, low = tried, total
            else:
                high = total
            total = (low + high) / 2
    p = np.minimum(found.probabilities, 1.0)
    return Raked(np.where(p > 1 - 1e-9, 1.0, p), found.rounds, found.worst)


def calibrated(docs: DataFrame, source: Column, language: Column, topic: Column | None = None, targets: dict[str, dict[str, float]] | None = None,
               keep_share: float = KEEP_SHARE, temperature: float = TEMPERATURE) -> DataFrame:
    """``docs`` with __source, __language, __topic (by form unless given), __tokens, __probability and __kept."""
    spark = docs.sparkSession
    topic = F.col("__form") if topic is None else topic
    named = [F.coalesce(c.cast("string"), F.lit(NULL)).alias(d) for d, c in zip(_DIMS, (source, language, topic), strict=True)]
    rows = described(docs).select("*", *named).drop("__form")
    sums = rows.groupBy(*_DIMS).agg(F.sum("__tokens").alias("t")).limit(MAX_CELLS + 1).collect()
    if len(sums) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells of source, language and topic: use coarser categories")
    sums.sort(key=lambda r: tuple(r[:3]))
    cells, tokens = [tuple(r[:3]) for r in sums], np.array([float(r["t"]) for r in sums])
    wanted, sizes, goals = keep_share * float(tokens.sum()), [], []
    for d, name in enumerate(("source", "language", "topic")):
        totals: dict[str, float] = {}
        for c, t in zip(cells, tokens.tolist(), strict=True):
            totals[c[d]] = totals.get(c[d], 0.0) + t
        sizes.append(totals)
        goals.append((targets or {}).get(name))
        there = {k: g for k, g in (goals[d] or {}).items() if g > 0 and totals.get(k, 0) > 0}
        wanted = min([wanted, *(totals[k] * sum(there.values()) / g for k, g in there.items())])
    goals = [goal or limited(tempered(totals, temperature), totals, wanted) for goal, totals in zip(goals, sizes, strict=True)]
    raked = rake(cells, tokens, goals, wanted)
    if raked.worst > MISS:
        warnings.warn(f"mixing targets contradict each other: a share stays {raked.worst:.4f} from its target", stacklevel=2)
    table = [(*c, float(p)) for c, p in zip(cells, raked.probabilities, strict=True)]
    found = spark.createDataFrame(table, "__s string, __l string, __t string, __probability double")
    found = F.broadcast(found) if len(table) <= BROADCAST_CELLS else found
    rows = rows.join(found, (F.col("__source") == F.col("__s")) & (F.col("__language") == F.col("__l")) & (F.col("__topic") == F.col("__t")), "left").drop("__s", "__l", "__t")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("mixing"), F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text"))), 11).cast("double") / float(2**53)
    return rows.withColumn("__kept", draw < F.coalesce("__probability", F.lit(1.0)))


def sampled(docs: DataFrame, **options) -> DataFrame:
    """The documents drawn, all their columns: source and lang columns, topic by form."""
    plain = plainly_named(docs, "doc_id", "text", "source", "lang")
    rows = calibrated(plain, F.col("source"), F.col("lang"), **options)
    return rows.where("__kept").select(*plain.columns).toDF(*docs.columns)
