import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgeline.llm import mixing as X


def test_raking_meets_marginals():
    rng = np.random.default_rng(0)
    cells = [(a, b, c) for a in "pqr" for b in "xy" for c in "mn"]
    tokens = rng.integers(1000, 5000, len(cells)).astype(float)
    goals = [{"p": 0.4, "q": 0.4, "r": 0.2}, {"x": 0.6, "y": 0.4}, {"m": 0.5, "n": 0.5}]
    raked = X.rake(cells, tokens, goals, 0.3 * tokens.sum())
    mass = tokens * raked.probabilities
    assert abs(mass.sum() / tokens.sum() - 0.3) < 1e-6 and raked.worst < 1e-6 and (raked.probabilities <= 1).all()
    for d, goal in enumerate(goals):
        for k, share in goal.items():
            assert abs(sum(m for m, c in zip(mass, cells, strict=True) if c[d] == k) / mass.sum() - share) < 1e-6


def test_raking_against_plain_loops():
    rng = np.random.default_rng(3)
    cells = [(a, b) for a in "abc" for b in "xyz"]
    t = rng.integers(100, 900, 9).astype(float)
    goals = [{"a": 0.2, "b": 0.5, "c": 0.3}, {"x": 0.3, "y": 0.3, "z": 0.4}]
    p = np.full(9, 0.2)
    for _ in range(300):
        for d, goal in enumerate(goals):
            for k, s in goal.items():
                own = np.array([c[d] == k for c in cells])
                p[own] *= s * 0.2 * t.sum() / (t * p)[own].sum()
    assert p.max() < 1
    assert np.allclose(X.rake(cells, t, goals, 0.2 * t.sum()).probabilities, p, atol=1e-6)


def test_capped_cells_give_all_they_have():
    raked = X.rake([("a",), ("b",)], np.array([100.0, 900.0]), [{"a": 0.5, "b": 0.5}], 800.0)
    assert raked.probabilities[0] == 1.0 and raked.probabilities[1] <= 1.0


def test_capped_cells_meet_their_targets():
    raked = X.rake([("a",), ("b",)], np.array([100.0, 900.0]), [{"a": 0.5, "b": 0.5}], 800.0)
    assert np.allclose(raked.probabilities, [1.0, 1 / 9]) and raked.worst < 1e-9
    # by its marginals 625 tokens are possible; less by the cells that cap jointly
    cells, tokens = [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")], np.array([100.0, 400.0, 400.0, 100.0])
    goals = [{"a": 0.8, "b": 0.2}, {"x": 0.8, "y": 0.2}]
    raked = X.rake(cells, tokens, goals, 800.0)
    mass = tokens * raked.probabilities
    # (a, x) holds at least 0.6 of the total and has 100 tokens
    assert 0.99 * 100 / 0.6 <= mass.sum() <= 100 / 0.6 + 1e-6 and raked.worst < 1e-4
    r = np.random.default_rng(5)
    for _ in range(20):
        cells = [(a, b, c) for a in "pqrs" for b in "xyz" for c in "mn"]
        tokens = r.integers(1, 5000, len(cells)).astype(float) ** r.choice([1, 1.5])
        goals = [X.tempered({k: sum(t for t, c in zip(tokens.tolist(), cells, strict=True) if c[d] == k) for k in {c[d] for c in cells}}, 0.5) for d in range(3)]
        raked = X.rake(cells, tokens, goals, 0.9 * tokens.sum())
        mass = tokens * raked.probabilities
        assert (raked.probabilities <= 1).all() and raked.worst < 1e-4
        for d, goal in enumerate(goals):
            for k, share in goal.items():
                assert abs(sum(m for m, c in zip(mass, cells, strict=True) if c[d] == k) / mass.sum() - share) < 1e-4


def test_a_given_target_lowers_the_total_a_tempered_one_is_kept_whole(frame):
    docs = frame([(i, "one two three") for i in range(0, 2100, 3)])  # s3 has a seventh of the tokens
    rows = X.calibrated(docs, F.lit("all"), F.col("source"), F.lit("all"), {"language": {"s3": 0.5, "s0": 0.5}}).collect()
    assert {(r["__language"], round(r["__probability"], 6)) for r in rows if r["__language"] in ("s0", "s3")} == {("s3", 1.0), ("s0", 1.0)}
    assert {r["__probability"] for r in rows if r["__language"] not in ("s0", "s3")} == {0.0}
    shares = X.limited({"a": 0.3, "b": 0.7}, {"a": 100.0, "b": 900.0}, 800.0)
    assert shares["a"] == 0.125 and abs(shares["b"] - 0.875) < 1e-12


def test_contradicting_targets_are_told(frame):
    raked = X.rake([("a", "x"), ("b", "y")], np.array([500.0, 500.0]), [{"a": 0.5, "b": 0.5}, {"x": 0.9, "y": 0.1}], 800.0)
    assert raked.worst > 0.3 and (raked.probabilities <= 1).all() and raked.probabilities.max() == 1.0
    docs = frame([(i, "one two three") for i in range(40)])
    with pytest.warns(UserWarning, match="contradict"):
        X.calibrated(docs, F.col("source"), F.col("source"), F.lit("all"), {"source": {"s0": 0.5, "s3": 0.5}, "language": {"s0": 0.9, "s3": 0.1}})


def test_sample_follows_targets(frame):
    r = random.Random(1)
    docs = frame([(i, "w " * r.randint(1, 60)) for i in range(4000)])
    rows = X.calibrated(docs, F.col("source"), F.col("lang"), F.lit("all"), {"source": {"s0": 0.3, "s3": 0.7, "absent": 0.5}}, keep_share=0.05)
    got = rows.where("__kept").groupBy("__source").agg(F.sum("__tokens").alias("t")).collect()
    shares = {x["__source"]: x.t for x in got}
    total = sum(shares.values())
    assert abs(shares["s3"] / total - 0.7) < 0.08 and set(shares) <= {"s0", "s3"}
    kept = X.sampled(docs)
    assert kept.columns == docs.columns and kept.count() < 4000
    assert sorted(x.doc_id for x in kept.select("doc_id").collect()) == sorted(x.doc_id for x in X.sampled(docs).select("doc_id").collect())


def test_edge_cases(frame):
    docs = frame([(None, None), (None, ""), (1, None), (2, "a b"), (2, "a b"), (3, "x " * 50000)])
    assert X.calibrated(docs, F.col("source"), F.col("lang")).count() == 6
    assert [X.topic_of(t) for t in (None, "", "see the LICENSE here", "1 2 3 4 # 5", "ALL THE CAPITALS IN ONE", "word " * 40)] == [
        "none", "lines", "legal", "symbols", "capitals", "prose"]
    assert X.sampled(frame([(1, None), (2, "")])).count() == 2
    assert X.sampled(frame([])).count() == 0
