import numpy as np
import pytest

from forgeline.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, label int, list int, query array<int>, score int, rank int"


def table(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, [1], 2, 3) for i, v in vectors], SCHEMA)


def found(spark, vectors, k=10):
    t = table(spark, vectors)
    out = {}
    for r in A.search(t, A.valid_vectors(t).where("vec_id % 100 = 0"), k).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(v, s) for _, v, s in sorted(x)] for q, x in out.items()}


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, rng.standard_normal(24).astype(np.float32)) for i in range(8)]
    got = found(spark, vectors)
    want = A.brute_force([(i, [float(x) for x in v]) for i, v in vectors], {0})
    assert [v for v, _ in got[0]] == [v for _, v in want[0]] and len(got[0]) == 7
    assert [s for _, s in got[0]] == pytest.approx([s for s, _ in want[0]], abs=1e-12)


def test_recall_and_hot_vector(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 40))
    x = (centres[rng.integers(0, 12, 1500)] + 0.4 * rng.standard_normal((1500, 40))).astype(np.float32)
    x[500:900] = x[500]  # many copies of one vector
    vectors = [(i, x[i]) for i in range(1500)]
    got = found(spark, vectors)
    want = A.brute_force([(i, [float(y) for y in v]) for i, v in vectors], {i for i in range(0, 1500, 100)})
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    recall = np.mean([len({v for v, _ in got[q]} & {v for _, v in want[q]}) / 10 for q in want])
    assert recall >= 0.95
    assert [v for v, _ in got[500]] == list(range(501, 511)) and got[500][0][1] == 0.0


def test_invalid_rows_take_no_part(spark):
    v = [1.0, 2.0, 3.0]
    vectors = [(0, v), (100, [0.0, 0.0, 0.0]), (1, None), (2, [1.0, None, 2.0]), (3, [1.0, float("nan"), 2.0]), (4, [1.0, float("inf"), 2.0]),
               (5, [1.0, 2.0]), (6, [1.0, 2.0, 4.0]), (0, v), (None, v), (7, v)]
    got = found(spark, vectors)
    assert got == {0: [(7, 0.0), (6, 1.0)]}
    assert found(spark, []) == {} and found(spark, [(0, v)]) == {}


def test_scan_abandons_but_keeps_the_nearest():
    rng = np.random.default_rng(5)
    x, q = rng.standard_normal((3000, 96)), rng.standard_normal(96)
    turn, ids = A.rotation(96), np.arange(3000)
    got = A.adaptive_scan(q, q @ turn, ids, x, x @ turn, -1, 10)
    d = np.sqrt(((x - q) ** 2).sum(1))
    assert len({i for _, i in got} & set(np.argsort(d)[:10].tolist())) >= 9
    assert np.allclose(turn @ turn.T, np.eye(96))
