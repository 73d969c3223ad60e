import random

import numpy as np

from forgeline.llm import parity_join as J
from forgeline.llm.common import WordHashes
from forgeline.llm.components import components


def made(seed=4):
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(900)]
    passage = [r.choice(vocab) for _ in range(40)]
    rows, d = [], 0
    for k in range(14):
        n = r.choice([3, 6, 20, 70, 130, 260, 500])
        base = [r.choice(vocab) for _ in range(n)]
        for _ in range(r.randint(1, 5)):
            w = list(base)
            for _ in range(r.randint(0, max(0, n // 40))):
                w[r.randrange(len(w))] = r.choice(vocab)
            if r.random() < 0.3:
                w = w[: max(1, int(len(w) * r.uniform(0.8, 1)))]
            if r.random() < 0.2 and n > 200:
                w += passage
            rows.append((d, " ".join(w) if d % 3 else "  ".join(w).upper()))
            d += 1
    # a chain: each a small edit of the one before
    w = [r.choice(vocab) for _ in range(200)]
    for _ in range(12):
        w = list(w)
        w[r.randrange(200)] = r.choice(vocab)
        w[r.randrange(200)] = r.choice(vocab)
        rows.append((d, " ".join(w)))
        d += 1
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "single"), (904, "SINGLE"), (905, "É é")]


def test_matches_brute_force(frame):
    rows = made()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(frame(rows)).collect()}
    assert got == J.brute_force(rows)


def test_every_linked_pair_shares_a_group():
    r = random.Random(9)
    h = WordHashes()
    for n in (5, 12, 63, 66, 80, 127, 129, 159, 161, 400, 1500):
        for _ in range(6):
            a = np.unique(np.array([r.getrandbits(63) for _ in range(n)], np.uint64))
            d = r.randint(0, J.own_difference(n) // 2)
            b = np.unique(np.concatenate([a[d:], np.array([r.getrandbits(63) for _ in range(r.randint(0, d))], np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                meet = [(band, {int(k) for k in J.groups(a, band)} & {int(k) for k in J.groups(b, band)}) for band in J.bands(len(a)) if band in J.bands(len(b))]
                assert any(len(m) > max(J.spare(len(a), band), J.spare(len(b), band)) for band, m in meet), (n, d)
                assert J.hamming(J.parity_bits(a), J.parity_bits(b)) <= len(a) + len(b) - 2 * both <= J.difference(len(a), len(b))
    assert h is not None


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)] + [(7, 7)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_and_edges(frame):
    base = " ".join(f"q{i}" for i in range(50))
    docs = frame([(3, base), (1, base + " end"), (2, "other words entirely here now"), (None, base), (4, None), (5, ""), (3, base), (8, "z " * 30000)])
    near = sorted(((r.doc_id, r.component_id) for r in J.near_duplicates(docs).collect()), key=str)
    assert near == sorted([(3, 1), (3, 1), (1, 1), (2, 2), (None, None), (4, 4), (5, 5), (8, 8)], key=str)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, None, 4, 5, 8], key=str)
    assert J.near_duplicates(frame([])).count() == 0 and J.keep_one(frame([])).count() == 0


def test_keep_one_keeps_one_row_of_the_smallest_id(frame):
    base = " ".join(f"q{i}" for i in range(50))
    # id 1 leads a group and is repeated, with another text too; 20 has no links; 30 has words in one row only; 40 goes, but for its wordless row
    rows = [(1, base), (1, base), (1, base + " end"), (3, base), (3, base), (20, "alone here"), (20, "alone here"), (20, "quite another text"),
            (30, "some words"), (30, None), (30, " \n"), (40, base), (40, ""), (None, base), (None, base), (50, "single row")]
    docs = frame(rows)
    got = J.keep_one(docs)
    assert got.columns == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    alone = [t for d, t in kept if d == 20]
    lead = [t for d, t in kept if d == 1]
    assert len(alone) == len(lead) == 1 and (1, lead[0]) in rows and (20, alone[0]) in rows
    assert [r for r in kept if r[0] not in (1, 20)] == sorted([(30, "some words"), (30, None), (30, " \n"), (40, ""), (None, base), (None, base), (50, "single row")], key=str)
    again = J.keep_one(frame(rows[::-1]).repartition(5))
    assert sorted(((r.doc_id, r.text) for r in again.collect()), key=str) == kept


def drifting(n=120, words=150, seed=3):
    """A group in which each document is near the next one only, and templates that are not quite near each other."""
    r = random.Random(seed)
    word = lambda: f"d{r.randrange(10**6)}"
    w, rows = [word() for _ in range(words)], []
    for d in range(n):
        w = list(w)
        w[r.randrange(words)] = word()
        w[r.randrange(words)] = word()
        rows.append((5000 - d, " ".join(w)))
    base = [word() for _ in range(words)]
    for d in range(n):  # 3 of 150 words differ from the template each: similarity around the threshold
        t = list(base)
        for _ in range(3):
            t[r.randrange(words)] = word()
        rows.append((9000 + d, " ".join(t)))
    return rows


def test_a_group_that_no_centre_links(frame, monkeypatch):
    rows = drifting()
    want = J.brute_force(rows)
    counts = []
    within = J._likely_within

    def counted(more):
        counts.append(more)
        return within(more)

    monkeypatch.setattr(J, "_likely_within", counted)
    monkeypatch.setattr(J, "BLOCK", 25)  # cells of two blocks
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.near_duplicates(frame(rows)).collect()}
    assert got == want
    assert 5000 - 119 in {c for _, c in want.values()} and counts


def test_a_cell_returns_a_forest():
    """All pairs of 3,000 rows are likely: fewer edges than rows leave a cell, large or small, and none of the refuted ones."""
    import pyarrow as pa

    n = 3000
    sets = [np.arange(i, i + 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(3)]
    columns = {"key": [1] * n, "i": [0] * n, "j": [0] * n, "side": [0] * n, "rep": list(range(n)), "comp": list(range(n)), "n": [400] * n,
               "sketch": [J.parity_bits(sets[i % 3]) for i in range(n)], "refuted": [[1, 2] if i == 0 else [0] if i < 3 else [] for i in range(n)]}
    table = pa.table(columns)
    out = J._likely_within(0)(table)
    assert out.num_rows == n - 1 and not {(0, 1), (0, 2)} & set(zip(out["x"].to_pylist(), out["y"].to_pylist()))
    for cells in ([1] * 60, [k // 3 for k in range(60)]):
        few = table.slice(0, 60).set_column(0, "key", pa.array(cells))
        assert J._likely_within(0)(few).num_rows == (59 if cells[0] else 39)
        assert J._likely_within(0)(few).num_rows < J._likely_within(2)(few).num_rows <= 3 * 60


def test_sketches_of_different_lengths():
    r = random.Random(2)
    sets = [np.unique(np.array([r.getrandbits(63) for _ in range(k)], np.uint64)) for k in (3, 15, 16, 31, 33, 40, 63, 64, 70)]
    bits = [J.parity_bits(x) for x in sets]
    all_ = J.Sketches(bits)
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if max(len(bits[i]), len(bits[j])) <= 2 * min(len(bits[i]), len(bits[j]))]
    got = all_.apart(*map(np.array, zip(*pairs)))
    assert got.tolist() == [J.hamming(bits[i], bits[j]) for i, j in pairs]
