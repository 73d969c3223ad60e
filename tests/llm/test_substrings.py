import random

import numpy as np

from forgeline.llm import substrings as S


def made(seed=1, n=40):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(500)] + ["É", "a", "a b"]
    base = [[r.choice(vocab) for _ in range(r.randint(0, 120))] for _ in range(n)]
    shared = [r.choice(vocab) for _ in range(60)]
    line = [r.choice(vocab) for _ in range(12)]
    rows = []
    for i, w in enumerate(base):
        if i % 3 == 0:
            k = r.randint(0, len(w))
            w = w[:k] + shared[r.randint(0, 20) :] + w[k:]
        if i % 2 == 0:
            w = line + w
        if i % 7 == 3:
            w = list(base[i - 3])
        rows.append((i, r.choice([" ", "\n", " \t"]).join(w)))
    rows += [(100, " ".join(["x"] * 200)), (101, " ".join(["x", "y"] * 60)), (102, None), (103, ""), (104, "one two")]
    return rows


def check(frame, rows, **patched):
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in S.without_repeats(frame(rows)).collect()}
    want = S.brute_force(rows)
    assert got == want
    return want


def test_matches_brute_force(frame):
    want = check(frame, made())
    assert sum(w[1] > 0 for w in want.values()) > 10


def test_many_buckets_small_chunks_and_late_minimisers(frame, monkeypatch):
    # workers import the module afresh, so the kernels are run here over small chunks and all three steps
    import pyarrow as pa

    monkeypatch.setattr(S, "CHUNK_WORDS", 150)
    rows = made(5)
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), pa.array([hash(t) for _, t in rows], pa.int64()),
                                        pa.array([t for _, t in rows], pa.string())], names=["doc_id", "tie", "text"])
    late = np.unique(np.concatenate([np.array(b.column(0), dtype=np.int64) for b in S._frequent([batch])]))
    late = late[late >= 0].astype(np.uint64)
    packed = pa.Table.from_batches(list(S._packer(5, late)([batch])))
    spans: dict[int, set] = {}
    for b in set(packed["bucket"].to_pylist()):
        out = S._counted(packed.filter(pa.compute.equal(packed["bucket"], b)))
        for d, _, i, j in zip(*(out[c].to_pylist() for c in ("doc_id", "tie", "first", "stop")), strict=True):
            spans.setdefault(d, set()).update(range(i, j))
    want = S.brute_force(rows)
    assert {d: len(spans.get(d, ())) for d in want} == {d: w[1] for d, w in want.items()}


def test_hash_collisions_are_told_apart(monkeypatch):
    monkeypatch.setattr(S, "_window_hashes", lambda ids: np.zeros(len(ids) - S.WINDOW + 1, np.uint64))
    ids = np.concatenate([np.arange(30), np.arange(30)])
    at = np.concatenate([np.arange(11), 30 + np.arange(11)])
    doc, zero, start = np.repeat([1, 2], 11), np.zeros(22, int), np.tile(np.arange(11), 2)
    assert S._repeats(ids, at, doc, zero, start).tolist() == [False] * 11 + [True] * 11


def test_edge_cases(frame):
    long = " ".join(f"t{i}" for i in range(30))
    got = S.without_repeats(frame([(1, long), (1, long), (None, long), (2, "q " + long), (3, None)])).collect()
    removed = sorted(((r.doc_id, r.n_removed) for r in got), key=str)
    assert removed == sorted([(1, 0), (1, 0), (None, 30), (2, 30), (3, 0)], key=str)
    assert S.without_repeats(frame([])).count() == 0
