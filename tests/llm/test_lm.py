import math
import random
import zlib
from collections import Counter

import pytest

from forgeline.llm import lm as M


def rows():
    r = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    out = []
    for i in range(150):
        w, t = r.choice(vocab), []
        for _ in range(r.randint(0, 60)):
            t.append(w if r.random() < 0.8 else w.upper())
            w = vocab[(vocab.index(w) + r.choice([1, 1, 1, 2])) % 60] if r.random() < 0.7 else r.choice(vocab)
        out.append((i, " ".join(t)))
    return out + [(500, None), (501, ""), (502, "rare É unseen"), (502, "rare É unseen"), (None, "w1 w2")]


def tokens(t):
    return (t or "").encode().lower().split() + [None]


def test_counts_base_and_mixture(frame, spark):
    data = rows()
    got = M.score_documents(frame(data)).collect()
    assert len(got) == len(data)
    fold = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 7
    train = [(d, t) for d, t in data if fold(d) != 2]
    c = Counter(w for _, t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    pairs, context = Counter(), Counter()
    for _, t in train:
        w = tokens(t)
        pairs.update(zip([None, *w[:-1]], w, strict=True))
        context.update([None, *w[:-1]])
    # the mixture with its learned weights, read back from a fit on the same counts
    fit = [(d, t) for d, t in train if fold(d) != 3]
    fc = Counter(w for _, t in fit for w in tokens(t))
    fp, fx = Counter(), Counter()
    for _, t in fit:
        w = tokens(t)
        fp.update(zip([None, *w[:-1]], w, strict=True))
        fx.update([None, *w[:-1]])
    bucket = lambda k: min(int(math.log2(k)) + 1, M.MAX_CONTEXT_BUCKET) if k else 0
    quarter = lambda p: 1 if not p else round(math.log2(p) * M.CELL_STEPS)
    cells = Counter()
    for d, t in train:
        if fold(d) == 3:
            w = tokens(t)
            for h, x in zip([None, *w[:-1]], w, strict=True):
                cells[bucket(fx[h]), quarter(fp[h, x] / fx[h] if fx[h] else 0), quarter(fc[x] / sum(fc.values()))] += 1
    weights = M.learned_weights([(*k, m) for k, m in sorted(cells.items())], len(fc))
    want = {}
    for d, t in data:
        w = tokens(t)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        score = 0.0
        for h, x in zip([None, *w[:-1]], w, strict=True):
            l2, l1, l0 = weights[bucket(context[h])]
            score += math.log10(l2 * (pairs[h, x] / context[h] if context[h] else 0) + l1 * c[x] / n + l0 / (v + 1))
        want[d] = (fold(d) == 2, len(w), sum(c[x] > 0 for x in w), n, base, score)
    for r in got:
        held, size, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, size, known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score == pytest.approx(score, abs=1e-6)
    held = [r for r in got if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_weights_are_a_distribution():
    w = M.learned_weights([(3, -4, -20, 50), (3, 1, -30, 10), (0, 1, -8, 5)], 100)
    assert abs(w.sum(axis=1) - 1).max() < 1e-9 and (w[:, 1:] > 0).all() and w[0, 0] == 0


def test_long_texts_are_cut_and_joined(monkeypatch):
    import pyarrow as pa
    from types import SimpleNamespace

    monkeypatch.setattr(M, "CHUNK_TOKENS", 7)
    monkeypatch.setattr(M, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    text = " ".join(f"t{i % 5}" for i in range(33))
    batch = pa.RecordBatch.from_arrays([pa.array([9]), pa.array([text]), pa.array([0], pa.int32())], names=["doc_id", "text", "role"])
    chunks = [M.Chunk(r) for b in M._chunked([batch]) for r in b.to_pylist()]
    assert len(chunks) > 3 and sum(int(c.sizes.sum()) for c in chunks) == 34
    seen = Counter()
    for c in chunks:
        v = c.vocabulary
        seen.update(zip(v[c.context].tolist(), v[c.word].tolist(), strict=True))
    from forgeline.llm.common import WordHashes

    h = WordHashes()
    ids = [M._END] + [h[w] for w in text.encode().split()] + [M._END]
    assert seen == Counter(zip(ids[:-1], ids[1:], strict=True))


def test_empty_and_untrained(frame):
    assert M.score_documents(frame([])).count() == 0
    held = next(d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2)
    r = M.score_documents(frame([(held, "a b")])).collect()
    assert len(r) == 1 and (r[0].train_tokens, r[0].n_known, r[0].base_score, r[0].score) == (0, 0, 0.0, 0.0)
