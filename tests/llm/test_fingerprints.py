import hashlib
import random

from forgeline.llm import fingerprints as FP
from forgeline.llm.common import WordHashes

WORDS = [f"w{i}" for i in range(3000)]


def text(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def true_jaccard(a, b):
    def s(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    return len(s(a) & s(b)) / max(1, len(s(a) | s(b)))


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0), reverse=True)
    out = []
    for i, (d, t) in enumerate(order):
        new = FP.edited_text(t or "", order[(i + 1) % len(order)][1] or "")
        out.append((d, len(t or ""), hashlib.sha256(new.encode()).hexdigest()))
    return sorted(out, key=str)


def test_successors_and_digests(frame, monkeypatch):
    monkeypatch.setattr(FP, "BUCKET_BYTES", 400)  # several buckets
    rows = [(i * 7, text(i, i % 40)) for i in range(60)] + [(None, "no id"), (1000, None), (1001, ""), (1002, "é" * 5000)]
    got = FP.fingerprint_documents(frame(rows)).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == expected(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_sketch_estimates_and_merges():
    h = WordHashes()
    a, b = text(1, 8000), text(1, 8000)
    assert FP.encoded(FP.sketch(a, h)) == FP.encoded(FP.sketch(b, h))
    for n in (30, 300, 8000):
        a = text(n, n)
        b = FP.edited_text(a, text(n + 1, n))
        assert abs(FP.likeness(FP.sketch(a, h), FP.sketch(b, h))[0] - true_jaccard(a, b)) < 0.12
    big, part = text(3, 20000), " ".join(text(3, 20000).split()[:3000])
    assert FP.likeness(FP.sketch(part, h), FP.sketch(big, h))[1] > 0.95
    s, t = FP.sketch(text(4, 5000), h), FP.sketch(text(5, 5000), h)
    whole = FP.merged(s, t)
    assert FP.likeness(s, whole)[1] == 1.0 and FP.likeness(t, whole)[1] == 1.0
    # every shingle hash below the fixed fraction is retained
    from forgeline.llm.common import shingle_hashes

    u = {int(x) for x in shingle_hashes(h.of(a.encode().split()), 5) if x < 1 << (64 - FP.BASE_LEVEL)}
    assert u <= {int(x) for x in FP.sketch(a, h)[1]}
    assert FP.decoded(FP.encoded(s))[0] == s[0] and (FP.decoded(FP.encoded(s))[1] == s[1]).all()


def test_repeats_single_and_empty(frame):
    same = [(5, "a b c d e f"), (5, "a b c d e f"), (6, "a b c d e f")]
    got = FP.fingerprint_documents(frame(same)).collect()
    assert len(got) == 3 and {r.near_next for r in got} == {1.0} and len({r.fingerprint for r in got}) == 1
    one = FP.fingerprint_documents(frame([(1, "x y z")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert FP.fingerprint_documents(frame([])).collect() == []
