import random

import numpy as np
import pytest

from forgeline.llm import simhash as S


def components_of(n, links):
    to = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(to[a], to[b])
            if to[a] != low or to[b] != low:
                to[a] = to[b] = low
                changed = True
    return to


def texts(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ärger", "naïve", "日本"]
    out = []
    for _ in range(40):
        words = rng.choices(vocabulary, k=rng.randint(30, 300))
        out.append(" ".join(words))
        for _ in range(rng.randint(0, 6)):  # near copies of each other
            edited = list(words)
            for _ in range(rng.randint(0, 3)):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            out.append("\n".join(edited) if rng.random() < 0.3 else " ".join(edited).upper() if rng.random() < 0.2 else " ".join(edited))
    return out + ["", None, " \t\n\v\f\r ", "a", "A", "a b", "a b c d", "a\x1cb c d", "one two three four five"] + ["copy of a copy of a copy"] * 30


def docs_of(values):
    return [(1000 - 3 * i, t) for i, t in enumerate(values)]


def result(spark, frame, data):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(frame(data)).collect()}


def test_brute_force(spark, frame, monkeypatch):
    data = docs_of(texts())
    want = S.brute_force(data)
    assert len({c for _, c in want.values()}) < len({p for p, _ in want.values()})  # links between different fingerprints
    assert result(spark, frame, data) == want
    monkeypatch.setattr(S, "BIN", 5)  # many bins, cells in several parts
    monkeypatch.setattr(S, "PART", 2)
    assert result(spark, frame, data) == want


def test_tries_alone(spark, frame, monkeypatch):
    """Without the centres' links every link comes from the tries."""
    data = docs_of(texts(8))
    monkeypatch.setattr(S, "_star_links", lambda nodes: nodes.select(nodes.rep.alias("a"), nodes.rep.alias("b")).limit(0))
    assert result(spark, frame, data) == S.brute_force(data)


def test_very_long_text(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(20_000))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "HASHED", 777)
    assert S.fingerprint(text) == whole
    assert S.brute_force([(1, text)])[1][0] == f"{whole:016x}"


def test_null_and_repeated_ids(spark, frame):
    got = S.near_duplicates(frame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "quite another text with other words"), (3, "quite another text with other words"), (3, "quite another text with other words")])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (3, 3), (3, 3), (7, 3), (7, 3)]


def test_empty(spark, frame):
    assert S.near_duplicates(frame([])).collect() == []


def prints(n, seed, spread=6):
    """Clusters of fingerprints around common centres, and random ones."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 5, dtype=np.uint64)
    out = [int(x) for x in rng.integers(0, 2**63, n // 2, dtype=np.uint64)]
    while len(out) < n:
        x = int(centres[rng.integers(5)])
        for _ in range(rng.integers(0, spread)):
            x ^= 1 << int(rng.integers(64))
        out.append(x)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize(("n", "seed", "width", "at_once"), [(300, 1, 0, 1 << 18), (300, 2, 0, 7), (500, 3, 13, 64), (2, 4, 0, 10), (1, 5, 0, 10)])
def test_trie_links(n, seed, width, at_once, monkeypatch):
    monkeypatch.setattr(S, "AT_ONCE", at_once)
    keys = prints(n, seed)
    near = [(i, j) for i in range(len(keys)) for j in range(i + 1, len(keys))
            if (int(keys[i]) ^ int(keys[j])).bit_count() <= S.BUDGET and (not width or int(keys[i]) >> 64 - width == int(keys[j]) >> 64 - width)]
    got = S.trie_links([keys], [np.arange(len(keys))], width)
    assert set(map(tuple, np.sort(got, axis=1).tolist())) <= set(near)
    assert components_of(len(keys), got.tolist()) == components_of(len(keys), near)
    assert len(got) < max(1, len(keys))  # a forest, not all pairs
    # two halves against each other, on top of each half alone
    half = np.random.default_rng(seed).random(len(keys)) < 0.5
    if half.any() and not half.all():
        where = [np.flatnonzero(half), np.flatnonzero(~half)]
        links = [(where[s][a], where[s][b]) for s in (0, 1) for a, b in S.trie_links([keys[where[s]]], [where[s]], width)]
        both = np.concatenate(where)
        links += [(both[a], both[b]) for a, b in S.trie_links([keys[w] for w in where], where, width)]
        assert components_of(len(keys), links) == components_of(len(keys), near)


def test_a_dense_group_is_no_square():
    """20,000 fingerprints within reach of each other: node pairs of one component are skipped."""
    rng = np.random.default_rng(0)
    keys = np.unique(np.uint64(0x0123456789ABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 20_000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 20_000).astype(np.uint64)))
    got = S.trie_links([keys], [np.arange(len(keys))], 0)
    assert len(got) == len(keys) - 1


@pytest.mark.parametrize("first", [0, 13, 52])
def test_rotation_keeps_distances(first):
    keys = prints(50, 9)
    turned = S.rotated(keys, first)
    assert [(int(a) ^ int(b)).bit_count() for a, b in zip(keys, keys[1:])] == [(int(a) ^ int(b)).bit_count() for a, b in zip(turned, turned[1:])]
    assert all(int(t) >> 51 == (int(k) >> 51 - first if first < 52 else (int(k) & 0xFFF) << 1 | int(k) >> 63) & 0x1FFF for t, k in zip(turned, keys))
