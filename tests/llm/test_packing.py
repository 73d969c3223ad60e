import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from forgeline.llm import packing as P

TEXTS = ["", None, "Hello world", "a  b", " lead", "trail ", "x\n y\n\n z", "it's 3.14 — l'été où", "tab\t\tend\n", "  ", "\n", "a " * 3000,
         "word" * 4000, "日本語 テキスト", "<|endoftext|> inside", "café line 　 wide", "\x1c a\x1fb c", "don't   stop  now\r\n ok"]


def test_ids_are_the_tokenizers_ids():
    encode, tokenizer = P._encoders("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")
    units = P.Units(encode)
    for t in TEXTS:
        want = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(P.packed_ids(t or "", units, tokenizer), "<u4").tolist() == want, t


def test_spaces_beside_other_white_space():
    encode, tokenizer = P._encoders("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")
    units = P.Units(encode)
    spaces = ["\u00a0", "\n", "\t", "\r\n", "\u2003", "\u3000", "\x85", "\x0b", "\x1c", "\u200b"]
    texts = [f"price{lead}{(a + b) * n}{tail}end of it" for s in spaces for a, b in ((" ", s), (s, " ")) for n in (1, 2, 3, 4, 8)
             for lead in ("", " ") for tail in ("", " ")]
    texts += ["price" + " \u00a0" * 3 + " end", "\u00a0 a", "a \u00a0", "a\n b \n c\t d"]
    for t in texts:
        want = tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(P.packed_ids(t, units, tokenizer), "<u4").tolist() == want, t


def test_every_id_lies_in_one_piece(frame):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a  b"), (None, "null id")] + [(100 + i, "some words here " * (i % 50)) for i in range(200)]
    got = P.pack_documents(frame(rows)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(d, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes()), len(ids)) for s in range(0, len(ids), 2048)]
    assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got), key=str) == sorted(want, key=str)
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(by) <= total / 2048 * 1.1 + 2


def test_patterns_cover_demand_near_the_bound():
    rng = np.random.default_rng(0)
    for n in (1, 7, 300, 20000):
        sizes = np.minimum(64, rng.integers(1, 80, n))
        demand = {int(s): int(c) for s, c in zip(*np.unique(sizes, return_counts=True), strict=True)}
        plan = P.solve_patterns(demand, 64)
        used = {s: 0 for s in demand}
        for s, times, pattern in plan:
            assert int((s * pattern).sum()) <= 64
            for a, b in zip(s.tolist(), pattern.tolist(), strict=True):
                used[a] += b * times
        assert used == demand
        assert sum(t for _, t, _ in plan) <= sizes.sum() / 64 * 1.02 + len(demand) / 2 + 2
        ranges = P.slot_ranges(plan)
        assert sum(e - a for _, a, e, _, _ in ranges) == n


def test_empty(frame):
    assert P.pack_documents(frame([])).count() == 0


@pytest.mark.parametrize("kind", [" ", "\n", "\t", "\u00a0", " \n", "\r\n", "\u3000", "\x0b "])
def test_long_white_space(kind):
    """Two million characters of every kind of white space, alone and between words: no crash, the tokenizer's ids."""
    encode, tokenizer = P._encoders("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")
    run = kind * (2_000_000 // len(kind))
    for text in (run, "before" + run + "after it"):
        assert P.packed_ids(text, P.Units(encode), tokenizer) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@pytest.mark.parametrize("length", [9_999, 10_000, 10_001])
def test_white_space_about_the_limit(length):
    encode, tokenizer = P._encoders("byte_bpe_50k.tiktoken", "byte_bpe_50k.json")
    for kind in (" ", "\n"):
        text = "a" + kind * length + "b c"
        assert P.packed_ids(text, P.Units(encode), tokenizer) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
