"""Operator 3: substring dedup over super-k-mers.

A window is ``WINDOW`` consecutive words of one document; a word is removed if
a window that covers it has a word sequence that also starts earlier (smaller
``doc_id``, or the same document, earlier start).

Each window's minimiser is the smallest hash among its runs of ``MINIMISER``
words.  Consecutive windows with one minimiser are a super-k-mer: it travels
as one packed string (its words) to the bucket of the minimiser, so equal
windows always meet there.  A bucket flattens its strings, sorts the windows
and compares the words of neighbours, which finds the repeated ones exactly.

Skew: a super-k-mer that a task has already sent is not sent again, since all
its windows are repeats; so copies cost one string per task.  Runs of words
that are minimisers of many different windows (a common line in ever new
surroundings) are found first by counting over the whole input, and ordered
after all others, so such windows spread over the runs around the common one.

Edge cases: a null or empty text has no words; texts shorter than a window
lose none.  Rows with one ``doc_id`` and different texts are ordered by a hash
of the text; rows that repeat id and text are one document, and each gets its
result.  Null ids come after all others.  An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import WordHashes, mixed, shingle_hashes, stored, text_bytes

WINDOW = 20
MINIMISER = 4
CHUNK_WORDS = 1_000_000
BUCKET_BYTES = 4 << 20  # text bytes per bucket of super-k-mers
HOT_SHARE = 1 / 1000  # of a chunk's super-k-mers: a minimiser with more is a candidate
HOT_TOTAL = 1 / 4000  # of all super-k-mers: such minimisers come last; at most 4000 of them
_LATE = np.uint64(1 << 63)
_NULL_ID = np.int64(2**63 - 1)

_PACKED = "bucket int, docs binary, ties binary, starts binary, windows binary, strings binary"
_SPANS = "doc_id long, tie long, first long, stop long"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (w - size)], x[w - size :]) if w > size else x


def super_kmers(hashes: np.ndarray, owner: np.ndarray, late: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first position, windows, minimiser) of every super-k-mer of a flat sequence of word hashes.

    ``owner`` tells which document a word belongs to; ``late`` has the sorted
    minimisers that are taken only where no other is left.
    """
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    runs = shingle_hashes(hashes, MINIMISER) >> np.uint64(1)
    if len(late):
        at = np.minimum(np.searchsorted(late, runs), len(late) - 1)
        runs = np.where(late[at] == runs, runs | _LATE, runs)
    least = _sliding_min(runs, WINDOW - MINIMISER + 1)
    starts = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])
    if not len(starts):
        return starts, starts, np.empty(0, np.uint64)
    least = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (least[1:] != least[:-1])
    at = np.flatnonzero(new)
    return starts[at], np.diff(np.append(at, len(starts))), least[at]


class _Chunks:
    """Gathers (doc_id, tie, text) rows; gives lists of (doc, tie, offset, words) parts of about CHUNK_WORDS words.

    A longer text is cut into parts that overlap by a window less one word.
    """

    def __init__(self, batches: Iterator[pa.RecordBatch]):
        self.batches = batches

    def __iter__(self):
        parts, held = [], 0
        for batch in self.batches:
            for doc, tie, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = (text.as_py() or "").encode().split()
                doc = int(_NULL_ID) if doc is None else doc
                for a in range(0, max(len(words) - WINDOW + 1, 0), CHUNK_WORDS):
                    part = words[a : a + CHUNK_WORDS + WINDOW - 1]
                    parts.append((doc, tie, a, part))
                    held += len(part)
                    if held >= CHUNK_WORDS:
                        yield parts
                        parts, held = [], 0
        if parts:
            yield parts


def _flat(parts: list, hashes: WordHashes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    words = [w for p in parts for w in p[3]]
    return words, hashes.of(words), np.repeat(np.arange(len(parts)), [len(p[3]) for p in parts])


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Minimisers with a large share of a chunk's super-k-mers, and (as minimiser -1) the number of all."""
    hashes = WordHashes()
    for parts in _Chunks(batches):
        _, h, owner = _flat(parts, hashes)
        _, _, least = super_kmers(h, owner, np.empty(0, np.uint64))
        found, counts = np.unique(least, return_counts=True)
        often = counts >= max(4, HOT_SHARE * len(least))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(found[often].astype(np.int64), -1)), pa.array(np.append(counts[often], len(least)))],
                                         names=["minimiser", "n"])


def _packer(buckets: int, late: np.ndarray):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for parts in _Chunks(batches):
            parts.sort(key=lambda p: p[:3])  # so that the first of equal strings starts earliest
            parts = [p for i, p in enumerate(parts) if not i or p[:3] != parts[i - 1][:3]]
            words, h, owner = _flat(parts, hashes)
            first, windows, least = super_kmers(h, owner, late)
            where = (mixed(least) % np.uint64(buckets)).astype(np.int64)
            base = np.cumsum([0, *[len(p[3]) for p in parts]])
            own = owner[first]
            docs = np.array([p[0] for p in parts], np.int64)[own] if len(parts) else np.empty(0, np.int64)
            ties = np.array([p[1] for p in parts], np.int64)[own] if len(parts) else np.empty(0, np.int64)
            starts = first - base[own] + np.array([p[2] for p in parts], np.int64)[own] if len(parts) else first
            sent: set[bytes] = set()
            strings, count = [], windows.copy()
            for i, (a, n) in enumerate(zip(first.tolist(), windows.tolist(), strict=True)):
                s = b" ".join(words[a : a + n + WINDOW - 1])
                if s in sent:
                    strings.append(b"")
                    count[i] = -n  # all its windows repeat
                else:
                    sent.add(s)
                    strings.append(s)
            order = np.argsort(where, kind="stable")
            ends = np.searchsorted(where[order], np.arange(buckets + 1))
            out = []
            for b in np.unique(where).tolist():
                i = order[ends[b] : ends[b + 1]]
                text = b"\n".join([strings[j] for j in i.tolist()])
                out.append({"bucket": b, "docs": _pack(docs[i]), "ties": _pack(ties[i]), "starts": _pack(starts[i]), "windows": _pack(count[i]),
                            "strings": zstandard.ZstdCompressor(level=3).compress(text)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("docs", "ties", "starts", "windows", "strings")]]))

    return pack


def _window_hashes(ids: np.ndarray) -> np.ndarray:
    """64-bit hash of every WINDOW ids, built by doubling (20 = 16 + 4)."""
    def joined(a, b):
        return mixed(a * np.uint64(0x9E3779B97F4A7C15) + b)

    by = {1: mixed(ids.astype(np.uint64) + np.uint64(1))}
    size = 1
    while size * 2 <= WINDOW:
        by[size * 2] = joined(by[size][:-size], by[size][size:])
        size *= 2
    whole, done = by[size], size
    while done < WINDOW:
        step = max(s for s in by if s <= WINDOW - done)
        n = len(ids) - done - step + 1
        whole, done = joined(whole[:n], by[step][done : done + n]), done + step
    return whole


def _repeats(ids: np.ndarray, at: np.ndarray, doc: np.ndarray, tie: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which windows (at: their place in ``ids``, in document order) equal an earlier one."""
    keys = _window_hashes(ids)[at]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    a, b = at[order[:-1][same]], at[order[1:][same]]
    equal = np.ones(len(a), bool)
    for j in range(WINDOW):
        equal &= ids[a + j] == ids[b + j]
    repeat = np.zeros(len(at), bool)
    if not equal.all():  # two sequences under one hash: tell them apart by their words
        seen: dict[bytes, int] = {}
        mark = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        for w in np.sort(order[mark]).tolist():
            first = seen.setdefault(ids[at[w] : at[w] + WINDOW].tobytes(), w)
            repeat[w] = (doc[w], tie[w], start[w]) != (doc[first], tie[first], start[first])
        return repeat
    leads = np.concatenate([[True], ~same])
    first = order[np.flatnonzero(leads)[np.cumsum(leads) - 1]] if len(order) else order
    repeat[order] = ~leads & ((doc[order] != doc[first]) | (tie[order] != tie[first]) | (start[order] != start[first]))
    return repeat


def _counted(table: pa.Table) -> pa.Table:
    """The word spans of one bucket that repeated windows cover."""
    docs, ties, starts, windows = (np.concatenate([_unpack(b, np.int64) for b in table[c].to_pylist()]) for c in ("docs", "ties", "starts", "windows"))
    strings = [s for b in table["strings"].to_pylist() for s in zstandard.ZstdDecompressor().decompress(b).split(b"\n")]
    told = windows < 0  # repeats that their task has found
    out = [(docs[told], ties[told], starts[told], starts[told] - windows[told] + WINDOW - 1)]
    order = np.lexsort((starts, ties, docs))
    order = order[~told[order]]
    if len(order):
        docs, ties, starts, windows = docs[order], ties[order], starts[order], windows[order]
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for i in order.tolist() for w in strings[i].split(b" ")), np.int64,
                          int((windows + WINDOW - 1).sum()))
        del strings, numbers
        base = np.cumsum(windows + WINDOW - 1) - (windows + WINDOW - 1)
        which = np.repeat(np.arange(len(windows)), windows)
        within = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
        start = starts[which] + within
        hit = np.flatnonzero(_repeats(ids, base[which] + within, docs[which], ties[which], start))
        if len(hit):
            new = np.ones(len(hit), bool)
            new[1:] = (np.diff(hit) != 1) | (which[hit][1:] != which[hit][:-1])
            a = np.flatnonzero(new)
            b = np.append(a[1:], len(hit)) - 1
            out.append((docs[which[hit[a]]], ties[which[hit[a]]], start[hit[a]], start[hit[b]] + WINDOW))
    return pa.table({c: np.concatenate([o[i] for o in out]) for i, c in enumerate(("doc_id", "tie", "first", "stop"))})


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, first, stop): spans of word positions to remove; they may overlap.  ``tie`` is xxhash64 of the text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
    _, size = text_bytes(rows)
    buckets = max(1, -(-size // BUCKET_BYTES))
    frequent = stored(rows.mapInArrow(_frequent, "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n")), "minimisers")
    total = frequent.where("minimiser = -1").select("n").first()
    late = np.empty(0, np.uint64)
    if total:
        most = frequent.where((F.col("minimiser") >= 0) & (F.col("n") >= max(16, HOT_TOTAL * total["n"])))
        late = np.array(sorted(r["minimiser"] for r in most.collect()), dtype=np.uint64)
    packed = rows.mapInArrow(_packer(buckets, late), _PACKED)
    return packed.groupBy("bucket").applyInArrow(_counted, _SPANS)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            words = (text.as_py() or "").encode().split()
            keep = np.ones(len(words), bool)
            for s in spans or ():
                keep[s["first"] : s["stop"]] = False
            kept = [words[i] for i in np.flatnonzero(keep).tolist()] if spans else words
            out.append((doc, b" ".join(kept).decode(), len(words), len(words) - len(kept)))
        d, t, n, r = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(t, pa.string()), pa.array(n, pa.int64()), pa.array(r, pa.int64())],
                                         names=["doc_id", "text", "n_words", "n_removed"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text (kept words joined by a space), n_words, n_removed of every row."""
    spans = stored(repeated_spans(docs), "spans")
    by_doc = spans.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))
    by_doc = by_doc.select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie"), "spans")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_NULL_ID)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", own.alias("__own"), F.xxhash64("text").alias("__hash"))
    joined = rows.join(by_doc, (F.col("__own") == F.col("__id")) & (F.col("__hash") == F.col("__tie")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_kept, "doc_id long, text string, n_words long, n_removed long")


def brute_force(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    """doc_id -> (words, removed words, kept text) on a small fixture with distinct ids."""
    seen: set[tuple[bytes, ...]] = set()
    out = {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - WINDOW + 1):
            w = tuple(words[i : i + WINDOW])
            if w in seen:
                gone.update(range(i, i + WINDOW))
            seen.add(w)
        out[doc] = (len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode())
    return out


def word_digest(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)
