"""Operator 5: language-model scores by deleted interpolation.

P(w | h) = l2(b) c(h, w) / c(h) + l1(b) c(w) / N + l0(b) / (V + 1), where b is
the frequency bucket of the context, floor(log2 c(h)) + 1 (0 if unseen).  The
weights of each bucket are learned by expectation-maximisation on counts that
one part of the training documents (the tuning fold) finds in the counts of
the rest; afterwards all training documents are counted.

Tokens are words in lower case (A-Z only) and one end per document; a
document's first context is the end before it.

Data flow: tasks pack documents into chunks of about ``CHUNK_TOKENS`` tokens
over a chunk's own vocabulary.  A chunk asks once for each distinct token and
pair that it holds, with its own counts, so a frequent pair costs one row per
chunk, never one per occurrence.  Buckets of n-gram hashes add up the counts
and answer.  Chunk and answers meet twice: for the tuning documents, to
count (bucket, probabilities) cells in quarter octaves, a table bounded by its
cells; and for all documents, to score.  N-grams are told apart by 64-bit
hashes.

Edge cases: a null or empty text is the end alone; null ids belong to no fold
but training and are scored; without training documents N and V are 0 and
scores are 0; texts longer than a chunk are cut and their parts' sums added
up; repeated rows are scored each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import WordHashes, mixed, stored, text_bytes

CHUNK_TOKENS = 1_000_000
BUCKET_BYTES = 12 << 20  # text bytes per bucket of n-gram hashes
MAX_CONTEXT_BUCKET = 24
CELL_STEPS = 4
EM_STEPS = 60
FOLDS, HELD_OUT, TUNING = 7, 2, 3
_END = 0x5DEECE66D1234567  # hash of the end token; words are hashed by xxh3

TRAIN, TUNE, HELD = 0, 1, 2

_CHUNKS = "chunk long, keys binary, ids binary, roles binary, sizes binary, vocabulary binary, tokens binary"
_ASKED = "chunk long, bucket int, n int, grams binary, fit binary, tune binary"
_ANSWER = "chunk long, bucket int, n int, fit binary, train binary"


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, role) rows -> chunks over their own vocabulary.

    ``sizes`` has each part's tokens; a part that continues a cut text starts
    with its last token as context, marked by a negative size.
    """
    task = TaskContext.get().partitionId()
    hashes = WordHashes()
    count = row = held = 0
    parts: list[tuple[int, int | None, int, int, np.ndarray]] = []

    def flush():
        nonlocal count, held
        flat = np.concatenate([p[4] for p in parts])
        vocabulary, tokens = np.unique(flat, return_inverse=True)
        keys, ids = np.array([p[0] for p in parts], np.int64), [p[1] for p in parts]
        known = np.array([0 if i is None else i for i in ids], np.int64)
        roles = np.array([p[2] + (8 if i is None else 0) for p, i in zip(parts, ids, strict=True)], np.int8)
        sizes = np.array([p[3] for p in parts], np.int64)
        batch = pa.RecordBatch.from_pylist([{
            "chunk": (task << 32) + count, "keys": _pack(keys), "ids": _pack(known), "roles": _pack(roles), "sizes": _pack(sizes),
            "vocabulary": vocabulary.tobytes(), "tokens": _pack(tokens.astype(np.int32))}],
            schema=pa.schema([("chunk", pa.int64()), *[(c, pa.binary()) for c in ("keys", "ids", "roles", "sizes", "vocabulary", "tokens")]]))
        parts.clear()
        count, held = count + 1, 0
        return batch

    for batch in batches:
        for doc_id, text, role in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            key, row = (task << 40) + row, row + 1
            words = (text.as_py() or "").encode().lower().split()
            end = np.array([_END], np.uint64)
            for a in range(0, len(words) + 1, CHUNK_TOKENS):
                h = hashes.of(words[a : a + CHUNK_TOKENS])
                if a + CHUNK_TOKENS > len(words):
                    h = np.concatenate([h, end])
                lead = hashes.of(words[a - 1 : a]) if a else end
                parts.append((key, doc_id, role, -len(h) if a else len(h), np.concatenate([lead, h])))
                held += len(h)
                if held >= CHUNK_TOKENS:
                    yield flush()
    if parts:
        yield flush()


class Chunk:
    """A chunk's tokens and distinct pairs, in the order in which counts are asked for and answered."""

    def __init__(self, row: dict):
        self.keys, self.roles, sizes = _unpack(row["keys"], np.int64), _unpack(row["roles"], np.int8), _unpack(row["sizes"], np.int64)
        self.ids = _unpack(row["ids"], np.int64)
        self.sizes = np.abs(sizes)
        self.vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
        tokens = _unpack(row["tokens"], np.int32)
        # every part is its leading context and then its tokens
        first = np.concatenate([[0], np.cumsum(self.sizes + 1)[:-1]])
        real = np.ones(len(tokens), bool)
        real[first] = False
        at = np.flatnonzero(real)
        self.word, self.context = tokens[at], tokens[at - 1]
        self.part = np.repeat(np.arange(len(self.sizes)), self.sizes)
        codes = self.context.astype(np.int64) * len(self.vocabulary) + self.word
        self.pairs, self.pair = np.unique(codes, return_inverse=True)

    def grams(self) -> dict[int, np.ndarray]:
        a, b = np.divmod(self.pairs, len(self.vocabulary))
        with np.errstate(over="ignore"):
            return {1: self.vocabulary, 2: mixed(self.vocabulary[a] * np.uint64(0x9E3779B97F4A7C15) + mixed(self.vocabulary[b]))}

    def counts(self, n: int, role: int) -> np.ndarray:
        mask = (self.roles & 7)[self.part] == role
        of, size = (self.word, len(self.vocabulary)) if n == 1 else (self.pair, len(self.pairs))
        return np.bincount(of[mask], minlength=size).astype(np.uint32)


def _bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _asking(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk, out = Chunk(row), []
                for n, grams in chunk.grams().items():
                    fit, tune, where = chunk.counts(n, TRAIN), chunk.counts(n, TUNE), _bucket_of(grams, buckets)
                    order = np.argsort(where, kind="stable")
                    ends = np.searchsorted(where[order], np.arange(buckets + 1))
                    for b in range(buckets):
                        if ends[b] < ends[b + 1]:
                            i = order[ends[b] : ends[b + 1]]
                            out.append({"chunk": row["chunk"], "bucket": b, "n": n, "grams": grams[i].tobytes(), "fit": _pack(fit[i]), "tune": _pack(tune[i])})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()),
                                                                        *[(c, pa.binary()) for c in ("grams", "fit", "tune")]]))

    return ask


def _answered(table: pa.Table) -> pa.Table:
    """Counts of one bucket over all chunks; the row of chunk -1 has (types, tokens) of fit and of training tokens."""
    out = []
    rows = table.to_pylist()
    for n in (1, 2):
        own = [r for r in rows if r["n"] == n]
        if not own:
            continue
        grams = [np.frombuffer(r["grams"], np.uint64) for r in own]
        found, at = np.unique(np.concatenate(grams), return_inverse=True)
        fit, tune = (np.bincount(at, np.concatenate([_unpack(r[c], np.uint32) for r in own]), len(found)).astype(np.int64) for c in ("fit", "tune"))
        train, bounds = fit + tune, np.cumsum([0, *map(len, grams)])
        for i, r in enumerate(own):
            j = at[bounds[i] : bounds[i + 1]]
            out.append({"chunk": r["chunk"], "bucket": r["bucket"], "n": n, "fit": _pack(fit[j]), "train": _pack(train[j])})
        if n == 1:
            totals = lambda c: np.array([(c > 0).sum(), c.sum()], np.int64).tobytes()
            out.append({"chunk": -1, "bucket": own[0]["bucket"], "n": 0, "fit": totals(fit), "train": totals(train)})
    return pa.Table.from_pylist(out, schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("n", pa.int32()), ("fit", pa.binary()), ("train", pa.binary())]))


def _replies(chunk: Chunk, answers: pa.Table, which: str, buckets: int) -> dict[int, np.ndarray]:
    rows = {(r["n"], r["bucket"]): r[which] for r in answers.to_pylist()}
    out = {}
    for n, grams in chunk.grams().items():
        where = _bucket_of(grams, buckets)
        order = np.argsort(where, kind="stable")
        values = [_unpack(rows[n, b], np.int64) for b in range(buckets) if (n, b) in rows]
        back = np.empty(len(grams), np.int64)
        back[order] = np.concatenate(values)
        out[n] = back
    return out


def _parts(c_word, c_context, c_pair, types: int, tokens: int):
    """(context bucket, pair, word and uniform probability) of every token."""
    bucket = np.where(c_context > 0, np.minimum(np.floor(np.log2(np.maximum(c_context, 1))) + 1, MAX_CONTEXT_BUCKET), 0).astype(np.int64)
    return bucket, c_pair / np.maximum(c_context, 1), c_word / max(tokens, 1), 1.0 / (types + 1)


def _quarter_octaves(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.rint(np.log2(np.where(p > 0, p, 1)) * CELL_STEPS), 1).astype(np.int64)  # 1: probability 0


def learned_weights(cells: list[tuple[int, int, int, int]], types: int) -> np.ndarray:
    """EM over (bucket, pair cell, word cell, count): weights (pair, word, uniform) per context bucket."""
    weights = np.tile([0.4, 0.4, 0.2], (MAX_CONTEXT_BUCKET + 1, 1))
    weights[0] = [0.0, 0.8, 0.2]
    if cells:
        bucket, q2, q1, count = (np.array(c) for c in zip(*cells, strict=True))
        p = np.stack([np.where(q == 1, 0.0, 2.0 ** (q / CELL_STEPS)) for q in (q2, q1)] + [np.full(len(count), 1.0 / (types + 1))], axis=1)
        for _ in range(EM_STEPS):
            share = weights[bucket] * p
            share *= (count / share.sum(1))[:, None]
            new = np.zeros_like(weights)
            np.add.at(new, bucket, share)
            total = new.sum(1, keepdims=True)
            weights = np.where(total > 0, new / np.maximum(total, 1e-300), weights)
    # a share stays with the word and uniform parts, so that no token has probability 0
    return weights * (1 - 1e-4) + np.array([0.0, 0.5e-4, 0.5e-4])


def _cells(buckets: int, types: int, tokens: int):
    def count(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        for row in chunks.to_pylist():
            chunk = Chunk(row)
            c = _replies(chunk, answers, "fit", buckets)
            tune = np.flatnonzero((chunk.roles & 7)[chunk.part] == TUNE)
            if len(tune):
                b, p2, p1, _ = _parts(c[1][chunk.word[tune]], c[1][chunk.context[tune]], c[2][chunk.pair[tune]], types, tokens)
                found, times = np.unique(np.stack([b, _quarter_octaves(p2), _quarter_octaves(p1)], axis=1), axis=0, return_counts=True)
                out += [(*map(int, f), int(t)) for f, t in zip(found, times, strict=True)]
        columns = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table({k: pa.array(v, pa.int64()) for k, v in zip(("b", "q2", "q1", "n"), columns, strict=True)})

    return count


_SCORES = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scored(buckets: int, types: int, tokens: int, weights: np.ndarray):
    def score(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in chunks.to_pylist():
            chunk = Chunk(row)
            c = _replies(chunk, answers, "train", buckets)
            word = c[1][chunk.word]
            b, p2, p1, p0 = _parts(word, c[1][chunk.context], c[2][chunk.pair], types, tokens)
            w = weights[b]
            p = w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] * p0
            p = np.where(tokens > 0, p, 1.0)
            size = len(chunk.sizes)
            add = lambda v, part=chunk.part, size=size: np.bincount(part, v, size)
            out.append(pa.table({
                "key": pa.array(chunk.keys), "doc_id": pa.array(chunk.ids, mask=(chunk.roles & 8) > 0), "held_out": pa.array((chunk.roles & 7) == HELD),
                "n_tokens": pa.array(chunk.sizes), "n_known": pa.array(add(word > 0).astype(np.int64)),
                "base_score": pa.array(add(np.log10((word + 1) / (tokens + types + 1)))), "score": pa.array(add(np.log10(p)))}))
        empty = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                           ("base_score", pa.float64()), ("score", pa.float64())])
        return pa.concat_tables(out) if out else empty.empty_table()

    return score


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    role = F.when(fold == HELD_OUT, HELD).when(fold == TUNING, TUNE).otherwise(TRAIN)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", role.cast("int").alias("role"))
    n, size = text_bytes(rows)
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    if n == 0:
        return docs.sparkSession.createDataFrame([], out)
    buckets = max(1, -(-size // BUCKET_BYTES))
    chunks = stored(rows.mapInArrow(_chunked, _CHUNKS), "lm-chunks")
    asked = chunks.mapInArrow(_asking(buckets), _ASKED)
    answers = stored(asked.groupBy("bucket").applyInArrow(_answered, _ANSWER), "lm-answers")
    sums = [np.frombuffer(r[c], np.int64) for c in ("fit", "train") for r in answers.where("chunk = -1").select(c).collect()]
    half = len(sums) // 2  # one row per bucket
    (fit_types, fit_tokens), (types, tokens) = (np.sum(s, axis=0).tolist() for s in (sums[:half], sums[half:]))
    answers = answers.where("chunk >= 0")
    tuned = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    cells = tuned.applyInArrow(_cells(buckets, fit_types, fit_tokens), "b long, q2 long, q1 long, n long")
    # bounded by the cells: context buckets x quarter octaves of two probabilities
    cells = [tuple(r) for r in stored(cells.groupBy("b", "q2", "q1").agg(F.sum("n").alias("n")), "lm-cells").collect()]
    weights = learned_weights(cells, fit_types)
    scores = tuned.applyInArrow(_scored(buckets, types, tokens, weights), _SCORES)
    whole = scores.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
                                      *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"), "base_score", "score")
