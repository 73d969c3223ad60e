"""Operator 4: packing token sequences by cutting-stock column generation.

Every document is tokenised once, its ids and a closing id are cut at
multiples of the sequence length, and the pieces are counted by length class
(``ceil(length / WIDTH)``).  The linear program over patterns (how many pieces
of each class share a sequence) is solved by column generation: the basis
prices classes, an unbounded knapsack by dynamic programming finds the best
pattern, until none pays.  Patterns are rounded down, the remaining few pieces
are filled greedily in count space, and ranked pieces of each class take the
pattern slots in order.  The program is solved by one task over the class
histogram (at most SEQUENCE / WIDTH rows); pieces stay distributed.

Edge cases: a null or empty text is the closing id alone; repeated rows are
packed separately; null ids are kept; an empty table gives an empty result;
other input columns are ignored.  Texts of any length are tokenised whole.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline.llm.common import ranked, stored

SEQUENCE = 2048
WIDTH = 8
END_ID = 1
GAP = 2e-4  # column generation ends this close to the lower bound of sequences, or half a sequence
UNIT_CACHE = 400_000
SPECIAL = "<|endoftext|>"
_LONG_RUN = re.compile(r"\s{10000}")  # the fast encoder's pattern matching needs a stack as deep as a run of white space is long
_TOUCHING = re.compile(r" (?:\s|(?<=\s ))")  # a space beside white space; \s has every character that the tokenizer's has

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Units(dict):
    """unit -> packed little-endian ids.  A unit is a maximal run without spaces and the space before it."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= UNIT_CACHE:
            self.clear()
        ids = self[unit] = np.array(self.encode(unit), dtype="<u4").tobytes()
        return ids


def _encoders(vocabulary: str, reference: str):
    """(fast byte-pair encoder of ordinary text, the reference tokenizer): the same vocabulary in two files."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return fast.encode_ordinary, Tokenizer.from_file(public_tokenizers.path(reference))


def packed_ids(text: str, units: Units, tokenizer) -> bytes:
    """The ids of a text as packed little-endian 32-bit integers.

    A space between characters that are no white space always starts a new
    pre-token, so a text whose spaces stand alone is the concatenation of its
    units.  Beside other white space (line ends, tabs, U+00A0) a space can lie
    inside a token of a run: such a text is encoded whole.  Texts with the
    special token, or with a run of white space that is too long for the fast
    encoder, take the tokenizer itself.
    """
    if not text:
        return b""
    if SPECIAL in text or _LONG_RUN.search(text):
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    if text[0] == " " or text[-1] == " " or _TOUCHING.search(text):
        return np.array(units.encode(text), dtype="<u4").tobytes()
    first, *rest = text.split(" ")
    return units[first] + b"".join([units[" " + u] for u in rest])


def tokenised_pieces(docs: DataFrame, sequence: int, vocabulary: str, reference: str) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tokenizer = _encoders(vocabulary, reference)
        units, end = Units(encode), np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = packed_ids(text.as_py() or "", units, tokenizer) + end
                total = len(ids) // 4
                for start in range(0, total, sequence):
                    piece = ids[4 * start : 4 * (start + sequence)]
                    out.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), total))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the dearest multiset of sizes within the capacity."""
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), "right").tolist()
    best = 0.0
    for room in range(int(sizes[0]), capacity + 1):
        gains = value[room - sizes[: fitting[room]]] + prices[: fitting[room]]
        i = int(gains.argmax())
        if gains[i] > best + 1e-12:
            best, last[room] = float(gains[i]), i
        value[room] = best
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
            continue
        pattern[last[room]] += 1
        room -= int(sizes[last[room]])
    return float(value[capacity]), pattern


def solve_patterns(demand: dict[int, int], capacity: int, rounds: int = 5000) -> list[tuple[np.ndarray, int, np.ndarray]]:
    """Patterns with multiplicities that cover ``demand`` (size class -> pieces) exactly.

    Returns (sizes, multiplicity, pieces of each size per sequence) rows.
    """
    sizes = np.array(sorted(demand), dtype=np.int64)
    need = np.array([demand[int(s)] for s in sizes], dtype=float)
    # many classes have equal small counts: a slight shift of each breaks the ties that would make the basis cycle
    shifted = need * (1 + 1e-2 * np.random.default_rng(0).random(len(need)))
    copies = (capacity // sizes).astype(float)
    basis, inverse, bound = np.diag(copies), np.diag(1 / copies), 0.0
    for i in range(rounds):
        if i % 50 == 49:
            inverse = np.linalg.inv(basis)  # the rank-one updates gather rounding errors
        prices = inverse.sum(axis=0)
        worth, pattern = best_pattern(prices, sizes, capacity)
        value = float((prices * shifted).sum())
        bound = max(bound, value / worth)  # no solution needs fewer sequences
        if value - bound <= max(0.5, GAP * value):
            break
        direction, level = inverse @ pattern, inverse @ shifted
        ratios = np.where(direction > 1e-6, np.maximum(level, 0) / np.where(direction > 1e-6, direction, 1), np.inf)
        out = int(np.argmax(np.where(ratios <= ratios.min() + 1e-6, direction, 0)))
        basis[:, out] = pattern
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
    level = np.linalg.solve(basis, need)
    left = need.astype(np.int64)
    plan = []
    for j in range(len(sizes)):
        pattern = np.rint(basis[:, j]).astype(np.int64)
        used = pattern > 0
        times = min(int(np.floor(level[j] + 1e-7)), int((left[used] // pattern[used]).min()))
        if times > 0:
            plan.append((sizes, times, pattern))
            left -= times * pattern
    while left.any():  # what rounding left over: fewer sequences than patterns
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for i in range(len(sizes) - 1, -1, -1):
            pattern[i] = min(left[i], room // sizes[i])
            room -= int(pattern[i] * sizes[i])
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        plan.append((sizes, times, pattern))
        left -= times * pattern
    return plan


def slot_ranges(plan: list[tuple[np.ndarray, int, np.ndarray]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end rank, pieces per sequence, first sequence): which ranks of a class a pattern takes."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for sizes, times, pattern in plan:
        for size, each in zip(sizes.tolist(), pattern.tolist(), strict=True):
            if each:
                first = taken.get(size, 0)
                taken[size] = first + each * times
                out.append((size, first, taken[size], each, sequence))
        sequence += times
    return out


def pack_documents(docs: DataFrame, sequence: int = SEQUENCE, width: int = WIDTH, vocabulary: str = "byte_bpe_50k.tiktoken",
                   reference: str = "byte_bpe_50k.json") -> DataFrame:
    """One row per piece: where it is cut from its document and where it lies in its sequence."""
    pieces = stored(tokenised_pieces(docs, sequence, vocabulary, reference), "pieces")
    pieces = pieces.withColumn("__class", F.ceil(F.col("length") / width).cast("int"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        demand = {c: n for b in batches for c, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
        ranges = slot_ranges(solve_patterns(demand, sequence // width)) if demand else []
        if ranges:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(zip(*ranges, strict=True))],
                                             names=["__c", "__from", "__to", "__each", "__seq"])

    # one small task: the histogram has at most sequence / width rows, the result a few rows per pattern
    slots = pieces.groupBy("__class").count().coalesce(1).mapInArrow(solve, "__c int, __from long, __to long, __each long, __seq long")
    slots = stored(slots, "slots")
    rows = ranked(pieces, "__class", ["doc_id", "start", "ids_crc32"], F.xxhash64("doc_id", "start", "ids_crc32"), "__rank", 256)
    rows = rows.join(F.broadcast(slots), (F.col("__class") == F.col("__c")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
    rows = rows.withColumn("sequence_id", F.col("__seq") + F.floor((F.col("__rank") - F.col("__from")) / F.col("__each")))
    w = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "doc_id", "start", "ids_crc32", "__rank")
    rows = rows.withColumn("offset", F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return rows.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("sequence_id").cast("long").alias("sequence_id"),
                       F.col("offset").cast("long").alias("offset"))
