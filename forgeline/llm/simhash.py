"""Operator 13: SimHash near-duplicates by a self-join of binary tries.

A fingerprint has a bit set where more than half of a text's four-word
shingles (A-Z lower-cased, repeats included) have it in their XXH64.
Fingerprints link at ``BUDGET`` or fewer differing bits.

Join: node pairs of a binary trie over the fingerprints are followed together.
The bits in which the two paths differ are counted, and a pair of nodes goes as
soon as they exceed the budget; a pair of leaves that is left is a link.  Paths
without a branch are one step.

Spread over tasks: of five blocks of bits, four differences leave one equal, so
there is a trie per block, with its bits first and no budget for them: only
nodes with one value of the leading block, a cell, can meet.  Cells are dealt to
tasks in bins of about ``BIN`` fingerprints; a larger cell is cut into parts of
``PART``, and a task joins the tries of two parts.

Groups of copies: equal fingerprints are one node.  Fingerprints near their
cell's centre are linked with it first, in one join, and cells within one
component are done.  Inside a task, node pairs whose leaves are all of one
component already are skipped, so a task returns a spanning forest, never the
pairs of a group.

Edge cases: texts that are null or have no words have fingerprint zero, linked
like any other; a text of fewer than four words is one shingle; a row without
``doc_id`` has a fingerprint and component null; rows with one ``doc_id`` are one
node; texts of any length are hashed whole; an empty table gives an empty
result; other input columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.llm.common import stored
from forgeline.llm.components import components, merged

SHINGLE_WORDS = 4
SEED = 42
BUDGET = 4
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # (first bit from the top, bits): one more than the budget
CELLS = sum(1 << width for _, width in BLOCKS)  # 36,864: bounds every table of cells
BIN, PART = 1 << 16, 1 << 17
AT_ONCE = 1 << 18  # node pairs that a task follows at a time
HASHED = 1 << 16  # shingles counted at a time


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(SHINGLE_WORDS, len(words))
    starts = np.concatenate([[0], ends[: len(words) - k] + 1])
    of, n = xxhash.xxh64_intdigest, len(starts)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, HASHED):
        spans = zip(starts[i : i + HASHED].tolist(), ends[k - 1 + i : k - 1 + i + HASHED].tolist(), strict=True)
        h = np.fromiter((of(joined[a:b], SEED) for a, b in spans), np.uint64, min(HASHED, n - i))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])


class Tries:
    """Binary tries over sorted distinct 64-bit keys, one after the other, with their branches alone as nodes."""

    def __init__(self, tables: list[np.ndarray]):
        self.keys = keys = np.concatenate(tables)
        self.roots, lo, hi = [], [], []
        first = 0
        for t in tables:
            self.roots.append(len(lo))
            lo.append(first)
            first += len(t)
            hi.append(first)
        lo, hi = np.array(lo, np.int64), np.array(hi, np.int64)
        all_lo, all_hi, child = [lo], [hi], []
        known = len(lo)
        while len(lo):  # the nodes of the next branches of all that have one
            inner = np.flatnonzero(hi - lo > 1)
            left = np.full(len(lo), -1, np.int64)
            left[inner] = known + 2 * np.arange(len(inner))
            child.append(left)
            a, b = lo[inner], hi[inner]
            bit = np.uint64(63) - _first_bit(keys[a] ^ keys[b - 1]).astype(np.uint64)
            wall = (keys[b - 1] >> bit) << bit  # the smallest key of the upper half
            middle = a.copy()
            low, high = a.copy(), b.copy()
            while (low < high).any():
                middle = (low + high) // 2
                above = (low < high) & (keys[np.minimum(middle, len(keys) - 1)] >= wall)
                high, low = np.where(above, middle, high), np.where(above | (low >= high), low, middle + 1)
            lo, hi = np.column_stack([a, low]).ravel(), np.column_stack([low, b]).ravel()
            all_lo.append(lo)
            all_hi.append(hi)
            known += len(lo)
        self.lo, self.hi = np.concatenate(all_lo), np.concatenate(all_hi)
        self.left = np.concatenate(child) if child else np.empty(0, np.int64)  # the right child follows
        self.depth = _first_bit(keys[self.lo] ^ keys[self.hi - 1])  # bits that all keys of the node share
        self.key = keys[self.lo]


def _first_bit(x: np.ndarray) -> np.ndarray:
    """Position from the top of the highest bit set, 64 for zero."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x |= x >> np.uint64(s)
    return 64 - np.bitwise_count(x).astype(np.int64)


def _top(bits: np.ndarray) -> np.ndarray:
    """Masks of the first ``bits`` bits."""
    bits = np.asarray(bits, np.uint64)
    return np.where(bits == 0, np.uint64(0), ~np.uint64(0) << (np.uint64(64) - np.maximum(bits, np.uint64(1))))


def trie_links(tables: list[np.ndarray], labels: list[np.ndarray], width: int, budget: int = BUDGET) -> np.ndarray:
    """Links (positions in the concatenated tables) that join components, of one table with itself or of two with each other.

    Tables are sorted distinct keys, labels name each key's component, and
    linked keys share their first ``width`` bits.
    """
    trie = Tries(tables)
    _, label = np.unique(np.concatenate(labels), return_inverse=True)
    label = label.astype(np.int64)
    forest: list[tuple[int, int]] = []
    lead = _top(np.array([width]))[0]

    def whole() -> np.ndarray:  # the component of a node's leaves, -1 for several
        run = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        return np.where(run[trie.lo] == run[trie.hi - 1], label[trie.lo], -1)

    of = whole()
    start = (trie.roots[0], trie.roots[-1])
    stack = [(np.array([start[0]]), np.array([start[1]]))]
    while stack:
        u, v = stack.pop()
        if len(u) > AT_ONCE:
            stack.append((u[AT_ONCE:], v[AT_ONCE:]))
            u, v = u[:AT_ONCE], v[:AT_ONCE]
        open_ = (of[u] != of[v]) | (of[u] < 0)
        u, v = u[open_], v[open_]
        self_ = u == v
        shared = _top(np.minimum(trie.depth[u], trie.depth[v]))
        apart = (trie.key[u] ^ trie.key[v]) & shared
        near = self_ | ((np.bitwise_count(apart) <= budget) & (apart & lead == 0))
        u, v, self_ = u[near], v[near], self_[near]
        own = u[self_ & (trie.left[u] >= 0)]
        left = trie.left[own]
        more = [(left, left), (left + 1, left + 1), (left, left + 1)]
        u, v = u[~self_], v[~self_]
        leaf = (trie.left[u] < 0) & (trie.left[v] < 0)
        hits = np.column_stack([trie.lo[u[leaf]], trie.lo[v[leaf]]])
        u, v = u[~leaf], v[~leaf]
        swap = trie.depth[u] > trie.depth[v]  # the node that branches first is replaced by its children
        u, v = np.where(swap, v, u), np.where(swap, u, v)
        more += [(trie.left[u], v), (trie.left[u] + 1, v)]
        u, v = (np.concatenate(x) for x in zip(*more, strict=True))
        if len(u):
            stack.append((u, v))
        if len(hits):
            now = merged(label, hits, forest)
            if now is not None:
                label = now
                of = whole()
    return np.array(forest, np.int64).reshape(-1, 2)


def rotated(prints: np.ndarray, first: int) -> np.ndarray:
    """The bits from position ``first`` on come first."""
    if not first:
        return prints
    return (prints << np.uint64(first)) | (prints >> np.uint64(64 - first))


def _joined(rows: pa.Table) -> pa.Table:
    """Spanning links of one bin: of all its cells, or of two parts of a large one."""
    block, side, rep, comp = (rows[c].to_numpy() for c in ("block", "side", "rep", "comp"))
    prints = rows["print"].to_numpy().view(np.uint64)
    two = rows["i"][0].as_py() != rows["j"][0].as_py()
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for which in np.unique(block):
        first, width = BLOCKS[which]
        tables, labels, places = [], [], []
        for s in (0, 1) if two else (0,):
            at = np.flatnonzero((block == which) & (side == s))
            if len(at):
                keys = rotated(prints[at], first)
                order = np.argsort(keys)
                tables.append(keys[order])
                labels.append(comp[at][order])
                places.append(at[order])
        if len(tables) == 1 + two and sum(map(len, tables)) > 1:
            links = np.concatenate(places)[trie_links(tables, labels, width)]
            a.append(rep[links[:, 0]])
            b.append(rep[links[:, 1]])
    return pa.table({"a": pa.array(np.concatenate(a), pa.int64()), "b": pa.array(np.concatenate(b), pa.int64())})


def _block_values() -> Column:
    """(block, value) of a fingerprint in every block."""
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("print", 64 - first - width).bitwiseAND((1 << width) - 1).cast("int").alias("value"))
                     for i, (first, width) in enumerate(BLOCKS)])


def _in_cells(nodes: DataFrame) -> DataFrame:
    return nodes.select("*", F.explode(_block_values()).alias("cell")).select(*nodes.columns, "cell.block", "cell.value")


def _star_links(nodes: DataFrame) -> DataFrame:
    """Links of every fingerprint within reach of its cell's centre (a, b)."""
    cells = _in_cells(nodes)
    centres = cells.groupBy("block", "value").agg(F.min_by(F.struct("print", "rep"), F.xxhash64("print")).alias("c"), F.count(F.lit(1)).alias("size")).where("size > 1")
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("c.print"))) <= BUDGET
    meet = cells.join(F.broadcast(centres), ["block", "value"])  # at most CELLS rows
    return meet.where(near & (F.col("rep") != F.col("c.rep"))).select(F.col("rep").alias("a"), F.col("c.rep").alias("b"))


def _trie_links(nodes: DataFrame) -> DataFrame:
    """Spanning links (a, b) of what the cells' tries join; ``nodes`` are print, rep, comp."""
    cells = _in_cells(nodes)
    sizes = cells.groupBy("block", "value").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1")
    parts = F.ceil(F.col("size") / PART).cast("int")
    before = Window.orderBy("block", "value").rowsBetween(Window.unboundedPreceding, -1)  # over at most CELLS rows
    dealt = sizes.select("block", "value", parts.alias("parts"),
                         F.coalesce(F.sum(F.when(parts == 1, F.col("size")).otherwise(0)).over(before), F.lit(0)).alias("before"))
    a_bin = F.when(F.col("parts") == 1, F.floor(F.col("before") / BIN)).otherwise(-1 - F.col("block") * (1 << 13) - F.col("value")).cast("long")
    rows = cells.join(F.broadcast(dealt.select("block", "value", "parts", a_bin.alias("bin"))), ["block", "value"])
    own = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
    rows = rows.select("bin", "block", "print", "rep", "comp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    rows = rows.select("bin", i.alias("i"), j.alias("j"), (F.col("own") != i).cast("int").alias("side"), "block", "print", "rep", "comp")
    return rows.groupBy("bin", "i", "j").applyInArrow(_joined, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    rows = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").alias("text"))
    own = stored(rows.mapInArrow(_fingerprinted, "doc_id long, print long"), "prints")
    nodes = stored(own.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("rep")), "nodes")

    # rows that share a doc_id but not a fingerprint are one node
    several = own.where("doc_id is not null").groupBy("doc_id").agg(F.min("print").alias("p0"), F.max("print").alias("p1")).where("p0 < p1").select(F.col("doc_id").alias("a"))
    rep_of = nodes.select(F.col("print").alias("of"), F.col("rep").alias("b"))
    links = stored(own.join(several, F.col("doc_id") == F.col("a")).join(rep_of, F.col("print") == F.col("of")).select("a", "b").unionByName(_star_links(nodes)), "star-links")

    def labelled(found: DataFrame) -> DataFrame:
        named = nodes.join(components(found), F.col("rep") == F.col("node"), "left")
        return stored(named.select("print", "rep", F.coalesce("component", "rep").alias("comp")), "labels")

    rest = stored(_trie_links(labelled(links)), "trie-links")
    label = labelled(links.unionByName(rest)).select(F.col("print").alias("of"), "comp")
    out = own.join(label.hint("merge"), F.col("print") == F.col("of"), "left")
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("comp")).alias("component_id"))


def brute_force(docs: list[tuple[int, str | None]]) -> dict[int, tuple[str, int]]:
    """doc_id -> (fingerprint, component) over all pairs of a small fixture with distinct ids."""
    prints = {}
    for doc, text in docs:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        shingles = [b" ".join(words[i : i + SHINGLE_WORDS]) for i in range(max(1, len(words) - SHINGLE_WORDS + 1))] if words else []
        h = [xxhash.xxh64_intdigest(s, SEED) for s in shingles]
        prints[doc] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    parent = {d: d for d in prints}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= BUDGET:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (f"{prints[d]:016x}", root(d)) for d in ids}
