"""Operator 6: n-gram Jaccard join over parity sketches.

A document's set is its distinct shingles of five lower-cased words (A-Z; a
shorter text is one shingle).  Two sets link when 100 |A and B| >= 80 |A or B|,
which bounds their symmetric difference by (|A| + |B|) / 9.

Sketches: shingle hashes are dealt to G groups by hash and each group keeps
the XOR of its hashes.  XOR is linear, so a difference of d shingles can
change at most d groups, and G = 2 d + 2: by the pigeonhole principle linked
sets agree in most groups.  The first ``GROUPS`` groups that hold a shingle are
emitted.  As shingles are dealt at random, linked sets share two fifths of
those on average, so fewer than ``SURE`` shared ones lie five standard
deviations away and none is out of reach.  G is fixed per size band (a factor
of two; documents just above a band's lower edge also emit in the band below,
so linked sizes always meet).  Below ``PLAIN_BELOW`` shingles each shingle is
its own group and linked sets share four fifths of them.

Frequent groups (a passage that many documents share): linked sets share at
least ``SURE`` groups, so a document with fewer frequent groups than that drops
them, and every link still shows in another group.  Documents with more of
them, copies of each other, are not paired with one another but with one
centre per group; a second, parity sketch of one bit per hash slot (its
Hamming distance never exceeds the symmetric difference) and the sizes sift
the pairs, and the survivors are verified on their shingles.  What of the groups
then spans several components is compared exhaustively, block by block, on sizes and sketches: a task
returns a spanning forest of the likely pairs, fewer than its rows, and never
the pairs of a group.  The forest is verified; where that refutes pairs, the
groups are compared again without them, with four times as many pairs a
document each time, until nothing likely is left between components.  No link that a
shared group shows is lost.

Equal texts (after folding) form a class under the smallest ``doc_id`` and are
compared once.

Edge cases: null or empty texts have no set and link with nothing; a row
without ``doc_id`` has component null; rows with one ``doc_id`` are one node;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgeline.llm.common import WordHashes, mixed, plainly_named, shingle_hashes, stored
from forgeline.llm.components import components, merged

SHINGLE_WORDS = 5
PLAIN_BELOW = 64
GROUPS = 96
SURE = 12  # groups that linked sets share at least
FREQUENT = 16  # documents of a group that is worth dropping
BLOCK = 4096  # documents of a group that are compared in one cell
SEEN = 200_000  # classes a task remembers, so that it emits a copied text once

_DESCRIBED = "doc_id long, class binary, n long, sketch binary, band int, own_keys array<long>, own_spare int, low_keys array<long>, low_spare int"
_DESCRIBED_NAMES = [c.split()[0] for c in _DESCRIBED.split(", ")]
SMALL = 256  # rows of a cell whose pairs are listed; larger cells are compared as products of sketches
THIN = 128  # bytes of the folded sketches of those products
ROWS = 64  # rows of a large cell that are compared with the others at a time
BUCKET = 1 << 14  # rows of a task's group of cells, about


def difference(a, b):
    """Largest symmetric difference of linked sets of these sizes."""
    return (a + b) // 9


def own_difference(n: int) -> int:
    """Largest symmetric difference of a set of ``n`` shingles and any set linked with it."""
    return difference(n, n * 5 // 4)


def folded_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    return np.unique(shingle_hashes(hashes.of(words), SHINGLE_WORDS))


def parity_bits(shingles: np.ndarray) -> bytes:
    """Parity of the shingles dealt to each of m bits, m four times the power of two above the set's size (64 at least).

    So many that few shingles meet in a bit: sets whose similarity lies below
    0.79 hardly ever look linked.
    """
    m = max(64, 4 << int(len(shingles)).bit_length())
    counts = np.bincount((mixed(shingles) & np.uint64(m - 1)).astype(np.int64), minlength=m)
    return np.packbits(counts & 1 != 0, bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Distance at the shorter sketch's length: the longer is folded by XOR of its halves."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def groups(shingles: np.ndarray, band: int) -> np.ndarray:
    """Keys of the group sketches that a set emits in a band, as 64-bit values."""
    spread = mixed(shingles ^ np.uint64(0xA5A5A5A55A5A5A5A))
    if 1 << band < PLAIN_BELOW:
        return mixed(spread ^ np.uint64(band + 1))
    g = 2 * own_difference(5 << (band - 1)) + 2  # sizes in the band stay below 2.5 * 2^band
    of = ((spread >> np.uint64(32)) * np.uint64(g) >> np.uint64(32)).astype(np.int64)
    near = np.flatnonzero(of < GROUPS)
    near = near[np.argsort(of[near], kind="stable")]
    if not len(near):
        return np.empty(0, np.uint64)
    first = np.flatnonzero(np.diff(of[near], prepend=-1))
    keys = mixed(np.bitwise_xor.reduceat(spread[near], first) + mixed(of[near][first].astype(np.uint64) + np.uint64(1)))
    return mixed(keys ^ np.uint64(band + 1))


def spare(n: int, band: int) -> int:
    """How many shared groups a linked pair can lose and still share one."""
    return (-(-4 * n // 5) if 1 << band < PLAIN_BELOW else SURE) - 1


def bands(n: int) -> list[int]:
    """The size band of a set, and the band below where a linked set can lie there."""
    own = n.bit_length() - 1
    return [own, own - 1] if own and 4 * n < 5 << own else [own]


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class, sketch and, once a task and class, the group keys of every text, from one pass over its words."""
    hashes, seen = WordHashes(), set()
    for batch in batches:
        doc, name, n, sketch, band, own_keys, own_spare, low_keys, low_spare = ([] for _ in range(9))
        for d, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = folded_words(text.as_py())
            own = shingle_set(words, hashes)
            digest = hashlib.sha256(b" ".join(words)).digest() if words else None
            at = bands(len(own)) if words and d is not None and digest not in seen else []
            if at:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(digest)
            doc.append(d)
            name.append(digest)
            n.append(len(own))
            sketch.append(parity_bits(own) if words else None)
            band.append(at[0] if at else None)
            for i, keys, spares in ((0, own_keys, own_spare), (1, low_keys, low_spare)):
                keys.append(groups(own, at[i]).view(np.int64) if i < len(at) else np.empty(0, np.int64))
                spares.append(spare(len(own), at[i]) if i < len(at) else None)
        lists = lambda parts: pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(list(map(len, parts)))]).astype(np.int32)), pa.array(np.concatenate([np.empty(0, np.int64), *parts])))
        if doc:
            yield pa.RecordBatch.from_arrays([
                pa.array(doc, pa.int64()), pa.array(name, pa.binary()), pa.array(n, pa.int64()), pa.array(sketch, pa.binary()), pa.array(band, pa.int32()),
                lists(own_keys), pa.array(own_spare, pa.int32()), lists(low_keys), pa.array(low_spare, pa.int32())], names=_DESCRIBED_NAMES)


def _sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_a, n_b = batch.column(2).to_pylist(), batch.column(4).to_pylist()
        ok = [4 * max(a, b) <= 5 * min(a, b) and hamming(x, y) <= difference(a, b)
              for a, b, x, y in zip(n_a, n_b, batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


class Sketches:
    """Sketches of different lengths, compared at the shorter one's by folding the longer."""

    def __init__(self, sketches: list[bytes]):
        self.rows = [np.frombuffer(s, np.uint8) for s in sketches]
        self.width = np.array([len(s) for s in sketches], np.int64)
        self.tables: dict[int, np.ndarray] = {}

    def folded(self, at: np.ndarray, width: int) -> np.ndarray:
        """The sketches of rows ``at`` (no shorter than ``width``) at that width."""
        out = np.empty((len(at), width), np.uint8)
        for w in np.unique(self.width[at]):
            which = np.flatnonzero(self.width[at] == w)
            bits = np.stack([self.rows[i] for i in at[which]])
            while bits.shape[1] > width:
                bits = bits[:, : bits.shape[1] // 2] ^ bits[:, bits.shape[1] // 2 :]
            out[which] = bits
        return out

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Hamming distances of the pairs of rows (x, y)."""
        out, common = np.empty(len(x), np.int64), np.minimum(self.width[x], self.width[y])
        for w in np.unique(common).tolist():
            which = np.flatnonzero(common == w)
            if w not in self.tables:
                fit = np.flatnonzero((self.width >= w) & (self.width <= 2 * w))  # linkable sizes lie within a quarter
                place = np.full(len(self.rows), -1, np.int64)
                place[fit] = np.arange(len(fit))
                self.tables[w] = (place, self.folded(fit, w).view(np.uint64))
            place, table = self.tables[w]
            for i in range(0, len(which), 1 << 16):
                part = which[i : i + (1 << 16)]
                out[part] = np.bitwise_count(table[place[x[part]]] ^ table[place[y[part]]]).sum(axis=1)
        return out


def _listed(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of small cells (runs of rows)."""
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s in np.unique(sizes).tolist():
        if s > 1:
            i, j = np.triu_indices(s, 1)
            at = starts[sizes == s][:, None]
            left.append((at + i).ravel())
            right.append((at + j).ravel())
    return np.concatenate(left), np.concatenate(right)


def _likely_within(more: int):
    """Spanning forest of the pairs in a group of cells that sizes and sketches don't rule out, between different components.

    Refuted pairs don't count; ``more`` pairs a row come on top of the forest.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending"), ("side", "ascending")])
        key, block_i, block_j, side, names, size_of = (rows[c].to_numpy() for c in ("key", "i", "j", "side", "rep", "n"))
        reps, first, node = np.unique(names, return_index=True, return_inverse=True)  # a node is a class, in however many cells
        n, sketches = size_of[first], Sketches(rows["sketch"].take(first).to_pylist())
        _, comp = np.unique(rows["comp"].to_numpy()[first], return_inverse=True)
        label, forest, extra = comp.astype(np.int64), [], []
        refuted = [np.empty(0, np.int64)]
        for a, others in zip(range(len(reps)), rows["refuted"].take(first).to_pylist(), strict=True):
            if others:
                at = np.searchsorted(reps, others)
                known = (at < len(reps)) & (reps[np.minimum(at, len(reps) - 1)] == others)
                refuted.append(a * len(reps) + at[known])
        refuted_pairs = np.unique(np.concatenate(refuted))
        new = np.flatnonzero((np.diff(key, prepend=key[0] - 1) != 0) | (np.diff(block_i, prepend=-1) != 0) | (np.diff(block_j, prepend=-1) != 0))
        sizes = np.diff(np.append(new, len(key)))

        def add(x: np.ndarray, y: np.ndarray) -> None:
            """Pairs of nodes: sifted by component, size, refutation and sketch, then joined."""
            nonlocal label
            x, y = np.minimum(x, y), np.maximum(x, y)
            of = comp if more else label
            ok = (of[x] != of[y]) & (4 * np.maximum(n[x], n[y]) <= 5 * np.minimum(n[x], n[y]))
            pairs = np.unique(x[ok] * len(reps) + y[ok])
            pairs = pairs[~np.isin(pairs, refuted_pairs, assume_unique=True)]
            x, y = pairs // len(reps), pairs % len(reps)
            near = sketches.apart(x, y) <= difference(n[x], n[y])
            x, y = x[near], y[near]
            if len(x):
                if more:
                    nth = np.arange(len(x)) - np.searchsorted(x, x)  # x ascends
                    extra.append(np.column_stack([x, y])[nth < more])
                now = merged(label, np.column_stack([x, y]), forest)
                label = label if now is None else now

        small = sizes <= SMALL
        x, y = _listed(new[small], sizes[small])
        across = (block_i[x] == block_j[x]) | (side[x] != side[y])
        add(node[x[across]], node[y[across]])
        for start, size in zip(new[~small].tolist(), sizes[~small].tolist(), strict=True):
            cell = np.arange(start, start + size)
            whole = block_i[start] == block_j[start]
            left, right = (cell, cell) if whole else (cell[side[cell] == 0], cell[side[cell] == 1])
            width = min(THIN, int(sketches.width[node[cell]].min()))
            thin = np.unpackbits(sketches.folded(node[cell], width), axis=1).astype(np.float32)
            ones = thin.sum(axis=1)
            for i in range(0, len(left), ROWS):
                a = left[i : i + ROWS]
                of = comp if more else label
                distance = ones[a - start][:, None] + ones[right - start] - 2 * (thin[a - start] @ thin[right - start].T)  # exact: counts below 2^24
                ok = (distance <= difference(n[node[a]][:, None], n[node[right]])) & (of[node[a]][:, None] != of[node[right]])
                if whole:
                    ok &= a[:, None] < right
                p, q = np.nonzero(ok)
                add(node[a[p]], node[right[q]])
        found = reps[np.concatenate([np.array(forest, np.int64).reshape(-1, 2), *extra])]
        return pa.table({"x": pa.array(found[:, 0], pa.int64()), "y": pa.array(found[:, 1], pa.int64())})

    return run


def _likely(open_groups: DataFrame, reps: DataFrame, refuted: DataFrame | None, more: int) -> DataFrame:
    """Likely pairs (x, y) of class representatives of different components, no more than the groups have rows (times ``more`` + 1).

    A group is compared in blocks of ``BLOCK`` documents, each pair of blocks a
    cell; a task takes cells of about ``BUCKET`` rows together, as most are small.
    """
    about = reps.select(F.col("member").alias("__m"), "rep", "n", "sketch")
    rows = open_groups.join(about.hint("merge"), F.col("doc_id") == F.col("__m")).dropDuplicates(["key", "rep"])
    if refuted is None:
        rows = rows.withColumn("refuted", F.array().cast("array<long>"))
    else:
        both = refuted.select("a", "b").unionByName(refuted.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lists = both.groupBy(F.col("a").alias("__r")).agg(F.collect_set("b").alias("refuted"))
        rows = rows.join(lists, F.col("rep") == F.col("__r"), "left")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    kept = ["rep", "comp", "n", "sketch", "refuted"]
    rows = rows.select("key", *kept, own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    rows = rows.select("key", i.alias("i"), j.alias("j"), (F.col("own") != i).cast("int").alias("side"), *kept)
    buckets = max(1, open_groups.count() // BUCKET)
    return rows.groupBy(F.pmod(F.xxhash64("key", "i", "j"), F.lit(buckets)).alias("bucket")).applyInArrow(_likely_within(more), "x long, y long").distinct()


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        ok, last, last_set = [], None, None
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            if y != last:
                last, last_set = y, shingle_set(folded_words(y), hashes)
            own = shingle_set(folded_words(x), hashes)
            both = len(np.intersect1d(own, last_set, assume_unique=True))
            ok.append(100 * both >= 80 * (len(own) + len(last_set) - both))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _links(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of class representatives that link, stored; ``pairs`` are (x, y) doc_ids."""
    to = lambda side: reps.select(F.col("member").alias(f"__{side}"), F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))
    named = pairs.join(to("a"), F.col("x") == F.col("__a")).join(to("b"), F.col("y") == F.col("__b")).where("a != b")
    one = F.col("a") < F.col("b")
    swap = lambda f, g, c: F.when(one, F.col(f)).otherwise(F.col(g)).alias(c)
    named = named.select(swap("a", "b", "a"), swap("b", "a", "b"), swap("n_a", "n_b", "n_a"), swap("s_a", "s_b", "s_a"), swap("n_b", "n_a", "n_b"), swap("s_b", "s_a", "s_b"))
    named = named.dropDuplicates(["a", "b"]).select("a", "b", "n_a", "s_a", "n_b", "s_b")
    likely = stored(named.mapInArrow(_sifted, "a long, b long"), "likely")
    if likely.isEmpty():
        return likely
    wanted = likely.select(F.explode(F.array("a", "b")).alias("__w")).distinct()
    some = stored(texts.join(wanted.hint("merge"), F.col("doc_id") == F.col("__w"), "left_semi").dropDuplicates(["doc_id"]), "candidates")
    left = some.select(F.col("doc_id").alias("__a"), F.col("text").alias("text_a"))
    right = some.select(F.col("doc_id").alias("__b"), F.col("text").alias("text_b"))
    pairs = likely.join(left, F.col("a") == F.col("__a")).join(right, F.col("b") == F.col("__b"))
    return stored(pairs.select("a", "b", "text_b", "text_a").mapInArrow(_verified, "a long, b long"), "links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    own = stored(rows.mapInArrow(_described, _DESCRIBED), "classes")
    known = own.where(F.col("class").isNotNull() & F.col("doc_id").isNotNull())
    classes = known.groupBy("class").agg(F.min("doc_id").alias("rep"))
    member = stored(known.select(F.col("doc_id").alias("member"), F.col("class").alias("__class"), "n", "sketch")
                    .join(classes, F.col("__class") == F.col("class")).select("member", "rep", "n", "sketch"), "members")

    sides = F.array(F.struct(F.col("band"), F.col("own_spare").alias("spare"), F.col("own_keys").alias("keys")),
                    F.struct((F.col("band") - 1).alias("band"), F.col("low_spare").alias("spare"), F.col("low_keys").alias("keys")))
    emitted = own.where("band is not null").select("doc_id", F.explode(sides).alias("s")).select(F.explode("s.keys").alias("key"), "doc_id", "s.band", "s.spare")
    centres = emitted.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi").drop("hi")
    shared = stored(emitted.join(centres.withColumnRenamed("key", "__k").hint("merge"), F.col("key") == F.col("__k")).drop("__k"), "meeting")
    frequent = F.col("size") > FREQUENT
    own_groups = Window.partitionBy("doc_id", "band")  # at most GROUPS or PLAIN_BELOW rows
    shared = shared.withColumn("__often", F.count_if(frequent).over(own_groups)).where(~frequent | (F.col("__often") > F.col("spare")))
    shared = stored(shared.select("key", "doc_id", "lo", "size"), "shared")

    # rows that share a doc_id but not a text are one node
    split = member.groupBy("member").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").select(F.col("member").alias("__m"), "a")
    links = member.join(split, F.col("member") == F.col("__m")).select("a", F.col("rep").alias("b")).where("a != b")

    texts = rows.where(F.col("doc_id").isNotNull())
    found = _links(shared.where("doc_id != lo").select(F.col("doc_id").alias("x"), F.col("lo").alias("y")).distinct(), member, texts)
    links = links.unionByName(found)
    comps = components(links)

    refuted, more = None, 0
    while True:
        open_groups = _open(shared, member, comps)
        if open_groups.isEmpty():
            break
        likely = stored(_likely(open_groups, member, refuted, more).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), "likely-pairs")
        if likely.isEmpty():
            break
        found = _links(likely.select(F.col("a").alias("x"), F.col("b").alias("y")), member, texts)
        if not found.isEmpty():
            links = links.unionByName(found)
            comps = components(links)
        right = found.select(F.col("a").alias("__a"), F.col("b").alias("__b"))
        wrong = stored(likely.join(right, (F.col("a") == F.col("__a")) & (F.col("b") == F.col("__b")), "left_anti"), "refuted")
        if wrong.isEmpty():
            break  # every likely pair lies within a component now
        refuted = wrong if refuted is None else refuted.unionByName(wrong)
        more = max(4, 4 * more)

    label = member.join(comps, F.col("rep") == F.col("node"), "left").select(F.col("member").alias("__m"), F.coalesce("component", "rep").alias("__c"))
    label = label.groupBy("__m").agg(F.min("__c").alias("__c"))
    out = own.join(label.hint("merge"), F.col("doc_id") == F.col("__m"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("__c", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _open(shared: DataFrame, member: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows (key, doc_id, size, comp) of the groups whose members lie in several components."""
    label = member.join(comps, F.col("rep") == F.col("node"), "left").select(F.col("member").alias("__m"), F.coalesce("component", "rep").alias("comp"))
    label = label.groupBy("__m").agg(F.min("comp").alias("comp"))
    named = shared.select("key", "doc_id", "size").join(label, F.col("doc_id") == F.col("__m")).drop("__m")
    apart = named.groupBy(F.col("key").alias("__k")).agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1")
    return stored(named.join(apart, F.col("key") == F.col("__k"), "left_semi"), "open")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, all their columns, without those whose component has a smaller doc_id.

    Of repeated rows with that id the one with the smallest text hash and
    values stays; rows without an id or without words all stay.
    """
    near = stored(near_duplicates(docs), "near")
    ids = near.where("n_shingles > 0 and doc_id is not null").groupBy(F.col("doc_id").alias("__id")).agg(
        F.max((F.col("component_id") != F.col("doc_id")).cast("int")).alias("__gone"), F.count(F.lit(1)).alias("__n"))
    marked = stored(ids.where("__gone = 1 or __n > 1").select("__id", "__gone"), "marked")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    is_marked = worded & (F.col("doc_id").cast("long") == F.col("__id"))
    plain = plainly_named(docs, "doc_id", "text")
    kept = plain.join(marked, is_marked, "left_anti")
    repeated = marked.where("__gone = 0")
    if repeated.isEmpty():
        return kept.toDF(*docs.columns)
    # one row per id from partial minima, so that no task holds all rows of an id; maps can't be ordered
    values = [F.col(f.name) for f in plain.schema.fields if "map<" not in f.dataType.simpleString()]
    order = F.struct(F.xxhash64("text").alias("__hash"), *values)
    one = plain.join(repeated, is_marked, "left_semi").groupBy(F.col("doc_id").cast("long").alias("__id"))
    one = one.agg(F.min_by(F.struct(*plain.columns), order).alias("__row"))
    return kept.unionByName(one.select("__row.*")).toDF(*docs.columns)


def brute_force(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, component) over all pairs of a small fixture with distinct ids."""
    sets = {}
    for doc, text in docs:
        w = folded_words(text)
        sets[doc] = {tuple(w[i : i + SHINGLE_WORDS]) for i in range(max(1, len(w) - SHINGLE_WORDS + 1))} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}
