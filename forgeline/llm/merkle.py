"""Operator 11: a Merkle manifest of a dataset by lag and lead windows.

Every row is a leaf, the leaves of a source ascend by ``doc_id``, and runs of
``FAN`` consecutive nodes become their common hash until one node, the
subroot, remains; subroots, ordered by source, become the root in the same way.

One level is one window over runs: fixed-offset lag and lead columns, masked
by a node's slot and its run's length, hold the siblings, and the row of the
first child hashes the parent.  A window partition is one run, so a source
with a third of all rows spreads like any other.  Positions come from ranges
of (source, doc_id): rows are numbered inside a range and the ranges' counts
give offsets, so no task holds a source.  On the way down every node joins its
parent's path (one row per run), so a leaf has the siblings of all levels
without another pass over the rows above it.

Edge cases: null columns hash as ``-``; a null ``doc_id`` comes first in its
source and is never tampered with; a null source is a source of its own, before
all others; rows that repeat a ``doc_id`` follow each other in the order of
their leaf hashes (equal rows in any order, which changes no hash above them); a
source of one row has its leaf as subroot, and a dataset of one row has no
siblings (the proof is the hash of nothing); an empty table gives an empty
result; other input columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgeline.llm.common import stored

FAN = 16
RANGE_ROWS = 1_000_000  # nodes of a range, in which one task numbers rows
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, concatenated as UTF-8."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def folded(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, the row's leaf, ``now``: the leaf of the row after tampering (the same where it isn't tampered with), and ``tie``, which spreads equal rows."""
    d = {c: F.col(f"`{c}`") for c in FIELDS}
    d["doc_id"], d["n_chars"] = d["doc_id"].cast("long"), d["n_chars"].cast("long")
    own = leaf(*d.values())
    hit = F.coalesce(F.crc32(F.encode(d["doc_id"].cast("string"), "UTF-8")) % 5 == 0, F.lit(False)) & (folded(d["text"]) != d["text"])
    other = F.when(F.coalesce(hit, F.lit(False)), leaf(*[folded(v) if c == "text" else v for c, v in d.items()]))
    return docs.select(d["doc_id"].alias("doc_id"), d["source"].alias("source"), own.alias("leaf"), other.alias("other")).select(
        "doc_id", "source", "leaf", F.coalesce("other", "leaf").alias("now"), F.monotonically_increasing_id().alias("tie"))


def placed(nodes: DataFrame, tree: str | None, order: list[str], total: int) -> DataFrame:
    """Adds ``pos`` (gapless from 0 in the tree, in ``order``) and ``n`` (the tree's nodes); ``tree`` None: all are one tree.

    A window over a tree runs over its ranges' counts, never over its rows.
    """
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / RANGE_ROWS))
    keys = [tree] if tree else []
    ranged = nodes.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in [*keys, *order]])
    ranged = stored(ranged.withColumn("range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("range", *keys).agg(F.count(F.lit(1)).alias("rows"))
    one = Window.partitionBy(*[F.col(k) for k in keys] or [F.lit(0)])
    before = F.coalesce(F.sum("rows").over(one.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col("range").alias("in_range"), *[F.col(k).alias("in_tree") for k in keys], before.alias("before"), F.sum("rows").over(one).alias("n"))
    numbered = ranged.withColumn("nth", F.row_number().over(Window.partitionBy("range", *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])))
    same = F.col("range") == F.col("in_range")
    if tree:
        same &= F.col(tree).eqNullSafe(F.col("in_tree"))
    out = numbered.join(counts, same).withColumn("pos", F.col("before") + F.col("nth") - 1)
    return out.select(*nodes.columns, "pos", "n")


def _siblings() -> tuple[Column, Column]:
    """(digests before, digests after) of a node within its run."""
    w = Window.partitionBy("tree", F.expr(f"pos div {FAN}")).orderBy("pos")
    slot = F.col("pos") % FAN
    length = F.least(F.lit(FAN), F.col("n") - F.col("pos") + slot)
    before = [F.when(slot >= k, F.lag("digest", k).over(w)).otherwise("") for k in range(FAN - 1, 0, -1)]
    after = [F.when(slot + k < length, F.lead("digest", k).over(w)).otherwise("") for k in range(1, FAN)]
    return F.concat(*before), F.concat(*after)


def levels(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """Tables (tree, pos, n, digest, ...) of a forest from its leaves up; a tree ends where its ``n`` is 1.

    ``largest`` is the node count of the largest tree.
    """
    out = [nodes]
    while largest > 1:
        _, after = _siblings()
        runs = out[-1].where("n > 1").select("tree", "pos", "n", "digest", after.alias("after"))
        parents = runs.where(F.col("pos") % FAN == 0).select(
            "tree", F.expr(f"pos div {FAN}").alias("pos"), F.ceil(F.col("n") / FAN).cast("long").alias("n"), digest(F.col("digest"), F.col("after")).alias("digest"))
        out.append(stored(parents, "level"))
        largest = -(-largest // FAN)
    return out


def tops(forest: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree's last node."""
    found = [level.where("n = 1").select("tree", "digest") for level in forest]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def with_paths(forest: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with ``path``: the siblings (before, after) at every level up to the tree's top and, from there, ``above``'s path.

    ``above`` has one row per tree: tree, path and columns that are handed down with it.
    """
    handed = [c for c in above.columns if c not in ("tree", "path")]
    up = above.select(F.col("tree").alias("up_tree"), "path", *handed)
    down = None
    for i, level in reversed(list(enumerate(forest))):
        at_top = level.where("n = 1").join(up, F.col("tree").eqNullSafe(F.col("up_tree"))).drop("up_tree")
        if down is None:
            down = at_top
        else:
            before, after = _siblings()
            inner = level.where("n > 1").withColumn("own", F.struct(before.alias("before"), after.alias("after"))).withColumn("run", F.expr(f"pos div {FAN}"))
            # the window has dealt the rows by (tree, run): the join needs no other exchange of them
            parents = down.select(F.col("tree").alias("up_tree"), F.col("pos").alias("up_run"), "path", *handed)
            joined = inner.join(parents.hint("merge"), F.col("tree").eqNullSafe(F.col("up_tree")) & (F.col("run") == F.col("up_run")))
            joined = joined.withColumn("path", F.concat(F.array("own"), "path")).drop("own", "run", "up_tree", "up_run")
            down = joined.unionByName(at_top)
        if i:
            down = stored(down, "paths")
    return down


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda node, s: digest(s["before"], node, s["after"]))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: leaf, subroot, root, proof digest, and whether the (tampered) row still leads to the root."""
    own = stored(leaves(docs), "leaves")
    total = own.count()
    own = stored(placed(own, "source", ["doc_id", "leaf", "tie"], total).withColumnsRenamed({"source": "tree", "leaf": "digest"}), "placed")
    largest = own.agg(F.max("n")).first()[0] or 0
    forest = levels(own, largest)
    subroots = stored(tops(forest), "subroots").withColumnRenamed("tree", "source")
    sources = subroots.count()
    joint = placed(subroots, None, ["source"], sources).select(F.lit(0).alias("tree"), "pos", "n", "digest", "source")
    top = levels(stored(joint, "joint"), sources)
    root = tops(top).select("tree", F.col("digest").alias("root"), F.lit(None).cast(_NO_PATH).alias("path"))
    root = root.withColumn("path", F.coalesce("path", F.array().cast(_NO_PATH)))
    above = with_paths(top, root).select(F.col("source").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    out = with_paths(forest, above)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    out = out.withColumn("folded_root", fold(F.col("now"), F.col("path")))
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def oracle_sql(depth: int = 8) -> str:
    """DuckDB SQL of ``manifest`` for trees of at most FAN^depth nodes."""
    crc_byte = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    enc = lambda c: f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
    tampered = f"translate(text, '{UPPER}', '{LOWER}')"
    leaf_of = lambda text: "sha256(" + " || ".join([*map(enc, FIELDS[:-1]), enc(text)]) + ")"
    out = [f"""with digits as (
  select doc_id as id, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda c, b: {crc_byte}) as c
  from (select distinct doc_id from documents where doc_id is not null)),
own as (
  select d.doc_id, d.source, {leaf_of('text')} as leaf,
    case when xor(c, 4294967295) % 5 = 0 then {leaf_of(tampered)} else {leaf_of('text')} end as now
  from documents d left join digits on d.doc_id = id),
l0 as (
  select source as tree, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n, leaf as digest
  from own)"""]

    def level(name: str, i: int) -> None:
        out.append(f"""{name}{i + 1} as (
  select tree, pos // {FAN} as pos, (n + {FAN - 1}) // {FAN} as n, sha256(string_agg(digest, '' order by pos)) as digest
  from {name}{i} where n > 1 group by tree, pos // {FAN}, n)""")

    def all_tops(name: str) -> str:
        return " union all ".join(f"select tree, digest from {name}{i} where n = 1" for i in range(depth + 1))

    def sided(name: str, i: int) -> None:
        w = f"over (partition by tree, pos // {FAN} order by pos rows between"
        out.append(f"""{name}s{i} as (
  select tree, pos, coalesce(string_agg(digest, '') {w} unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(digest, '') {w} 1 following and unbounded following), '') as after
  from {name}{i} where n > 1)""")

    for i in range(depth):
        level("l", i)
    out.append(f"subroots as ({all_tops('l')})")
    out.append("r0 as (select 0 as tree, row_number() over (order by tree nulls first) - 1 as pos, count(*) over () as n, digest, tree as source from subroots)")
    for i in range(depth):
        level("r", i)
    out.append(f"roots as ({all_tops('r')})")
    for i in range(depth):
        sided("l", i)
        sided("r", i)
    rows = """p0 as (
  select o.doc_id, o.leaf, o.now, o.source, o.pos as lpos, r0.pos as rpos, r0.digest as subroot, (select digest from roots) as root, '' as proof, o.now as node
  from (select doc_id, leaf, now, source, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos from own) o
  join r0 on o.source is not distinct from r0.source)"""
    out.append(rows)
    step = 0
    for name, pos, tree in (("l", "lpos", "p.source"), ("r", "rpos", "0")):
        for i in range(depth):
            out.append(f"""p{step + 1} as (
  select p.* exclude (proof, node), proof || coalesce(before || after, '') as proof, case when s.before is null then node else sha256(before || node || after) end as node
  from p{step} p left join {name}s{i} s on {tree} is not distinct from s.tree and p.{pos} // {FAN**i} = s.pos)""")
            step += 1
    return ",\n".join(out) + f"""
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, node as folded_root, node = root as verified from p{step}"""


def brute_force(rows: list[tuple]) -> dict:
    """Rows (doc_id, text, lang, source, n_chars) with distinct ids -> doc_id: (leaf, subroot, root, proof, folded root, verified), in plain Python."""
    import hashlib
    import zlib

    def h(*parts: str) -> str:
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf_of(doc, source, lang, n_chars, text):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n_chars, text)])

    def grown(nodes):  # the levels of one tree
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][i : i + FAN]) for i in range(0, len(out[-1]), FAN)])
        return out

    def path(tree, i):
        found = []
        for level in tree[:-1]:
            start = i // FAN * FAN
            found.append(("".join(level[start:i]), "".join(level[i + 1 : start + FAN])))
            i //= FAN
        return found

    by_source: dict = {}
    for doc, text, lang, source, n_chars in rows:
        by_source.setdefault(source, []).append((doc, leaf_of(doc, source, lang, n_chars, text), text, lang, n_chars))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = grown([r[1] for r in by_source[s]])
    joint = grown([trees[s][-1][0] for s in names])
    out = {}
    for j, s in enumerate(names):
        for i, (doc, own, text, lang, n_chars) in enumerate(by_source[s]):
            steps = path(trees[s], i) + path(joint, j)
            node = own
            if doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0 and text is not None:
                node = leaf_of(doc, s, lang, n_chars, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for before, after in steps:
                node = h(before, node, after)
            root = joint[-1][0]
            out[doc] = (own, trees[s][-1][0], root, h(*[b + a for b, a in steps]), node, node == root)
    return out
