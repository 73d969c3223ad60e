"""Operator 10: line dedup by winnowing over line hashes (DataFrame functions only).

A document is its lines (split at ``\\n``), compared after trimming white space
and in lower case; blank lines separate nothing and are no lines.  Winnowing:
of every two consecutive line hashes the smaller is a fingerprint, and so is
every line of ``LONG_WORDS`` words or more.  So every run of two lines, and
every long line, that occurs twice has the same fingerprint in both places.

Positions with a fingerprint that occurs more than once are joined: the match
is extended to the line before and to the line after, and each extension (two
lines, or the long line itself) is compared with its first occurrence by
(``doc_id``, position).  A line is deleted if an extension that covers it has
occurred before; runs of any length are the union of their extensions.

Skew: fingerprints and extensions are counted with partial aggregation, and
first occurrences are stored before the join, so both sides are plain
shuffles that adaptive execution splits; no pairs of occurrences are built.
What grows with the input is never broadcast: joins are merge joins at any size.

Edge cases: a null text stays null, an empty one empty; a text without
repeated runs is returned unchanged, one that loses lines is the rest joined
by ``\\n``.  Rows that repeat id and text count as one document, each keeping
what the first keeps; rows with one id and other text are ordered by a hash of
the text; null ids come last.  All input columns are returned, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import plainly_named, stored

LONG_WORDS = 20
_SPACE = r"[\x20\x09-\x0D]+"


def _key(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, _SPACE, " ")))


def _positions(docs: DataFrame) -> DataFrame:
    """Lines that hold words: their number without blank ones (pos), place in the text (at), hash, and both neighbours'."""
    line = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("at"), _key(x).alias("key")))
    line = F.filter(line, lambda x: x["key"] != "")
    hashed = F.transform(line, lambda x: F.struct(x["at"].alias("at"), F.xxhash64(x["key"]).alias("h"),
                                                  (F.size(F.split(x["key"], " ")) >= LONG_WORDS).alias("long")))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("id"), F.xxhash64("text").alias("tie"), hashed.alias("lines"))
    each = F.transform("lines", lambda x, i: F.struct(
        i.alias("pos"), x["at"].alias("at"), x["h"].alias("h"), x["long"].alias("long"),
        F.when(i > 0, F.get("lines", i - 1)).alias("before"), F.get("lines", i + 1).alias("after")))
    lines = rows.where(F.size("lines") > 0).select("id", "tie", F.explode(each).alias("line")).select("id", "tie", "line.*")
    # the smaller of two neighbours is the window's minimum, the first of equals
    mark = F.coalesce(F.col("h") <= F.col("after.h"), F.lit(False)) | F.coalesce(F.col("h") < F.col("before.h"), F.lit(False)) | F.col("long")
    return lines.where(mark)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(id, tie, at): lines in runs that occur earlier; ``tie`` is xxhash64 of the text, a null id is the largest long."""
    marks = _positions(docs)
    often = stored(marks.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("h").alias("__h")), "prints")
    matched = marks.join(often.hint("merge"), F.col("h") == F.col("__h"))
    run = lambda first, key, *at: F.struct(first.cast("int").alias("first"), key.alias("key"), F.array(*at).alias("at"))
    grown = F.array(
        F.when(F.col("before").isNotNull(), run(F.col("pos") - 1, F.xxhash64("before.h", "h"), F.col("before.at"), F.col("at"))),
        F.when(F.col("after").isNotNull(), run(F.col("pos"), F.xxhash64("h", "after.h"), F.col("at"), F.col("after.at"))),
        F.when(F.col("long"), run(F.col("pos"), F.xxhash64(F.lit(1), "h"), F.col("at"))))
    runs = matched.select("id", "tie", F.explode(F.filter(grown, lambda x: x.isNotNull())).alias("run")).select("id", "tie", "run.*")
    runs = stored(runs, "runs")
    place = F.struct("id", "tie", "first")
    first = stored(runs.groupBy("key").agg(F.min(place).alias("__at"), F.max(place).alias("__last")).where("__at < __last")
                   .select(F.col("key").alias("__key"), "__at"), "first-runs")
    later = runs.join(first.hint("merge"), F.col("key") == F.col("__key")).where(place > F.col("__at"))
    return later.select("id", "tie", F.explode("at").alias("at"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, the text without lines of runs that occur earlier."""
    gone = repeated_lines(docs).groupBy("id", "tie").agg(F.collect_set("at").alias("__gone")).select(
        F.col("id").alias("__id"), F.col("tie").alias("__tie"), "__gone")
    gone = stored(gone, "gone")
    plain = plainly_named(docs, "doc_id", "text")
    own = plain.withColumns({"__own": F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)), "__hash": F.xxhash64("text")})
    joined = own.join(gone.hint("merge"), (F.col("__own") == F.col("__id")) & (F.col("__hash") == F.col("__tie")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(rest)
    return joined.select(*[text.alias(c) if c == "text" else F.col(c) for c in plain.columns]).toDF(*docs.columns)


def brute_force(docs: list[tuple[int, str | None]]) -> dict[int, str | None]:
    """The texts left on a small fixture with distinct ids."""
    import re

    keyed = {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        lines = [] if text is None else text.split("\n")
        keys = [re.sub(_SPACE, " ", x).strip(" ").lower() for x in lines]
        keyed[doc] = (lines, [(i, k) for i, k in enumerate(keys) if k])
    seen: set[tuple] = set()
    gone: set[tuple[int, int]] = set()
    for doc, (_, full) in keyed.items():
        for j in range(len(full)):
            for run in ([full[j]] if len(full[j][1].split(" ")) >= LONG_WORDS else []), full[j : j + 2] if j + 1 < len(full) else []:
                if run:
                    key = tuple(k for _, k in run)
                    if key in seen:
                        gone.update((doc, i) for i, _ in run)
                    seen.add(key)
    texts = dict(docs)
    return {d: texts[d] if not any((d, i) in gone for i in range(len(lines))) else "\n".join(x for i, x in enumerate(lines) if (d, i) not in gone)
            for d, (lines, _) in keyed.items()}
