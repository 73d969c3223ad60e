"""Connected components of a links table by alternating large-star and small-star rounds.

Every node ends in a star around the smallest node it reaches.  Each round is
two grouped minima and two joins on stored tables; nothing is collected but a
count and a checksum.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("__m")).select(F.col("a").alias("__a"), F.least("a", "__m").alias("__m"))
    joined = both.join(least, F.col("a") == F.col("__a"))
    if small:  # every smaller neighbour and the node itself hang on the smallest neighbour
        hung = joined.select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("__m").alias("b"))
    else:  # every larger neighbour hangs on the smallest of the neighbourhood
        hung = joined.where("b > a").select(F.col("b").alias("a"), F.col("__m").alias("b"))
    return hung.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> (node, component): the smallest node reachable, for nodes with a link to another."""
    edges = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or tuple(now) == state:
            break
        state = tuple(now)
        edges = stored(_star(_star(edges, False), True), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def merged(label: np.ndarray, hits: np.ndarray, forest: list[tuple[int, int]]) -> np.ndarray | None:
    """Labels after the links ``hits``; those that joined two components are added to ``forest``."""
    a, b = label[hits[:, 0]], label[hits[:, 1]]
    a, b = np.minimum(a, b), np.maximum(a, b)
    _, first = np.unique(a * (int(label.max()) + 1) + b, return_index=True)
    first = first[a[first] != b[first]]
    if not len(first):
        return None
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for i in first.tolist():
        x, y = root(int(a[i])), root(int(b[i]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            forest.append((int(hits[i, 0]), int(hits[i, 1])))
    to = np.arange(int(label.max()) + 1)
    for x in parent:
        to[x] = root(x)
    return to[label]
