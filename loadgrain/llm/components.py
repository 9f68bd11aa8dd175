"""Connected components of a table of links, by rounds of large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadgrain.llm.common import written


def components(links: DataFrame, name: str) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of ``links`` (columns ``a``, ``b``).

    Each round hangs the neighbours of a node on the smallest of them, first the larger ones, then the
    smaller ones, until nothing changes. A round's links are written to the shared folder. A node with very
    many links is only ever grouped for its minimum, which combines before the shuffle, and joined, where
    adaptive execution splits it. Null nodes and links of a node to itself are left out.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(now.filter("a <> b").distinct(), name)
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        seen = mark
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), "a").alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = written(small.union(low).distinct(), name)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest reachable of the nodes 0 .. n-1 for each, with links from a to b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        left = root[a] != root[b]
        a, b = a[left], b[left]
    return root


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links from a to b, of the nodes 0 .. n-1, connect all that they all connect, without a circle."""
    root, todo, kept = np.arange(n), np.arange(len(a)), [np.zeros(0, np.int64)]
    while True:
        todo = todo[root[a[todo]] != root[b[todo]]]
        if not len(todo):
            return np.sort(np.concatenate(kept))
        # the first link that leaves each component; no circle can be made of such links
        first = np.full(n, len(a))
        np.minimum.at(first, root[a[todo]], todo)
        np.minimum.at(first, root[b[todo]], todo)
        own = np.unique(first[first < len(a)])
        kept.append(own)
        root = roots(n, root[a[own]], root[b[own]])[root]
