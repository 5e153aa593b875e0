"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortia.llm.common import stage

ROUNDS = 60  # more than any graph of this world needs: rounds grow with log(size)^2


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b: long); root is the smallest node.

    Each round hangs the neighbours of a node on the smallest one, first the larger
    neighbours, then all the others, until every node hangs on its root.  Rounds are
    written to the shared folder.  Nodes without a link, and null ones, have no row.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stage(links.filter("a <> b").select(a, b).distinct())
    seen = _digest(edges)
    for _ in range(ROUNDS):
        edges = stage(_small_star(_large_star(edges)))
        now = _digest(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct())
        seen = now
    raise RuntimeError("components did not settle")


def _digest(edges: DataFrame) -> tuple:
    hashes = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashes)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").filter("v > u AND v <> m").select(
        F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", "m")).distinct()


class Forest:
    """Components of the links met so far, in one task."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def root(self, node: int) -> int:
        above = self.above
        while (up := above.setdefault(node, node)) != node:
            above[node] = node = above[up]
        return node

    def link(self, pairs: Iterable[tuple[int, int]]) -> None:
        for a, b in pairs:
            a, b = self.root(a), self.root(b)
            if a != b:
                self.above[max(a, b)] = min(a, b)

    def stars(self) -> dict[str, list]:
        """A link (a, b) from every node that is not a root to its root, the smallest node."""
        pairs = [(node, root) for node in list(self.above) if (root := self.root(node)) != node]
        return {"a": [a for a, _ in pairs], "b": [b for _, b in pairs]}
