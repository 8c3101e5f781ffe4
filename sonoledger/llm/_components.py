"""Connected components of an edge list.

Up to ``FEW_EDGES`` distinct edges (a bounded number, counted first) are joined by
union-find in one task. More edges take alternating large and small stars: each step
aggregates minima (combined before the shuffle) and joins them back, so a node with very
many edges is never gathered. Steps are written to the shared folder. Both ways give the
same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoledger.session import materialise

FEW_EDGES = 1_000_000


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b of longs) but the roots.

    The root of a component is its smallest node. Loops (a = b) are left out.
    """

    edges = materialise(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "component-edges",
    )
    mark = _mark(edges)
    if mark[0] <= few:
        return materialise(edges.coalesce(1).mapInPandas(_joined, "node long, root long"), "component-roots")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "component-large")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lowest.select("a", F.col("m").alias("b")))
            .distinct()
        )
        edges = materialise(small, "component-edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = node = parent.setdefault(up, up)
        return node

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    found = [(node, root(node)) for node in list(parent)]
    yield pd.DataFrame([f for f in found if f[0] != f[1]], columns=["node", "root"], dtype="int64")


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of a set of edges."""

    spread = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(spread % 1_000_003), F.bit_xor(spread)).first())
