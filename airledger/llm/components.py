"""Connected components of an edge table by alternating large and small stars.

Each round is two grouped minima and two joins over the edges, combined map-side; the edges are stored
below the shared folder between rounds, so a lost executor costs one round at most. Rounds grow with
the logarithm of the longest chain. Nothing but a row count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored

EDGES_PER_FILE = 500_000
LEAST_FILES = 8


def _linked(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return int(row[0]), int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node that has an edge.

    ``edges`` has two long columns ``a`` and ``b``; loops, repeats and both directions may occur.
    """
    edges = stored(_linked(edges.select("a", "b")), "edges")
    seen = _state(edges)
    while seen[0]:
        files = max(LEAST_FILES, seen[0] // EDGES_PER_FILE)  # a round never adds many edges
        edges = stored(_linked(_small_star(_large_star(edges))).coalesce(files), "edges")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    # At the fixed point every edge leads from a node to its root.
    down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    roots = down.select(F.col("root").alias("node"), "root").distinct()
    return down.unionByName(roots)
