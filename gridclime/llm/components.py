"""Connected components of links between numbers, in rounds over stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclime.llm.common import stage, unstage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for links (a, b) of longs: root is the smallest node that a node reaches.

    Rounds of large star and small star: each node's larger, then smaller,
    neighbours are linked to its smallest neighbour, until nothing changes. The
    number of rounds is logarithmic in practice. Minima combine before the
    shuffle and hot nodes are split by Spark's skew join; every round starts at
    a table in the shared folder, and the one before it is deleted.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(edges)
    while True:
        large = stage(_star(edges, both=True))
        small = stage(_star(large, both=False))
        unstage(edges)
        unstage(large)
        edges, before, mark = small, mark, _mark(small)
        if mark == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Edges (a > b). Link the larger (or all smaller) neighbours of each node to its smallest one."""
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both:
        near = near.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if both:
        out = near.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        linked = near.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = linked.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()
