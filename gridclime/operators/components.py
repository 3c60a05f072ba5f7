"""Connected components and minimum spanning forests of edge tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclime.functions.lineage import materialize

#: What is left of a contraction is finished by one task once it has so many rows of two values; rounds go on until then.
FEW = 100_000


def _followed(parents: pd.DataFrame) -> pd.DataFrame:
    """Parents of one small table followed to the end."""
    at = pd.Index(parents["node"]).get_indexer(parents["root"])
    up = np.where(at < 0, np.arange(len(at)), at)
    while not np.array_equal(up, up[up]):
        up = up[up]
    return parents.assign(root=parents["root"].to_numpy()[up])


def _reached(edges: pd.DataFrame) -> pd.DataFrame:
    """The smallest node in reach of each node of one small table of edges."""
    nodes, ends = np.unique(np.concatenate([edges["u"].to_numpy(), edges["v"].to_numpy()]), return_inverse=True)
    u, v = ends[: len(edges)], ends[len(edges) :]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[u], least[v])
        moved = least.copy()
        for side in (u, v):
            np.minimum.at(moved, least[side], low)
        while not np.array_equal(moved, moved[moved]):
            moved = moved[moved]
        if np.array_equal(moved, least):
            return pd.DataFrame({"node": nodes, "root": nodes[least]})
        least = moved


def _at_once(table: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on a table of at most ``FEW`` rows, in one task; stored."""
    return materialize(table.groupBy().applyInPandas(lambda rows: work(rows), schema))


def _roots(parents: DataFrame, few: int = FEW) -> DataFrame:
    """(node, root): parents followed to the end by pointer jumping, four times as far in every round.

    Parents lead to a node that is its own parent, or to one without a row, in a
    number of rounds logarithmic in the longest chain.
    """

    def jumped(table: DataFrame) -> DataFrame:
        above = table.select(F.col("node").alias("root"), F.col("root").alias("next"))
        return table.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root"))

    table = materialize(parents.select("node", "root"))
    if table.count() <= few:
        kind = dict(table.dtypes)["node"]
        return _at_once(table, _followed, f"node {kind}, root {kind}")
    while True:
        before = table.select("node", F.col("root").alias("was"))
        moved = materialize(jumped(jumped(table)).join(before, "node"))
        table = moved.select("node", "root")
        if moved.filter("root <> was").isEmpty():
            return table


def connected_components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (u, v): the smallest node in reach.

    Each round hooks every node to its smallest neighbour and contracts; at
    least half of the nodes go, so rounds are logarithmic.
    """
    live = materialize(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u <> v")
        .distinct()
    )
    members = None
    while n := live.count():
        if n <= few:
            kind = dict(live.dtypes)["u"]
            roots = _at_once(live, _reached, f"node {kind}, root {kind}")
            members = roots if members is None else _renamed(members, roots)
            break
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parents = both.groupBy(F.col("u").alias("node")).agg(
            F.least(F.col("node"), F.min("v")).alias("root")
        )
        roots = _roots(parents, few)
        members = roots if members is None else _renamed(members, roots)
        a, b = (
            roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in ("u", "v")
        )
        live = materialize(
            live.join(a, "u")
            .join(b, "v")
            .select(F.greatest("ru", "rv").alias("u"), F.least("ru", "rv").alias("v"))
            .filter("u <> v")
            .distinct()
        )
    if members is None:
        members = edges.select(F.col("u").alias("node"), F.col("u").alias("root")).limit(0)
    return members.select("node", F.col("root").alias("component"))


def _renamed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members under the roots of their roots."""
    above = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return materialize(
        members.join(above, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root")
        )
    )
