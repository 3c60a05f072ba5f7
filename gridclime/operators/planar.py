"""Sums of distances to the points of clusters, for many points in the plane or on a line.

A cell of the cuts that lies far from a block is replaced by weights on a small
grid of Chebyshev nodes in its box: seen from there, the distance is a smooth
function of the place in the cell. Blocks that are near meet point by point. So
all points count, to more than nine digits, and the work no longer grows with the
square of the points.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclime.functions.lineage import materialize
from gridclime.operators.pairs import _gap, _shares, _totals, _union, Blocks, distances, matrix, over_pairs

#: Up to so many coordinates a grid has few nodes.
SIZE = 2
BLOCK_ROWS = 1024
#: Nodes of the grid per coordinate.
NODES = 16
#: A cell is far where its distance is at least this share of its diagonal.
FAR = 0.5
#: Blocks or cells that a block meets in one call.
TOGETHER = 16

MOMENTS = "cell string, model int, other int, lo array<double>, hi array<double>, q array<double>"
SUMS = "pid long, model int, other int, total double"


def grid(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The nodes of a box, last coordinate fastest."""
    t = np.cos(np.pi * (np.arange(NODES) + 0.5) / NODES)
    axes = [(h + l) / 2 + (h - l) / 2 * t for l, h in zip(lo, hi)]
    return np.stack([m.ravel() for m in np.meshgrid(*axes, indexing="ij")], axis=1)


def spread(points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """How each point of a box is shared out over its nodes; a row adds up to 1."""
    degrees = np.arange(NODES)
    basis = np.cos(np.outer(np.pi * (degrees + 0.5) / NODES, degrees)) * np.where(degrees > 0, 2, 1) / NODES
    out = np.ones((len(points), 1))
    for c in range(points.shape[1]):
        half = (hi[c] - lo[c]) / 2
        t = np.clip((points[:, c] - (hi[c] + lo[c]) / 2) / half, -1, 1) if half > 0 else np.zeros(len(points))
        share = np.cos(np.outer(np.arccos(t), degrees)) @ basis.T
        out = (out[:, :, None] * share[:, None, :]).reshape(len(points), -1)
    return out


def _moments(blocks: Blocks) -> DataFrame:
    """The weights on the nodes of every cell but those that nothing is far from, per model and cluster; stored."""

    def of_points(rows: pd.DataFrame) -> pd.DataFrame:
        at, first = matrix(rows), rows.iloc[0]
        lo, hi = at.min(axis=0), at.max(axis=0)
        present, share = _shares(np.stack(rows["labels"].to_numpy()), rows["w"].to_numpy().astype(float))
        q = share.T @ spread(at, lo, hi)
        return pd.DataFrame([(first["block"], m, c, lo, hi, row) for (m, c), row in zip(present, q)], columns=MOMENT_NAMES)

    def of_cells(rows: pd.DataFrame) -> pd.DataFrame:
        lo, hi = np.stack(rows["lo2"].to_numpy())[0], np.stack(rows["hi2"].to_numpy())[0]
        found: dict[tuple[int, int], np.ndarray] = {}
        for _, part in rows.groupby("cell"):
            shares = spread(grid(part["lo"].iloc[0], part["hi"].iloc[0]), lo, hi)
            for m, c, q in zip(part["model"], part["other"], part["q"]):
                found[m, c] = found.get((m, c), 0) + np.asarray(q) @ shares
        cell = rows["parent"].iloc[0]
        return pd.DataFrame([(cell, m, c, lo, hi, q) for (m, c), q in found.items()], columns=MOMENT_NAMES)

    MOMENT_NAMES = ["cell", "model", "other", "lo", "hi", "q"]
    level = materialize(blocks.points.select("block", "x", "w", "labels").groupBy("block").applyInPandas(of_points, MOMENTS))
    steps = F.size(F.split("cell", "/"))
    tree = blocks.cells.select("cell", "parent", "lo", "hi")
    boxes = tree.select(F.col("cell").alias("parent"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    found = [level]
    # Leaves stand at several depths: those of a depth join the cells made of deeper ones.
    leaves, made = level, None
    for depth in range(blocks.depth + 1, 2, -1):
        here = leaves.filter(steps == depth)
        here = here if made is None else here.unionByName(made)
        made = materialize(here.join(tree.select("cell", "parent"), "cell").join(boxes, "parent").groupBy("parent").applyInPandas(of_cells, MOMENTS))
        found.append(made)
    return materialize(_union(found))


def _diagonal(lo: str, hi: str) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(hi, lo, lambda h, l: h - l), F.lit(0.0), lambda t, d: t + d * d))


def near_and_far(blocks: Blocks) -> tuple[DataFrame, DataFrame]:
    """(a, b) for each block a: blocks b to be met by point, and far cells that hold all other points; both stored.

    As in ``block_pairs`` the search goes down the cells, one join for each round of cuts.
    """
    boxes = blocks.cells.select("g", "parent", F.col("cell").alias("b"), "leaf", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    asked = blocks.cells.filter("leaf").select(F.col("cell").alias("a"), "g", "lo", "hi")
    front = asked.join(boxes.filter("parent IS NULL").drop("parent"), "g")
    apart = F.col("parent").isNotNull() & (_gap("lo", "hi", "lo2", "hi2") >= FAR * _diagonal("lo2", "hi2"))
    near, far, rooted = [], [], front.withColumn("parent", F.lit(None).cast("string"))
    for step in range(blocks.depth + 1):
        seen = materialize(rooted.withColumn("apart", apart))
        far.append(seen.filter("apart").select("a", "b"))
        near.append(seen.filter("NOT apart AND leaf").select("a", "b"))
        above = seen.filter("NOT apart AND NOT leaf").select("a", "lo", "hi", F.col("b").alias("parent"))
        rooted = above.join(boxes.drop("g").filter("parent IS NOT NULL"), "parent")
    return materialize(_union(near)), materialize(_union(far))


def cluster_distance_sums(blocks: Blocks) -> DataFrame:
    """(pid, model, other, total), as ``pairs.cluster_distance_sums``, for up to two coordinates."""
    near, far = near_and_far(blocks)

    def bundled(found: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """What each block meets, ``TOGETHER`` of them under one name, and the pairs of block and name."""
        turn = F.row_number().over(Window.partitionBy("a").orderBy("b"))
        named = found.withColumn("block", F.concat_ws("|", "a", F.floor((turn - 1) / TOGETHER).cast("string")))
        named = materialize(named)
        met = named.select(F.col("b").alias(key), "block").join(right.withColumnRenamed("block", key) if key != "cell" else right, key)
        return met, named.select("a", F.col("block").alias("b")).distinct()

    def totals(rows: pd.DataFrame, parts) -> pd.DataFrame:
        """Sums over ``parts`` (places, columns, weights per column) at the rows."""
        at, sums = matrix(rows), {}
        for to, columns, weights in parts:
            for first in range(0, len(to), BLOCK_ROWS):
                found = distances(at, to[first : first + BLOCK_ROWS]) @ weights[first : first + BLOCK_ROWS]
                for i, column in enumerate(columns):
                    sums[column] = sums.get(column, 0) + found[:, i]
        labels = np.stack(rows["labels"].to_numpy())
        columns = list(sums)
        out = _totals(rows["pid"].to_numpy(), labels, columns, np.stack([sums[c] for c in columns], axis=1)) if columns else []
        return pd.concat(out) if out else pd.DataFrame(columns=["pid", "model", "other", "total"])

    def by_point(rows, others, _):
        columns, weights = _shares(np.stack(others["labels"].to_numpy()), others["w"].to_numpy().astype(float))
        return totals(rows, [(matrix(others), columns, weights)])

    def by_cell(rows, others, _):
        parts = []
        for _, cell in others.groupby("cell"):
            columns = list(zip(cell["model"].tolist(), cell["other"].tolist()))
            parts.append((grid(cell["lo"].iloc[0], cell["hi"].iloc[0]), columns, np.stack(cell["q"].to_numpy()).T))
        return totals(rows, parts)

    points = blocks.points.select("block", "pid", "x", "w", "labels")
    others, pairs = bundled(near, points.drop("pid"), "of")
    found = over_pairs(points, others.drop("of"), pairs, by_point, SUMS)
    cells, pairs = bundled(far, _moments(blocks), "cell")
    found = found.unionByName(over_pairs(points, cells, pairs, by_cell, SUMS))
    return found.groupBy("pid", "model", "other").agg(F.sum("total").alias("total"))
