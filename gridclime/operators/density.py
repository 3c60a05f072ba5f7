"""Density clustering by a fixed radius."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridclime.functions.lineage import materialize
from gridclime.operators import pairs
from gridclime.operators.components import _reached, connected_components
from gridclime.operators.pairs import TILE

NOISE_WARNING_PCT = 30


def renumber(labels: DataFrame, component: str = "component") -> DataFrame:
    """(pid, x, w, component, …) with ``cluster``: 0 for the most rows, ties by smallest vector.

    A component is named by the pid of one of its core points. Points without one
    are joined by their own pid, which names none, so that noise is spread.
    """
    sizes = labels.filter(F.col(component).isNotNull()).groupBy(component).agg(
        F.sum("w").alias("n"), F.min("x").alias("first")
    )
    numbers = sizes.select(
        F.col(component).alias("_name"),
        (F.row_number().over(Window.orderBy(F.desc("n"), "first")) - 1).alias("cluster"),
    )
    named = labels.withColumn("_name", F.coalesce(component, "pid"))
    return named.join(numbers, "_name", "left").withColumn(
        "cluster", F.coalesce("cluster", F.lit(-1)).cast("int")
    ).drop("_name")


def _tiles(rows: pd.DataFrame, others: pd.DataFrame, eps: float) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Which rows and others lie within eps, a tile at a time."""
    at, to = pairs.matrix(rows), pairs.matrix(others)
    for i in range(0, len(at), TILE):
        for j in range(0, len(to), TILE):
            one, two = slice(i, i + TILE), slice(j, j + TILE)
            yield one, two, pairs.within(at[one], to[two], eps)


def neighbour_weight(points: DataFrame, near: DataFrame, eps: float) -> DataFrame:
    """(pid, degree): rows within eps of each point, itself included."""

    def count(rows, others, same):
        w, v = (side["w"].to_numpy().astype(float) for side in (rows, others))
        mine, theirs = np.zeros(len(rows)), np.zeros(len(others))
        for i, j, touch in _tiles(rows, others, eps):
            mine[i] += touch @ v[j]
            theirs[j] += w[i] @ touch
        sides = [(rows, mine)] if same else [(rows, mine), (others, theirs)]
        return pd.concat([pd.DataFrame({"pid": side["pid"], "degree": n.astype(np.int64)}) for side, n in sides])

    counted = pairs.over_pairs(points, points, near.filter("a <= b"), count, "pid long, degree long")
    return counted.groupBy("pid").agg(F.sum("degree").alias("degree"))


def _local_components(touch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest position in reach for both sides of a bipartite contact matrix."""
    n, m = touch.shape
    left, right = np.arange(n), np.full(m, n + m)
    while True:
        spread = np.where(touch, left[:, None], n + m)
        right_now = np.minimum(right, spread.min(axis=0, initial=n + m))
        left_now = np.minimum(
            left, np.where(touch, right_now[None, :], n + m).min(axis=1, initial=n + m)
        )
        if np.array_equal(left_now, left) and np.array_equal(right_now, right):
            return left, right
        left, right = left_now, right_now


def dbscan(
    df: DataFrame, eps: float, min_samples: int = 5, x: str = "x", block_rows: int | None = None
) -> DataFrame:
    """Rows with ``cluster`` (-1 for noise) and ``is_core``.

    A row is core with at least ``min_samples`` rows within eps, itself counted.
    Core rows within eps share a cluster; other rows near a core row join the
    such cluster whose first vector is smallest. A block pair reports at most
    one link per core point, to its local component, never its pairs; a row that
    is not core has fewer than ``min_samples`` neighbours to report.
    """
    spots = pairs.distinct_points(df, x)
    blocks = pairs.blocked(spots, block_rows or pairs.block_size(spots))
    points, near = blocks.points, pairs.near_pairs(blocks, blocks, eps)
    degrees = neighbour_weight(points, near, eps)
    core = F.col("degree") >= min_samples
    marked = materialize(points.join(degrees, "pid").withColumn("is_core", core))

    def link(rows, others, _):
        ids, theirs, u, v = rows["pid"].to_numpy(), others["pid"].to_numpy(), [], []
        for i, j, touch in _tiles(rows, others, eps):
            left, right = _local_components(touch)
            linked = right < len(left)
            u += [ids[i], theirs[j][linked]]
            v += [ids[i][left], ids[i][right[linked]]]
        found = pd.DataFrame({"u": np.concatenate(u), "v": np.concatenate(v)})
        found = _reached(found[found["u"] != found["v"]]).set_axis(["u", "v"], axis=1)
        return found[found["u"] != found["v"]]

    cores = marked.filter("is_core")
    links = pairs.over_pairs(cores, cores, near.filter("a <= b"), link, "u long, v long")
    found = connected_components(links)
    owned = cores.select("pid").join(
        found.withColumnRenamed("node", "pid"), "pid", "left"
    ).select("pid", F.coalesce("component", "pid").alias("component"))
    cores = materialize(cores.join(owned, "pid"))

    def adopt(rows, others, _):
        ids, theirs, found = rows["pid"].to_numpy(), others["component"].to_numpy(), []
        for one, two, touch in _tiles(rows, others, eps):
            i, j = np.nonzero(touch)
            found.append(pd.DataFrame({"pid": ids[one][i], "component": theirs[two][j]}).drop_duplicates())
        return pd.concat(found).drop_duplicates()

    edge = marked.filter("NOT is_core")
    adopted = pairs.over_pairs(edge, cores, near, adopt, "pid long, component long")
    firsts = cores.groupBy("component").agg(F.min("x").alias("first"))
    adopted = adopted.join(firsts, "component").groupBy("pid").agg(
        F.min_by("component", "first").alias("component")
    )
    labels = marked.join(owned.unionByName(adopted), "pid", "left")
    numbered = renumber(labels).select(F.col("x").alias(x), "cluster", "is_core")
    return df.drop("cluster", "is_core").join(numbered, x)


def noise_share(df: DataFrame) -> DataFrame:
    """One row: noise percent and whether it is high."""
    pct = F.count_if(F.col("cluster") < 0) / F.count(F.lit(1)) * 100
    return df.agg(pct.alias("noise_pct")).withColumn(
        "is_high", F.col("noise_pct") > NOISE_WARNING_PCT
    )
