"""Silhouettes in the plane: exact, without meeting all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridclime.operators import metrics, pairs, planar


def scattered(n: int, seed: int = 3) -> np.ndarray:
    """Three groups far apart, a line of points, and one point alone."""
    rng = np.random.default_rng(seed)
    at = rng.random((n, 2)) * [10, 11] + rng.integers(0, 3, n)[:, None] * [100, 60]
    at[: n // 10, 1] = 5.0
    at[-1] = [1e4, -1e4]
    return at


def table(spark, at: np.ndarray, labels: np.ndarray):
    rows = [(i, x, c) for i, (x, c) in enumerate(zip(at.tolist(), labels.tolist()))]
    return spark.createDataFrame(rows, "pid long, x array<double>, labels array<int>").withColumn("w", F.lit(2).cast("long"))


@pytest.mark.parametrize("size", [1, 2])
def test_sums_of_distances_in_the_plane(spark, size):
    at = scattered(3000)[:, :size]
    at = np.unique(at, axis=0)
    rng = np.random.default_rng(5)
    labels = np.stack([rng.integers(-1, 3, len(at)), (at[:, 0] > 50).astype(int)], axis=1)
    blocks = pairs.blocked(table(spark, at, labels), 32)
    assert blocks.depth >= 2
    near, far = planar.near_and_far(blocks)
    assert far.count() > 0
    found = {(r["pid"], r["model"], r["other"]): r["total"] for r in planar.cluster_distance_sums(blocks).collect()}
    d = np.sqrt(((at[:, None, :] - at[None, :, :]) ** 2).sum(axis=2))
    expected = 0
    for m in range(2):
        for c in set(labels[:, m].tolist()) - {-1}:
            total = 2 * d[:, labels[:, m] == c].sum(axis=1)
            for pid in np.nonzero(labels[:, m] >= 0)[0]:
                expected += 1
                assert found[pid, m, c] == pytest.approx(total[pid], rel=1e-9)
    assert len(found) == expected


def test_pairs_in_the_plane_grow_with_the_points(spark):
    """Four times the points, not sixteen times the pairs."""

    def met(n: int) -> tuple[int, int]:
        """Pairs met by point, and pairs of a point and a far cell."""
        blocks = pairs.blocked(table(spark, scattered(n), np.zeros((n, 1), dtype=int)), 64)
        sizes = blocks.cells.filter("leaf").select(F.col("cell").alias("a"), "n")
        near, far = planar.near_and_far(blocks)
        others = sizes.select(F.col("a").alias("b"), F.col("n").alias("m"))
        by_point = near.join(sizes, "a").join(others, "b").agg(F.sum(F.col("n") * F.col("m")))
        return by_point.first()[0], far.join(sizes, "a").agg(F.sum("n")).first()[0]

    few, many = met(8000), met(32000)
    assert many[0] < 6 * few[0] and many[0] < 32000**2 // 20
    # Larger cells stand for many blocks.
    assert many[1] < 32000 * 150


def test_silhouettes_in_the_plane_and_beside_it(spark):
    """A coordinate of zeros changes no distance, but leads past the plane."""
    at = scattered(2500)
    rows = [(x, x + [0.0], int(x[0] > 50) + int(x[0] > 150)) for x in at.tolist()]
    both = spark.createDataFrame(rows, "flat array<double>, deep array<double>, cluster int")
    one = metrics.silhouettes(both.select(F.col("flat").alias("x"), "cluster"), block_rows=100).first()
    two = metrics.silhouettes(both.select(F.col("deep").alias("x"), "cluster")).first()
    assert one["silhouette"] == pytest.approx(two["silhouette"], rel=1e-10)
