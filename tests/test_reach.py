"""Searches within reach, against brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from gridclime.operators import hdbscan, pairs, ward


def patches(n: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    at = rng.random((n, 2)) * (1, 3)
    return at + 20.0 * rng.integers(0, 3, n)[:, None]


def test_cells_leave_out_no_neighbour():
    x = patches(700, 1)
    rows = pd.DataFrame({"pid": np.arange(700), "x": list(x), "w": 1})
    found = pairs.nearest_of(rows, rows, 6).groupby("pid")["d"].apply(sorted)
    want = np.sort(pairs.distances(x, x), axis=1)[:, :6]
    assert all(list(want[i]) == found[i] for i in range(700))
    met = sum(len(cell) * len(some) for cell, some in pairs.near_cells(x, x, np.full(700, np.inf), 6))
    assert met < 700 * 700 / 2


def test_contraction_takes_all_safe_edges_at_once():
    # A line of 64 components; from the eighth edge on nothing is known beyond the radius.
    d = np.arange(1.0, 64.0)
    known = pd.DataFrame({"comp": np.arange(63), "other": np.arange(1.0, 64.0), "d": d, "a": np.arange(63), "b": np.arange(1, 64), "radius": 8.0})
    known = pd.concat([known, pd.DataFrame({"comp": [63], "radius": [8.0]})])
    out = hdbscan._contracted(known)
    assert sorted(out["d"].dropna()) == [1, 2, 3, 4, 5, 6, 7, 8]
    assert out.dropna(subset="node").set_index("node")["root"].nunique() == 56


def spans(spark, x):
    rows = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>")
    blocks = pairs.blocked(pairs.distinct_points(rows), 64)
    near = pairs.neighbours(blocks, blocks, 6)
    points = blocks.points.join(near.select("pid", F.element_at("near", -1)["d"].alias("core")), "pid").localCheckpoint()
    found = hdbscan.spanning_edges(pairs.Blocks(points, blocks.cells, blocks.depth), near).toPandas()
    d = pairs.distances(x, x)
    core = np.sort(d, axis=1)[:, 5]
    reach = np.maximum(np.maximum(d, core[:, None]), core[None, :])
    joined, best, want = np.zeros(len(x), dtype=bool), reach[0].copy(), []
    joined[0] = True
    for _ in range(len(x) - 1):
        at = np.where(joined, np.inf, best).argmin()
        want.append(best[at])
        joined[at], best = True, np.minimum(best, reach[at])
    assert np.array_equal(np.sort(found["d"]), np.sort(want))


def test_spanning_edges_over_few_wide_gaps(spark):
    spans(spark, patches(500, 2))


def test_spanning_edges_in_many_dimensions(spark):
    spans(spark, np.random.default_rng(7).normal(size=(200, 10)))


def test_nearest_clusters_by_matrix_products():
    rng = np.random.default_rng(3)
    x, w, ids = rng.random((300, 20)), rng.integers(1, 9, 300).astype(float), rng.permutation(300)
    x[7], w[7] = x[100], w[100]
    d = ward.ward_distances(x, w, x, w)
    np.fill_diagonal(d, np.inf)
    called = []
    exact, ward.ward_distances = ward.ward_distances, lambda *a: called.append(1) or exact(*a)
    try:
        near, gap = ward.nearest_clusters(x, w, ids, x, w, ids)
    finally:
        ward.ward_distances = exact
    order = ids.argsort()
    assert np.array_equal(near, order[d[:, order].argmin(axis=1)]) and np.array_equal(gap, d.min(axis=1))
    assert not called


def test_ward_in_many_dimensions_over_blocks(spark):
    x = np.random.default_rng(4).random((150, 12))
    points = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "pid long, x array<double>, w long")
    one = ward.merges_of(points, 2048).toPandas().sort_values("height")
    some = ward.merges_of(points, 64).toPandas().sort_values("height")
    assert np.allclose(one["height"], some["height"], rtol=1e-12) and list(one["size"]) == list(some["size"])


def test_distances_of_a_high_rank(spark):
    rng = np.random.default_rng(5)
    x, w = rng.random((300, 10)), rng.integers(1, 4, 300)
    points = spark.createDataFrame([(i, v.tolist(), int(n)) for i, (v, n) in enumerate(zip(x, w))], "pid long, x array<double>, w long")
    points = pairs.materialize(points)
    found = pairs.rank_distances(points, 150, 64, 40).toPandas().set_index("pid")["d"]
    d = pairs.distances(x, x)
    order = d.argsort(axis=1)
    at = (np.cumsum(w[order], axis=1) < 150).sum(axis=1)
    assert [found[i] for i in range(300)] == [d[i, order[i, at[i]]] for i in range(300)]


def test_hdbscan_without_long_lists(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(240, 10)) + 8.0 * (np.arange(240) % 2)[:, None]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")

    def found():
        out = hdbscan.hdbscan(rows, 70, block_rows=128).toPandas().sort_values("id")
        return out[["cluster", "probability", "outlier_score"]].to_numpy()

    short = found()
    monkeypatch.setattr(hdbscan, "LISTED", 10**9)
    assert np.allclose(short, found(), atol=1e-12) and set(short[:, 0]) >= {0, 1}
