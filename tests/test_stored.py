"""Stored runs, assignment by the chosen model, and what cleaning reports."""

from dataclasses import replace

import numpy as np
import pytest

from gridclime.functions.lineage import materialize
from gridclime.operators import clean, explore, models, normalize, reduce, validate
from gridclime.plans import regions
from gridclime.sources import payloads


@pytest.fixture(scope="module")
def run(spark):
    rng = np.random.default_rng(3)
    rows = []
    for part, n in ((0, 30), (1, 20), (2, 10)):
        for i in range(n):
            a, b = 50.0 * part + rng.normal(), -30.0 * part + rng.normal()
            rows.append((float(part), float(i), a, b, part if i else -1))
    names = "latitude double, longitude double, a double, b double, cluster_dbscan int"
    df = spark.createDataFrame(rows, names)
    scaling = reduce.fit_scaling(df, ["a", "b"])
    scaled = scaling.transform(df)
    projection = reduce.fit_projection(scaled, variance=2)
    placed = materialize(projection.transform(scaled).drop("scaled"))
    fitted = {"K-Means": models.fit_kmeans(placed, 3, 3), "GMM": models.fit_mixture(placed, 3, 3)}
    columns = {"K-Means": "cluster_kmeans", "GMM": "cluster_gmm", "DBSCAN": "cluster_dbscan"}
    for name, found in fitted.items():
        placed = found.labels(placed, columns[name])
    comparison = spark.createDataFrame([("K-Means", 3)], "algorithm string, n_clusters int")
    return regions.Regions(
        scaling, projection, materialize(placed), comparison, "GMM", fitted, columns,
        {"elbow": spark.createDataFrame([(3, 1.0)], "k int, inertia double")},
    )


@pytest.mark.parametrize("name", ["K-Means", "GMM", "DBSCAN"])
def test_stored_run_assigns_as_before(spark, run, tmp_path, name):
    regions.save(run, str(tmp_path))
    loaded = regions.load(spark, str(tmp_path))
    assert loaded.algorithm == "GMM" and loaded.scaling == run.scaling
    assert loaded.by_k["elbow"].collect() == run.by_k["elbow"].collect()
    new = spark.createDataFrame([(9.0, 9.0, 49.0, -31.0), (9.0, 8.0, 0.0, None)],
                                "latitude double, longitude double, a double, b double")
    got = regions.assign_places(replace(loaded, algorithm=name), new).orderBy("longitude").collect()
    # A missing feature gets the training median, that of the largest part's neighbour.
    assert got[1]["cluster"] == 1
    method = "nearest-centroid" if name == "DBSCAN" else f"model:{name}"
    assert {r["assignment_method"] for r in got} == {method}
    assert (got[1]["confidence"] is None) == (name == "K-Means")


def test_rounding_noise_is_no_spread(spark):
    rows = [(0.1 + 0.2 if i % 2 else 0.3, float(i)) for i in range(8)]
    df = spark.createDataFrame(rows, "same double, other double")
    for method in ("standard", "minmax", "robust"):
        assert reduce.fit_scaling(df, ["same", "other"], method).scales[0] == 1.0


def test_cleaning_report(spark):
    rows = [(1.0, 1.0, f"2000-01-{d:02d}", None if d == 2 else float(d), None) for d in (1, 2, 2, 3)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, date string, t double, u double")
    got = {(r["step"], r["subject"]): r["n"] for r in clean.report(df.withColumn("date", df.date.cast("date"))).collect()}
    assert got == {("removed_rows", "rows"): 1, ("removed_column", "u"): 3, ("filled", "t"): 1}


def test_payloads_with_unlike_series(spark):
    body = (
        '{"properties":{"parameter":{"A":{"20000101":1,"20000102":2},'
        '"B":{"20000102":5,"20000101":4},"C":{"20000102":7}}}}'
    )
    df = spark.createDataFrame([(1.0, 2.0, body)], "latitude double, longitude double, payload string")
    got = payloads.parse_payloads(df, codes=["A", "B", "C", "D"]).orderBy("date").collect()
    assert [(r["A"], r["B"], r["C"], r["D"]) for r in got] == [(1, 4, None, None), (2, 5, 7, None)]


def test_empty_tables(spark):
    daily = spark.createDataFrame([], "latitude double, longitude double, date date, t double")
    left, right = normalize.common_dates(daily, daily)
    assert left.isEmpty() and right.isEmpty()
    assert explore.place_series(daily, 1.0, 1.0, "t").isEmpty()
    assert {r["check"] for r in validate.report(daily).collect()} == {"coverage"}
