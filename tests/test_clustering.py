import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridclime.operators import (
    components,
    density,
    hdbscan,
    metrics,
    models,
    pairs,
    profile,
    reduce,
    sweeps,
)
from gridclime.sources import tables

CENTERS = np.array([[0, 0, 0], [6, 0, 1], [0, 7, 2], [6, 7, 0]], dtype=float)


@pytest.fixture(scope="module")
def blobs():
    """Four blobs, stray points, and a point that makes up a third of the rows."""
    rng = np.random.default_rng(0)
    x = [c + rng.normal(0, 0.6, (40, 3)) for c in CENTERS] + [rng.uniform(-3, 10, (20, 3))]
    x = np.vstack(x).round(4)
    truth = np.r_[np.repeat(range(4), 40), [-1] * 20]
    return np.vstack([x, np.repeat(x[:1], 90, axis=0)]), np.r_[truth, [0] * 90]


@pytest.fixture(scope="module")
def points(spark, blobs):
    rows = [(i, x.tolist(), int(t)) for i, (x, t) in enumerate(zip(*blobs))]
    return spark.createDataFrame(rows, "id int, x array<double>, cluster int").persist()


def between(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


@pytest.mark.parametrize("block_rows", [2048, 30])
def test_silhouette(points, blobs, block_rows):
    x, truth = blobs
    d, keep = between(x), truth >= 0
    want = np.full(len(x), np.nan)
    for i in np.flatnonzero(keep):
        own = truth == truth[i]
        a = d[i][own].sum() / (own.sum() - 1)
        b = min(d[i][truth == c].mean() for c in set(truth[keep]) - {truth[i]})
        want[i] = (b - a) / max(a, b)
    got = {
        r["id"]: r["silhouette"] for r in metrics.silhouette_rows(points, block_rows).collect()
    }
    assert set(got) == set(np.flatnonzero(keep))
    for i, value in got.items():
        assert value == pytest.approx(want[i])
    mean = metrics.silhouettes(points, block_rows=block_rows).first()["silhouette"]
    assert mean == pytest.approx(np.nanmean(want))
    by = {r["cluster"]: r for r in metrics.silhouette_by_cluster(points, block_rows).collect()}
    assert by[1]["std"] == pytest.approx(want[truth == 1].std())


def test_other_scores(points, blobs):
    x, truth = blobs[0][blobs[1] >= 0], blobs[1][blobs[1] >= 0]
    k, n = 4, len(x)
    mid = np.array([x[truth == c].mean(0) for c in range(k)])
    within = sum(((x[truth == c] - mid[c]) ** 2).sum() for c in range(k))
    between_ = sum((truth == c).sum() * ((mid[c] - x.mean(0)) ** 2).sum() for c in range(k))
    want = (between_ / (k - 1)) / (within / (n - k))
    assert metrics.calinski_harabasz(points).first()[1] == pytest.approx(want)
    s = [np.linalg.norm(x[truth == c] - mid[c], axis=1).mean() for c in range(k)]
    worst = [
        max((s[i] + s[j]) / np.linalg.norm(mid[i] - mid[j]) for j in range(k) if j != i)
        for i in range(k)
    ]
    assert metrics.davies_bouldin(points).first()[1] == pytest.approx(np.mean(worst))


def test_scores_ignore_label_numbers(points):
    swapped = points.withColumn("cluster", F.when(F.col("cluster") >= 0, 3 - F.col("cluster")).otherwise(-1))
    both = metrics.evaluate(
        points.join(swapped.select("id", F.col("cluster").alias("other")), "id"),
        {"one": "cluster", "two": "other"},
    ).collect()
    assert both[0].asDict() | {"algorithm": ""} == both[1].asDict() | {"algorithm": ""}


def test_one_cluster_has_no_scores(points):
    row = metrics.evaluate(points.withColumn("cluster", F.lit(0))).first()
    assert row["n_clusters"] == 1
    assert row["silhouette"] is None and row["davies_bouldin"] is None


@pytest.mark.parametrize("k", [1, 5, 60])
def test_k_distance(points, blobs, k):
    want = np.sort(between(blobs[0]), axis=1)[:, k - 1]
    got = {r["id"]: r["k_distance"] for r in pairs.k_distance_rows(points, k, block_rows=30).collect()}
    assert [got[i] for i in range(len(want))] == pytest.approx(list(want))


def brute_components(core, touch):
    label = -np.ones(len(core), dtype=int)
    for start in np.flatnonzero(core):
        if label[start] < 0:
            stack = [start]
            label[start] = start
            while stack:
                for j in np.flatnonzero(touch[stack.pop()] & core & (label < 0)):
                    label[j] = start
                    stack.append(j)
    return label


@pytest.mark.parametrize("block_rows", [2048, 25])
def test_dbscan(points, blobs, block_rows):
    x, _ = blobs
    touch = between(x) <= 1.0
    core = touch.sum(1) >= 5
    want = brute_components(core, touch)
    rows = density.dbscan(points, 1.0, 5, block_rows=block_rows).orderBy("id").collect()
    got = np.array([r["cluster"] for r in rows])
    assert [r["is_core"] for r in rows] == core.tolist()
    assert len({(a, b) for a, b in zip(want[core], got[core])}) == len(set(want[core]))
    assert len(set(got[core])) == len(set(want[core]))
    reached = (touch & core[None]).any(1)
    assert ((got >= 0) == reached).all()
    for i in np.flatnonzero(reached & ~core):
        assert got[i] in set(got[core & touch[i]])
    sizes = np.bincount(got[got >= 0])
    assert (np.diff(sizes) <= 0).all()


def test_components_of_a_long_chain(spark):
    chain = spark.range(1, 200).select((F.col("id") * 7 % 199).alias("u"), ((F.col("id") + 1) * 7 % 199).alias("v"))
    apart = spark.createDataFrame([(1000, 1001)], "u long, v long")
    got = components.connected_components(chain.unionByName(apart)).collect()
    assert {r["component"] for r in got} == {0, 1000}
    assert len(got) == 199 + 2


def test_kmeans_and_mixture(spark, points, blobs, tmp_path):
    core = points.filter("cluster >= 0")
    fitted = models.fit_kmeans(core, 4, restarts=3)
    rows = fitted.labels(core, "g").orderBy("id").collect()
    got = np.array([r["g"] for r in rows])
    assert len({(r["cluster"], r["g"]) for r in rows}) == 4
    assert (np.diff(np.bincount(got)) <= 0).all()
    x = blobs[0][blobs[1] >= 0]
    cost = sum(((x[got == c] - x[got == c].mean(0)) ** 2).sum() for c in range(4))
    assert fitted.cost == pytest.approx(cost)
    assert np.array(fitted.centers())[0] == pytest.approx(x[got == 0].mean(0))
    again = models.Fitted(**fitted.to_dict()).labels(core, "again").select("again").distinct()
    assert again.count() == 4
    scaled = core.withColumnRenamed("x", "scaled")
    projection = reduce.fit_projection(scaled, variance=2)
    tables.save_model(projection.model, str(tmp_path / "m"))
    loaded = reduce.Projection(tables.load_model(str(tmp_path / "m")), projection.ratios, projection.components)
    assert loaded.transform(scaled).orderBy("id").collect() == projection.transform(scaled).orderBy("id").collect()

    loose = core.filter("id < 160")
    mixture = models.fit_mixture(loose, 4, restarts=2)
    member = models.memberships(loose, mixture).select("membership", "uncertainty").collect()
    for r in member[:20]:
        first, second = sorted(r["membership"], reverse=True)[:2]
        assert sum(r["membership"]) == pytest.approx(1)
        assert r["uncertainty"] == pytest.approx(1 - (first - second))
    found = models.information(mixture, 160)
    parameters = 3 + 4 * 3 + 4 * 6
    assert found["bic"] - found["aic"] == pytest.approx(parameters * (np.log(160) - 2))


def test_projection(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 4)) @ rng.normal(size=(4, 4)) + 3
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{n} double" for n in names))
    scaling = reduce.fit_scaling(df, names)
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    order = values.argsort()[::-1]
    ratios = values[order] / values.sum()
    projection = reduce.fit_projection(scaling.transform(df), variance=0.95)
    keep = int((ratios.cumsum() < 0.95).sum()) + 1
    assert projection.ratios == pytest.approx(ratios[:keep].tolist())
    load = vectors[:, order[:keep]].T
    load *= np.sign(load[np.arange(keep), np.abs(load).argmax(1)])[:, None]
    assert np.allclose(projection.components, load)
    got = projection.transform(scaling.transform(df)).select("x").collect()
    assert np.allclose(sorted(r["x"][0] for r in got), sorted((z @ load.T)[:, 0]))


def test_best_k_and_candidates(spark):
    table = spark.createDataFrame([(3, 0.2), (4, 0.5), (5, 0.5)], "k int, silhouette double")
    assert sweeps.best_k(table) == 4
    assert sweeps.best_k(table.limit(0)) is None
    assert sweeps.candidate_ks(4, 1000) == [4, 6, 7, 8]
    assert sweeps.candidate_ks(9, 12) == [6, 7, 8, 9, 11]
    assert (sweeps.clamp_k(20, 10), sweeps.clamp_k(1, 10)) == (9, 2)
    inertia = spark.createDataFrame(
        [(3, 100.0, 1), (4, 40.0, 1), (5, 35.0, 1), (6, 33.0, 1)], "k int, inertia double, n_iter int"
    )
    assert sweeps.best_k(sweeps.with_differences(inertia), "elbow") == 5


def test_nearest_examples(spark):
    rng = np.random.default_rng(4)
    places = [(float(a), float(o), int(c)) for a, o, c in zip(
        rng.uniform(8, 37, 400).round(3), rng.uniform(68, 97, 400).round(3), rng.integers(0, 3, 400))]
    places += [(20.0, 80.0, 7)]
    asked = [(i, float(a), float(o), int(c)) for i, (a, o, c) in enumerate(zip(
        rng.uniform(0, 45, 50), rng.uniform(60, 99, 50), rng.integers(0, 3, 50)))] + [(99, 1.0, 1.0, 7)]
    got = profile.nearest_examples(
        spark.createDataFrame(asked, "query_id int, latitude double, longitude double, cluster int"),
        spark.createDataFrame(places, "latitude double, longitude double, cluster int"),
        block_rows=16,
    ).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = r["distance_deg"]
    for i, a, o, c in asked:
        want = sorted(np.hypot(p[0] - a, p[1] - o) for p in places if p[2] == c)[:3]
        assert [found[i][k + 1] for k in range(len(want))] == pytest.approx(want, abs=1e-4)


def test_points_hold_most_of_the_variance(spark):
    from catalog import clusters, learning

    def spread(rows, column):
        x = np.array([r[0] for r in rows.select(column).collect()])
        return x.var(axis=0).sum()

    sf_dir = "/root/testdata/sf0.001"
    share = spread(learning.points(spark, sf_dir), "x") / spread(clusters.vectors(spark, sf_dir), "x")
    assert 0.95 <= share < 1


def test_correlations_in_one_scan(spark):
    from gridclime.operators import explore

    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + [1e6, 0, -50, 3]
    x[:, 3] = 7.0
    known = rng.random((300, 4)) > [0, 0.2, 0.5, 0]
    rows = [tuple(float(v) if k else None for v, k in zip(*r)) for r in zip(x, known)]
    names = ["a", "b", "c", "d"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r["a"], r["b"]): r["r"] for r in explore.correlations(df, names).collect()}
    assert len(got) == 6
    for (a, b), value in got.items():
        i, j = names.index(a), names.index(b)
        both = known[:, i] & known[:, j]
        if "d" in (a, b):
            assert value is None
        else:
            assert value == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1])
    assert {r["r"] for r in explore.correlations(df.limit(0), names).collect()} <= {None}


def test_matrix_products_change_no_digit():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (300, 20)) + 1000
    x[150:] = x[:150]  # copies
    x[140:150] += 1e-7  # and points next to others
    want = pairs.distances(x, x)
    assert np.allclose(pairs.many_distances(x, x), want, rtol=1e-8, atol=0)
    i, j = np.nonzero(want >= 0)
    assert np.array_equal(pairs.distances_at(x, x, i, j), want.ravel())
    rows = pd.DataFrame({"pid": np.arange(300), "x": list(x), "w": 1})
    for radius in (None, 4.0):
        asked = rows if radius is None else rows.assign(radius=radius)
        found = pairs.nearest_of(asked, rows, 7).groupby("pid").agg(d=("d", sorted), id=("id", set))
        for pid in range(300):
            d = np.sort(want[pid])[6]
            near = np.flatnonzero(want[pid] <= (d if radius is None else min(d, radius)))
            assert found["id"][pid] == set(near)
            assert found["d"][pid] == sorted(want[pid][near])


def test_density_by_matrix_products_changes_nothing(spark, monkeypatch):
    """Points on the radius itself, copies and far offsets, in many dimensions: no pair is measured twice by coordinate."""
    rng = np.random.default_rng(3)
    x = np.vstack([rng.integers(0, 3, (300, 12)), rng.integers(0, 3, (100, 12)) + 1e6]).astype(float)
    for radius in (np.sqrt(5.0), 2.0, 0.0):
        assert np.array_equal(pairs.within(x, x, radius), pairs.distances(x, x) <= radius)
    y = rng.normal(0, 1, (400, 12)) + 1e3 * rng.integers(0, 2, (400, 1))
    side = pd.DataFrame({"pid": range(400), "x": list(y), "core": rng.uniform(0.5, 3, 400), "comp": rng.integers(0, 4, 400)})
    own = side["comp"].to_numpy()
    d = hdbscan._reaches(side, side)
    d[own[:, None] == own[None, :]] = np.inf
    monkeypatch.setattr(pairs, "distances", None)
    at, best = hdbscan._least_out(side, side, own, own)
    assert np.array_equal(at, d.argmin(axis=1)) and np.array_equal(best, d.min(axis=1))
    assert pairs.within(y, y, 2.0).sum() > 400


@pytest.mark.parametrize("block_rows", [None, 64])
def test_dbscan_in_many_dimensions(spark, block_rows):
    rng = np.random.default_rng(8)
    x = np.vstack([c + rng.normal(0, 0.5, (150, 12)) for c in (0, 3, 9)] + [rng.uniform(-5, 15, (20, 12))]).round(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, x array<double>")
    found = {r["id"]: r for r in density.dbscan(df, 2.2, 5, block_rows=block_rows).collect()}
    touch = between(x) <= 2.2
    core = touch.sum(axis=1) >= 5
    assert [found[i]["is_core"] for i in range(len(x))] == core.tolist()
    assert [found[i]["cluster"] < 0 for i in range(len(x))] == (~(touch & core[None, :]).any(axis=1)).tolist()
    same = np.array([found[i]["cluster"] for i in range(len(x))])
    assert len({c for c in same if c >= 0}) == len(set(brute_components(core, touch)[core]))
