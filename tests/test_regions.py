import pytest
from pyspark.sql import functions as F

from gridclime.operators import assign, insights, metrics, profile


def test_composite(spark):
    df = spark.createDataFrame(
        [("HDBSCAN", 0.6119, 0.5581, 0.7826), ("none", None, None, None)],
        "algorithm string, silhouette double, davies_bouldin double, cluster_balance double",
    )
    got = {r["algorithm"]: r["composite_score"] for r in metrics.with_composite(df).collect()}
    assert got["HDBSCAN"] == pytest.approx(1.00761604, abs=1e-8)
    assert got["none"] == pytest.approx(0.3 / 10.01)


def test_model_choice(spark):
    rows = [
        ("HDBSCAN", 2, 945, 0.6119, 474.88, 0.5581, 0.7826, 0.6087),
        ("K-Means(k=6)", 6, 0, 0.2969, 582.15, 1.0492, 0.6470, 0.2203),
        ("Hierarchical(Ward, k=6)", 6, 0, 0.2797, 541.20, 1.0332, 0.6518, 0.2298),
        ("K-Means(k=8)", 8, 0, 0.2905, 562.65, 0.9833, 0.4906, 0.2073),
        ("GMM(k=8)", 8, 0, 0.2456, 449.99, 1.1638, 0.5606, 0.2003),
        ("K-Means", 4, 0, 0.3195, 617.78, 1.0968, 0.3564, 0.4579),
        ("DBSCAN", 10, 51, 0.3576, 98.78, 0.7806, -1.6417, 0.8920),
    ]
    df = spark.createDataFrame(
        [(a, k, 1153, n, s, c, d, b, m) for a, k, n, s, c, d, b, m in rows],
        "algorithm string, n_clusters long, n_samples long, n_noise long, silhouette double, "
        "calinski_harabasz double, davies_bouldin double, cluster_balance double, "
        "max_cluster_share double",
    )
    assert metrics.choose_model(df).first()["algorithm"] == "GMM(k=8)"
    rest = df.filter("n_clusters NOT IN (6, 8)")
    assert metrics.choose_model(rest).first()["algorithm"] == "K-Means"
    assert metrics.choose_model(rest.filter("n_clusters > 4")).first()["tier"] == 5


def test_texts(spark):
    df = spark.createDataFrame(
        [("wind_power_density_80m", 2.0), ("solar_wind_complementarity", -0.7), ("nasa_uv_index", -1.6),
         ("soil_temp_proxy", 0.6), ("wind_shear_coefficient", -0.6)],
        "feature string, z double",
    )
    text = profile.characteristic_text(F.col("feature"), F.col("z"))
    assert [r[0] for r in df.select(text).collect()] == [
        "much higher wind energy potential than average",
        "weaker solar-wind complementarity than average",
        "much lower UV intensity than the India sample average",
        "higher soil temp proxy than the India sample average",
        "stronger vertical wind change than the India sample average",
    ]


def test_labels(spark):
    df = spark.createDataFrame(
        [(0, 34.0, 75.0, 5.0), (1, 12.0, 78.0, 22.0), (-1, 12.0, 78.0, 22.0), (2, 28.0, 75.0, 22.0)],
        "cluster int, latitude double, longitude double, temperature_2m_mean double",
    )
    got = {r["cluster"]: r["cluster_label"] for r in profile.cluster_labels(df).collect()}
    assert got == {
        0: "Upper Himalayan Cold Pocket",
        1: "Southern Peninsular Belt",
        -1: "Noise/Outlier",
        2: "Moderate",
    }
    seen = profile.attach_labels(
        spark.createDataFrame([(0,), (9,)], "cluster int"), profile.cluster_labels(df)
    )
    assert {r["cluster"]: r["cluster_label"] for r in seen.collect()}[9] == "Unassigned"


def test_sectors_with_missing_columns(spark):
    df = spark.createDataFrame(
        [(0, 24.0), (0, 26.0), (-1, 0.0)], "cluster int, temperature_2m_mean double"
    )
    row = insights.agriculture(df).first()
    assert row["points"] == 2 and row["precipitation_sum_mean"] is None
    # 0.22 (1 − 1/14) + 0.22·0.5 + 0.14 + 0.10·0.5 + 0.14·0.5 + 0.18·0.5
    assert row["agriculture_suitability_score"] == pytest.approx(0.664)
    assert row["agriculture_summary"] == "balanced-growing-conditions"
    assert insights.disaster(df).count() == 1


def test_assignment(spark):
    train = spark.createDataFrame(
        [([0.0, 0.0], 0), ([2.0, 0.0], 0), ([10.0, 0.0], 1), ([99.0, 9.0], -1)],
        "x array<double>, cluster int",
    )
    new = spark.createDataFrame([([3.0, 0.0],), ([60.0, 0.0],)], "x array<double>")
    got = sorted(
        (r["x"][0], r["cluster"], r["alternative"], r["confidence"])
        for r in assign.assign_by_centroid(new, train).collect()
    )
    assert got[0][:3] == (3.0, 0, 1) and got[0][3] == pytest.approx(1 - 2 / 9)
    assert got[1][:3] == (60.0, 1, 0)
    only = assign.assign_by_centroid(new, train.filter("cluster <> 1")).first()
    assert only["confidence"] == 1.0 and only["alternative"] is None


def test_names(spark):
    df = spark.createDataFrame([("  new   DELHI ",), ("pur",), ("Mumbay",), ("",)], "name string")
    found = {}
    for r in assign.match_names(df).orderBy("name", "rank").collect():
        found.setdefault(r["name"], []).append(r["match"])
    assert found["  new   DELHI "][0] == "Delhi"
    assert found["pur"][:4] == ["Jaipur", "Kanpur", "Nagpur", "Raipur"]
    assert found["Mumbay"][0] == "Mumbai"
    assert found[""] == ["Agra", "Ahmedabad", "Amritsar", "Bengaluru", "Bhopal", "Bhubaneswar"]
