"""Queries on labelled rows: metrics, model choice, profiles, labels, insights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.common import OFFSET, big, query, r, rounded, with_
from catalog.rollups import NORMALS_ADDED, NORMALS_CTES, PLACE, VALUES, featured
from gridclime.functions.lineage import materialize
from gridclime.operators import insights, metrics, pairs, profile, rollup
from gridclime.registry import FRIENDLY_NAMES, REDUNDANT_RAW
from gridclime.sources import projections as P

_STORED: dict = {}


def stored(spark, sf_dir, name, build) -> DataFrame:
    """A stage table shared by the queries of one session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = materialize(build())
    return _STORED[key]


def labelled(spark, sf_dir) -> DataFrame:
    """Long-term normals of every place with a given cluster."""

    def build():
        normals = rollup.normals(featured(spark, sf_dir))
        return normals.join(P.view(spark, sf_dir, P.PLACE_LABELS), ["latitude", "longitude"])

    return stored(spark, sf_dir, "labelled", build)


LABELLED_CTES = {
    **NORMALS_CTES,
    "place_labels": P.PLACE_LABELS,
    "lab": f"SELECT normals.*, cluster FROM normals JOIN place_labels USING ({PLACE})",
}

# ------------------------------------------------------------------- metrics


def vectors(spark, sf_dir) -> DataFrame:
    P.register(spark, sf_dir)
    return spark.table("embeddings").select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("x"),
        (F.col("label") - 1).alias("cluster"),
    )


VEC = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label - 1 AS cluster FROM embeddings"
# Several labellings of the same vectors stand in for several models.
LABELLINGS = {
    "K-Means(k=6)": "label % 6",
    "K-Means(k=7)": "label % 7",
    "GMM(k=8)": "label % 8",
    "Hierarchical(Ward, k=3)": "label % 3",
    "DBSCAN": "label - 1",
}


def score_ctes(source: dict[str, str]) -> dict[str, str]:
    """Scores per model from a CTE ``models`` (algorithm, vec_id, x, cluster)."""
    return {
        **source,
        "valid": "SELECT * FROM models WHERE cluster >= 0",
        "counted": "SELECT algorithm, cluster, COUNT(*) AS n FROM valid GROUP BY algorithm, cluster",
        "sums": "SELECT i.algorithm, i.vec_id, i.cluster, j.cluster AS other, "
        "SUM(LIST_DISTANCE(i.x, j.x)) AS total FROM valid i JOIN valid j "
        "ON i.algorithm = j.algorithm GROUP BY i.algorithm, i.vec_id, i.cluster, j.cluster",
        "sides": "SELECT s.algorithm, vec_id, s.cluster, "
        "MAX(CASE WHEN s.other = s.cluster THEN c.n END) AS n, "
        "MAX(CASE WHEN s.other = s.cluster AND c.n > 1 THEN total/(c.n - 1) END) AS a, "
        "MIN(CASE WHEN s.other <> s.cluster THEN total/c.n END) AS b FROM sums s JOIN counted c "
        "ON s.algorithm = c.algorithm AND s.other = c.cluster GROUP BY s.algorithm, vec_id, s.cluster",
        "sil": "SELECT algorithm, vec_id, cluster, "
        "CASE WHEN n = 1 THEN 0 ELSE (b - a)/GREATEST(a, b) END AS silhouette FROM sides",
        "cells": "SELECT algorithm, vec_id, cluster, UNNEST(GENERATE_SERIES(1, LEN(x))) AS pos, "
        "UNNEST(x) AS v FROM valid",
        "middle": "SELECT algorithm, cluster, pos, AVG(v) AS m, COUNT(*) AS n FROM cells "
        "GROUP BY algorithm, cluster, pos",
        "grand": "SELECT algorithm, pos, AVG(v) AS m FROM cells GROUP BY algorithm, pos",
        "spread": "SELECT algorithm, cluster, AVG(d) AS s, SUM(d*d) AS ss FROM ("
        "SELECT c.algorithm, c.cluster, vec_id, SQRT(SUM((v - m)*(v - m))) AS d FROM cells c "
        "JOIN middle USING (algorithm, cluster, pos) GROUP BY c.algorithm, c.cluster, vec_id) q "
        "GROUP BY algorithm, cluster",
        "ch": "SELECT algorithm, (bss/(k - 1))/(wss/(n - k)) AS calinski_harabasz FROM ("
        "SELECT middle.algorithm, SUM(middle.n*(middle.m - grand.m)*(middle.m - grand.m)) AS bss "
        "FROM middle JOIN grand USING (algorithm, pos) GROUP BY middle.algorithm) b "
        "JOIN (SELECT algorithm, SUM(ss) AS wss FROM spread GROUP BY algorithm) w USING (algorithm) "
        "JOIN (SELECT algorithm, COUNT(*) AS k, SUM(n) AS n FROM counted GROUP BY algorithm) c "
        "USING (algorithm)",
        "gaps": "SELECT a.algorithm, a.cluster AS i, b.cluster AS j, "
        "SQRT(SUM((a.m - b.m)*(a.m - b.m))) AS d FROM middle a JOIN middle b "
        "ON a.algorithm = b.algorithm AND a.pos = b.pos AND a.cluster <> b.cluster "
        "GROUP BY a.algorithm, a.cluster, b.cluster",
        "db": "SELECT algorithm, AVG(worst) AS davies_bouldin FROM ("
        "SELECT g.algorithm, i, MAX((x.s + y.s)/d) AS worst FROM gaps g "
        "JOIN spread x ON x.algorithm = g.algorithm AND x.cluster = i "
        "JOIN spread y ON y.algorithm = g.algorithm AND y.cluster = j "
        "GROUP BY g.algorithm, i) q GROUP BY algorithm",
        "even": "SELECT algorithm, COUNT(*) AS n_clusters, "
        "1 - STDDEV_POP(n)/AVG(n) AS cluster_balance, MIN(n) AS min_cluster_size, "
        "MAX(n) AS max_cluster_size, AVG(n) AS mean_cluster_size, "
        "MIN(n)*1.0E0/SUM(n) AS min_cluster_share, MAX(n)*1.0E0/SUM(n) AS max_cluster_share "
        "FROM counted GROUP BY algorithm",
        "rows_": "SELECT algorithm, COUNT(*) AS n_samples, "
        "COUNT(CASE WHEN cluster < 0 THEN 1 END) AS n_noise FROM models GROUP BY algorithm",
        "scores": "SELECT even.algorithm, n_clusters, n_samples, n_noise, "
        "ROUND(n_noise*100.0E0/n_samples, 1) AS noise_pct, "
        "ROUND(silhouette, 4) AS silhouette, ROUND(calinski_harabasz, 2) AS calinski_harabasz, "
        "ROUND(davies_bouldin, 4) AS davies_bouldin, ROUND(cluster_balance, 4) AS cluster_balance, "
        "min_cluster_size, max_cluster_size, ROUND(mean_cluster_size, 1) AS mean_cluster_size, "
        "ROUND(min_cluster_share, 4) AS min_cluster_share, "
        "ROUND(max_cluster_share, 4) AS max_cluster_share "
        "FROM even JOIN rows_ USING (algorithm) JOIN (SELECT algorithm, AVG(silhouette) AS silhouette "
        "FROM sil GROUP BY algorithm) s USING (algorithm) JOIN ch USING (algorithm) "
        "JOIN db USING (algorithm)",
    }


ONE_MODEL = score_ctes(
    {"vec": VEC, "models": "SELECT 'DBSCAN' AS algorithm, vec_id, x, cluster FROM vec"}
)
MANY_MODELS = score_ctes(
    {
        "models": " UNION ALL ".join(
            f"SELECT '{name}' AS algorithm, vec_id, CAST(embedding AS DOUBLE[]) AS x, "
            f"{label} AS cluster FROM embeddings"
            for name, label in LABELLINGS.items()
        )
    }
)
SCORE_DOUBLES = [
    "noise_pct",
    "silhouette",
    "calinski_harabasz",
    "davies_bouldin",
    "cluster_balance",
    "mean_cluster_size",
    "min_cluster_share",
    "max_cluster_share",
]
SCORE_BIGS = ["n_clusters", "n_samples", "n_noise", "min_cluster_size", "max_cluster_size"]


def comparison(spark, sf_dir) -> DataFrame:
    def build():
        P.register(spark, sf_dir)
        columns = {name: f"m{i}" for i, name in enumerate(LABELLINGS)}
        rows = spark.table("embeddings").select(
            F.col("embedding").cast("array<double>").alias("x"),
            *[F.expr(LABELLINGS[name]).alias(c) for name, c in columns.items()],
        )
        return metrics.evaluate(rows, columns)

    return stored(spark, sf_dir, "comparison", build)


@query(
    "silhouette_rows",
    rounded(with_(ONE_MODEL, "SELECT * FROM sil"), "", ["silhouette"], ["vec_id", "cluster"]),
)
def _(spark, sf_dir):
    return metrics.silhouette_rows(vectors(spark, sf_dir)).select("vec_id", "cluster", "silhouette")


@query(
    "silhouette_squared",
    with_(
        {
            **ONE_MODEL,
            "sums": ONE_MODEL["sums"].replace(
                "SUM(LIST_DISTANCE(i.x, j.x))", "SUM(LIST_DISTANCE(i.x, j.x)*LIST_DISTANCE(i.x, j.x))"
            ),
        },
        f"SELECT {r('AVG(silhouette)', 'silhouette')} FROM sil",
    ),
)
def _(spark, sf_dir):
    score = metrics.silhouette_squared(vectors(spark, sf_dir))
    return spark.createDataFrame([(score,)], "silhouette double")


@query(
    "silhouette_by_cluster",
    rounded(
        with_(
            ONE_MODEL,
            "SELECT cluster, AVG(silhouette) AS mean, STDDEV_POP(silhouette) AS std, "
            "MIN(silhouette) AS min, COUNT(*) AS size FROM sil GROUP BY cluster",
        ),
        "",
        ["mean", "std", "min"],
        ["cluster", "size"],
    ),
)
def _(spark, sf_dir):
    return metrics.silhouette_by_cluster(vectors(spark, sf_dir))


@query(
    "calinski_harabasz", rounded(with_(ONE_MODEL, "SELECT * FROM ch"), "", ["calinski_harabasz"])
)
def _(spark, sf_dir):
    return metrics.calinski_harabasz(vectors(spark, sf_dir)).select("calinski_harabasz")


@query("davies_bouldin", rounded(with_(ONE_MODEL, "SELECT * FROM db"), "", ["davies_bouldin"]))
def _(spark, sf_dir):
    return metrics.davies_bouldin(vectors(spark, sf_dir)).select("davies_bouldin")


@query(
    "evaluate",
    rounded(with_(ONE_MODEL, "SELECT * FROM scores"), "algorithm", SCORE_DOUBLES, SCORE_BIGS),
)
def _(spark, sf_dir):
    return metrics.evaluate(vectors(spark, sf_dir), {"DBSCAN": "cluster"})


@query(
    "cluster_sizes",
    with_(
        {"vec": VEC},
        f"SELECT {big('cluster')}, {big('COUNT(*)', 'size')} FROM vec GROUP BY cluster",
    ),
)
def _(spark, sf_dir):
    return metrics.sizes(vectors(spark, sf_dir))


COMPOSITE = (
    "SELECT *, 0.4E0*silhouette + 0.3E0/(davies_bouldin + 0.01E0) + 0.3E0*cluster_balance "
    "AS composite_score FROM scores"
)


@query(
    "compare_models",
    rounded(
        with_(MANY_MODELS, COMPOSITE),
        "algorithm",
        [*SCORE_DOUBLES, "composite_score"],
        SCORE_BIGS,
    ),
)
def _(spark, sf_dir):
    return metrics.with_composite(comparison(spark, sf_dir))


@query(
    "best_by_composite",
    rounded(
        with_(MANY_MODELS, f"{COMPOSITE} ORDER BY composite_score DESC, algorithm LIMIT 1"),
        "algorithm",
        ["composite_score"],
        ["n_clusters"],
    ),
)
def _(spark, sf_dir):
    best = metrics.best_by_composite(comparison(spark, sf_dir))
    return best.select("algorithm", "composite_score", "n_clusters")


PREFIXED = "(" + " OR ".join(f"algorithm LIKE '{p}%'" for p in metrics.MODEL_PREFIXES) + ")"


@query(
    "choose_model",
    rounded(
        with_(
            MANY_MODELS,
            f"SELECT *, CASE WHEN {PREFIXED} AND n_clusters BETWEEN 6 AND 8 AND n_noise = 0 "
            f"AND max_cluster_share <= 0.45 THEN 1 WHEN {PREFIXED} AND n_clusters BETWEEN 6 AND 8 "
            f"AND n_noise = 0 AND max_cluster_share <= 0.55 THEN 2 WHEN {PREFIXED} AND n_clusters "
            "BETWEEN 5 AND 9 AND n_noise <= GREATEST(1, 0.05E0*(SELECT MAX(n_samples) FROM scores)) "
            f"AND max_cluster_share <= 0.60 THEN 3 WHEN {PREFIXED} THEN 4 ELSE 5 END AS tier "
            "FROM scores ORDER BY tier, max_cluster_share, silhouette DESC, cluster_balance DESC, "
            "davies_bouldin, calinski_harabasz DESC LIMIT 1",
        ),
        "algorithm",
        SCORE_DOUBLES,
        [*SCORE_BIGS, "tier"],
    ),
)
def _(spark, sf_dir):
    return metrics.choose_model(comparison(spark, sf_dir))


@query(
    "k_distance_rows",
    rounded(
        with_(
            {"vec": VEC},
            "SELECT vec_id, d AS k_distance FROM (SELECT i.vec_id, LIST_DISTANCE(i.x, j.x) AS d, "
            "ROW_NUMBER() OVER (PARTITION BY i.vec_id ORDER BY LIST_DISTANCE(i.x, j.x)) AS rn "
            "FROM vec i, vec j) q WHERE rn = 5",
        ),
        "",
        ["k_distance"],
        ["vec_id"],
    ),
)
def _(spark, sf_dir):
    return pairs.k_distance_rows(vectors(spark, sf_dir), 5).select("vec_id", "k_distance")


# ------------------------------------------------------------------ profiles

FEATURES = [c for c in [*VALUES, *NORMALS_ADDED] if c not in REDUNDANT_RAW]
STATS = {
    "mean": "AVG({0})",
    "std": "STDDEV_SAMP({0})",
    "min": "MIN({0})",
    "max": "MAX({0})",
}


@query(
    "cluster_profile",
    rounded(
        with_(
            LABELLED_CTES,
            "SELECT cluster, "
            + ", ".join(f"{e.format(c)} AS {c}_{s}" for c in FEATURES for s, e in STATS.items())
            + ", "
            + ", ".join(f"COUNT({c}) AS {c}_count" for c in FEATURES)
            + " FROM lab GROUP BY cluster",
        ),
        "",
        [f"{c}_{s}" for c in FEATURES for s in STATS],
        ["cluster", *[f"{c}_count" for c in FEATURES]],
    ),
)
def _(spark, sf_dir):
    return profile.profile(labelled(spark, sf_dir), FEATURES)


def summary_sql(columns) -> str:
    return (
        "SELECT cluster, "
        + ", ".join(f"AVG({c}) AS {c}" for c in columns)
        + ", COUNT(*) AS cluster_size, ROUND(COUNT(*)*100.0E0/(SELECT COUNT(*) FROM lab), 1) "
        "AS cluster_pct FROM lab GROUP BY cluster"
    )


@query(
    "profile_summary",
    rounded(
        with_(LABELLED_CTES, summary_sql(FEATURES)),
        "",
        [*FEATURES, "cluster_pct"],
        ["cluster", "cluster_size"],
    ),
)
def _(spark, sf_dir):
    return profile.profile_summary(labelled(spark, sf_dir), FEATURES)


AGRICULTURE_STARTS = [
    "temperature_2m", "dewpoint_2m", "relative_humidity_2m", "vapour_pressure_deficit",
    "precipitation", "rain", "showers", "snowfall", "pressure_msl", "surface_pressure",
    "cloud_cover", "wind_speed_10m", "wind_direction_10m", "et0_fao_evapotranspiration",
    "nasa_uv_index", "nasa_earth_skin_temperature", "nasa_specific_humidity", "nasa_cloud_amount",
]


def _domain_columns() -> list[str]:
    return [c for c in [*VALUES, *NORMALS_ADDED] if c.startswith(tuple(AGRICULTURE_STARTS))]


@query(
    "domain_profile",
    rounded(
        with_(LABELLED_CTES, summary_sql(_domain_columns())),
        "",
        [*_domain_columns(), "cluster_pct"],
        ["cluster", "cluster_size"],
    ),
)
def _(spark, sf_dir):
    return profile.domain_profile(labelled(spark, sf_dir), "agriculture")


def named(feature: str) -> str:
    return FRIENDLY_NAMES.get(feature, feature.replace("_", " "))


SENTENCES = {
    c: "CASE WHEN ABS(z) > 1.5 THEN 'much ' ELSE '' END || "
    + {
        "wind_shear_coefficient": "'stronger vertical wind change than the India sample average'",
        "solar_utilization_ratio": "'more reliable solar availability than average'",
        "solar_wind_complementarity": "CASE WHEN z > 0 THEN 'stronger' ELSE 'weaker' END || "
        "' solar-wind complementarity than average'",
        "wind_power_density_80m": "CASE WHEN z > 0 THEN 'higher' ELSE 'lower' END || "
        "' wind energy potential than average'",
        "wind_power_density_120m": "CASE WHEN z > 0 THEN 'higher' ELSE 'lower' END || "
        "' wind energy potential than average'",
        "wind_power_density_180m": "CASE WHEN z > 0 THEN 'higher' ELSE 'lower' END || "
        "' wind energy potential than average'",
    }.get(
        c,
        "CASE WHEN z > 0 THEN 'higher' ELSE 'lower' END || "
        f"' {named(c)} than the India sample average'",
    )
    for c in FEATURES
}


@query(
    "characteristics",
    with_(
        {
            **LABELLED_CTES,
            "overall": "SELECT "
            + ", ".join(f"AVG({c}) AS g_{c}, STDDEV_SAMP({c}) AS s_{c}" for c in FEATURES)
            + " FROM lab",
            "means_": "SELECT cluster, "
            + ", ".join(f"AVG({c}) AS {c}" for c in FEATURES)
            + " FROM lab GROUP BY cluster",
            "long_": " UNION ALL ".join(
                f"SELECT cluster, '{c}' AS feature, {i} AS pos, {c} AS cm, g_{c} AS g, "
                f"({c} - g_{c})/s_{c} AS z FROM means_, overall WHERE s_{c} > 1E-12*ABS(g_{c})"
                for i, c in enumerate(FEATURES)
            ),
        },
        "SELECT "
        + ", ".join(
            [
                big("cluster"),
                big(
                    "ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY ABS(ROUND(z, 2)) DESC, pos)",
                    "rank",
                ),
                "feature",
                r(f"ROUND(cm + {OFFSET:.8f}E0, 2)", "cluster_mean"),
                r(f"ROUND(g + {OFFSET:.8f}E0, 2)", "global_mean"),
                r("ROUND(z, 2)", "z_score"),
                "CASE WHEN ABS(z) > 1.5 THEN 'very ' ELSE '' END || "
                "CASE WHEN z > 0 THEN 'HIGH' ELSE 'LOW' END AS description",
                "CASE feature "
                + " ".join(f"WHEN '{c}' THEN {text}" for c, text in SENTENCES.items())
                + " END AS summary",
            ]
        )
        + " FROM long_ WHERE ABS(z) > 0.5",
    ),
)
def _(spark, sf_dir):
    found = profile.characteristics(labelled(spark, sf_dir), FEATURES)
    return found.withColumns({c: F.round(F.col(c) + OFFSET, 2) for c in ("cluster_mean", "global_mean")})


def class_case(column: str, edges, labels) -> str:
    whens = " ".join(f"WHEN {column} < {e} THEN '{n}'" for e, n in zip(edges, labels))
    return f"CASE WHEN {column} IS NULL THEN NULL {whens} ELSE '{labels[-1]}' END"


def cut_case(column: str, labels) -> str:
    low, high = (
        f"(SELECT QUANTILE_CONT({column}, {q}) FROM lab)" for q in (0.33, 0.66)
    )
    return (
        f"CASE WHEN {column}_m <= {low} THEN '{labels[0]}' WHEN {column}_m <= {high} "
        f"THEN '{labels[1]}' ELSE '{labels[2]}' END"
    )


LABEL_CTES = {
    **LABELLED_CTES,
    "cm": "SELECT cluster, AVG(latitude) AS lat_mean, AVG(longitude) AS lon_mean, "
    "AVG(temperature_2m_mean) AS t, AVG(precipitation_sum) AS p, "
    "AVG(relative_humidity_2m_mean) AS h, AVG(wind_speed_80m_mean) AS wind_speed_80m_mean_m, "
    "AVG(shortwave_radiation_sum) AS shortwave_radiation_sum_m FROM lab GROUP BY cluster",
    "words": "SELECT cluster, lat_mean, lon_mean, "
    + class_case("t", (10, 20, 28, 35), ("Cold", "Cool", "Moderate", "Warm", "Hot"))
    + " AS temperature_class, "
    + class_case("p", (2, 5, 10, 20), ("Arid", "Semi-Arid", "Moderate", "Wet", "Very Wet"))
    + " AS rain_class, "
    + class_case("h", (30, 50, 70, 85), ("Dry", "Comfortable", "Moderate", "Humid", "Very Humid"))
    + " AS humidity_class, "
    + cut_case("wind_speed_80m_mean", ("Calm", "Breezy", "Windy"))
    + " AS wind_class, "
    + cut_case("shortwave_radiation_sum", ("Low Solar", "Sunny", "High Solar"))
    + " AS solar_class FROM cm",
    "moist": "SELECT *, CASE WHEN rain_class IN ('Arid', 'Semi-Arid') OR humidity_class = 'Dry' "
    "THEN 'Dry' WHEN rain_class IN ('Wet', 'Very Wet') OR humidity_class IN ('Humid', 'Very Humid') "
    "THEN 'Humid' WHEN humidity_class = 'Comfortable' THEN 'Balanced' "
    "WHEN rain_class = 'Moderate' OR humidity_class = 'Moderate' THEN 'Moderate' "
    "ELSE COALESCE(humidity_class, rain_class) END AS moisture_class FROM words",
    "climate": "SELECT *, temperature_class || ' ' || moisture_class || ' ' || wind_class || ' ' || "
    "solar_class AS climate_label FROM moist",
    "named": "SELECT cluster, CASE WHEN cluster < 0 THEN 'Noise/Outlier' "
    "WHEN lat_mean >= 33.3 THEN 'Upper Himalayan Cold Pocket' "
    "WHEN lat_mean >= 31.5 THEN 'Western Himalayan Highlands' "
    "WHEN lat_mean >= 29 AND lon_mean <= 79.5 THEN 'Northwest Highland Transition' "
    "WHEN lon_mean >= 88 AND lat_mean >= 23 THEN 'Northeast Humid Belt' "
    "WHEN lon_mean <= 74.5 AND lat_mean >= 20 THEN 'Northwest Dry Plains' "
    "WHEN lon_mean >= 76 AND lon_mean <= 88.5 AND lat_mean >= 24 THEN 'Gangetic Alluvial Plains' "
    "WHEN lon_mean >= 81.5 AND lat_mean >= 18 AND lat_mean < 24.5 THEN 'East-Central Monsoon Corridor' "
    "WHEN lon_mean >= 73 AND lon_mean < 81.5 AND lat_mean >= 18 AND lat_mean < 24.5 "
    "THEN 'Central Inland Plateau' "
    "WHEN lat_mean < 18.5 AND lon_mean >= 76 THEN 'Southern Peninsular Belt' "
    "WHEN lat_mean < 19.5 AND lon_mean < 76 THEN 'Western Coastal South' "
    "WHEN lon_mean >= 82 AND lat_mean < 24 THEN 'Eastern Coastal Transition' "
    "ELSE climate_label END AS cluster_label FROM climate",
}


@query(
    "climate_classes",
    rounded(
        with_(LABEL_CTES, "SELECT * FROM climate"),
        "temperature_class, rain_class, humidity_class, wind_class, solar_class, moisture_class, "
        "climate_label",
        ["lat_mean", "lon_mean"],
        ["cluster"],
    ),
)
def _(spark, sf_dir):
    return profile.climate_classes(labelled(spark, sf_dir))


@query(
    "cluster_labels",
    with_(
        LABEL_CTES,
        f"SELECT {big('cluster')}, cluster_label, 'This location fits a ' || LOWER(cluster_label) "
        "|| ' climate pattern.' AS summary FROM named",
    ),
)
def _(spark, sf_dir):
    return profile.cluster_labels(labelled(spark, sf_dir))


@query(
    "attach_labels",
    with_(
        LABEL_CTES,
        f"SELECT {PLACE}, {big('l.cluster', 'cluster')}, "
        "COALESCE(cluster_label, 'Unassigned') AS cluster_label FROM lab l "
        "LEFT JOIN (SELECT * FROM named WHERE cluster <> 5) n ON l.cluster = n.cluster",
    ),
)
def _(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    known = profile.cluster_labels(rows).filter("cluster <> 5")
    return profile.attach_labels(rows.select("latitude", "longitude", "cluster"), known)


def askers(spark, sf_dir) -> DataFrame:
    """A query position per customer, off the grid, with a cluster to look in."""
    P.register(spark, sf_dir)
    return spark.sql(ASKERS)


ASKERS = (
    "SELECT c_custkey AS query_id, 8.0E0 + 0.02E0*(c_custkey*11 % 1450) + 0.003E0 AS latitude, "
    "68.0E0 + 0.02E0*(c_custkey*7 % 1470) + 0.007E0 AS longitude, "
    "CAST(c_custkey % 8 AS INT) AS cluster FROM customer"
)


@query(
    "nearest_examples",
    with_(
        {"askers": ASKERS, "place_labels": P.PLACE_LABELS},
        "SELECT "
        + ", ".join(
            [
                big("query_id"),
                big("rank"),
                r("latitude"),
                r("longitude"),
                r("ROUND(d, 4)", "distance_deg"),
            ]
        )
        + " FROM (SELECT query_id, l.latitude, l.longitude, "
        "SQRT((l.latitude - a.latitude)*(l.latitude - a.latitude) + "
        "(l.longitude - a.longitude)*(l.longitude - a.longitude)) AS d, ROW_NUMBER() OVER "
        "(PARTITION BY query_id ORDER BY (l.latitude - a.latitude)*(l.latitude - a.latitude) + "
        "(l.longitude - a.longitude)*(l.longitude - a.longitude), l.latitude, l.longitude) AS rank "
        "FROM askers a JOIN place_labels l ON a.cluster = l.cluster) q WHERE rank <= 3",
    ),
)
def _(spark, sf_dir):
    places = P.view(spark, sf_dir, P.PLACE_LABELS)
    return profile.nearest_examples(askers(spark, sf_dir), places, 3)


# ------------------------------------------------------------------ insights


def sector_ctes(columns, ranked=()) -> dict[str, str]:
    out = {
        **LABELLED_CTES,
        "m": "SELECT cluster, COUNT(*) AS points, "
        + ", ".join(f"ROUND(AVG({c}), 3) AS {c}_mean" for c in columns)
        + ", ROUND(1/(1 + GREATEST(AVG(temperature_2m_mean_interannual_std), 0)), 3) "
        "AS temperature_stability_mean, "
        "ROUND(1/(1 + GREATEST(AVG(precipitation_sum_interannual_std), 0)), 3) "
        "AS rainfall_reliability_mean FROM lab WHERE cluster >= 0 GROUP BY cluster",
    }
    if ranked:
        ranks = ", ".join(
            f"COALESCE(ROUND(CASE WHEN ABS(h_{c} - l_{c}) <= 1E-8 + 1E-5*ABS(l_{c}) THEN 0.5 "
            f"WHEN {c}_mean IS NULL THEN NULL ELSE LEAST(GREATEST(({c}_mean - l_{c})/"
            f"(h_{c} - l_{c}), 0), 1) END, 3), 0.5) AS k_{c}"
            for c in ranked
        )
        cuts = ", ".join(
            f"QUANTILE_CONT({c}, 0.1) AS l_{c}, QUANTILE_CONT({c}, 0.9) AS h_{c}" for c in ranked
        )
        out["k"] = f"SELECT m.*, {ranks} FROM m, (SELECT {cuts} FROM lab) q"
    return out


def z(c: str, default: float) -> str:
    return f"COALESCE(NULLIF({c}_mean, 0), {default}E0)"


def tags_sql(tests, otherwise: str) -> str:
    parts = ", ".join(f"CASE WHEN {t} THEN '{tag}' END" for tag, t in tests)
    return f"COALESCE(NULLIF(CONCAT_WS(', ', {parts}), ''), '{otherwise}')"


AGRI_COLUMNS = [
    "temperature_2m_mean",
    "growing_degree_days",
    "precipitation_sum",
    "relative_humidity_2m_mean",
    "shortwave_radiation_sum",
    "frost_risk",
    "heat_stress",
]
AGRI_SCORE = (
    f"0.22E0*(1 - LEAST(ABS({z('temperature_2m_mean', 25)} - 24)/14, 1)) + "
    f"0.22E0*k_precipitation_sum + 0.14E0*(1 - LEAST(ABS({z('relative_humidity_2m_mean', 60)} - 60)"
    "/35, 1)) + 0.10E0*k_shortwave_radiation_sum + 0.14E0*temperature_stability_mean "
    "+ 0.18E0*rainfall_reliability_mean - 0.10E0*frost_risk_mean - 0.10E0*heat_stress_mean"
)


@query(
    "agriculture_insights",
    rounded(
        with_(
            sector_ctes(AGRI_COLUMNS, ["precipitation_sum", "shortwave_radiation_sum"]),
            f"SELECT *, ROUND({AGRI_SCORE}, 3) AS agriculture_suitability_score, "
            + tags_sql(
                [
                    ("frost-exposed", "frost_risk_mean > 0.2"),
                    ("heat-stressed", "heat_stress_mean > 0.2"),
                    ("water-limited", "precipitation_sum_mean < 1.2"),
                    ("rain-supported", "precipitation_sum_mean > 2.5"),
                    ("humid-growing-zone", "relative_humidity_2m_mean_mean > 75"),
                ],
                "balanced-growing-conditions",
            )
            + " AS agriculture_summary, CASE WHEN frost_risk_mean > 0.2 THEN "
            "'Prefer cold-tolerant crops and short growing windows.' WHEN heat_stress_mean > 0.2 THEN "
            "'Prioritize heat-resilient varieties and irrigation support.' "
            "WHEN precipitation_sum_mean < 1.2 THEN "
            "'Suitable for drought-tolerant cropping with water management.' "
            "WHEN precipitation_sum_mean > 2.5 THEN "
            "'Good fit for rain-fed agriculture with drainage planning.' ELSE "
            "'Balanced conditions for diversified cropping and stable seasonal planning.' END "
            "AS agriculture_recommendation FROM k",
        ),
        "agriculture_summary, agriculture_recommendation",
        [
            *[f"{c}_mean" for c in AGRI_COLUMNS],
            "temperature_stability_mean",
            "rainfall_reliability_mean",
            "agriculture_suitability_score",
        ],
        ["cluster", "points"],
    ),
)
def _(spark, sf_dir):
    return insights.agriculture(labelled(spark, sf_dir))


ENERGY_COLUMNS = [
    "shortwave_radiation_sum",
    "wind_speed_120m_mean",
    "wind_power_density_120m",
    "solar_utilization_ratio",
    "solar_wind_complementarity",
    "cloud_cover_mean",
]
ENERGY_SCORE = (
    "0.30E0*k_shortwave_radiation_sum + 0.35E0*k_wind_power_density_120m + "
    "0.20E0*k_solar_utilization_ratio + "
    "0.15E0*LEAST(GREATEST((solar_wind_complementarity_mean + 1)/2, 0), 1)"
)
MIX = (
    "CASE WHEN shortwave_radiation_sum_mean >= 19 AND wind_power_density_120m_mean >= 1.8 "
    "THEN 'Hybrid Solar-Wind' WHEN shortwave_radiation_sum_mean >= 18.5 THEN 'Solar-Led' "
    "WHEN wind_power_density_120m_mean >= 1.8 THEN 'Wind-Led' ELSE 'Balanced Renewable' END"
)


@query(
    "energy_insights",
    rounded(
        with_(
            sector_ctes(
                ENERGY_COLUMNS,
                ["shortwave_radiation_sum", "wind_power_density_120m", "solar_utilization_ratio"],
            ),
            f"SELECT *, ROUND({ENERGY_SCORE}, 3) AS energy_potential_score, {MIX} AS resource_mix, "
            + tags_sql(
                [
                    ("solar-favored", "shortwave_radiation_sum_mean > 19"),
                    ("wind-favored", "wind_power_density_120m_mean > 1.8"),
                    ("hybrid-friendly", "solar_wind_complementarity_mean > -0.2"),
                ],
                "moderate-renewable-potential",
            )
            + f" AS energy_summary, CASE {MIX} WHEN 'Hybrid Solar-Wind' THEN "
            "'Strong candidate for hybrid renewable parks with storage integration.' "
            "WHEN 'Solar-Led' THEN "
            "'Best suited for utility-scale solar with cloud-aware generation planning.' "
            "WHEN 'Wind-Led' THEN "
            "'Best suited for elevated wind development and transmission planning.' ELSE "
            "'Moderate multi-source renewable potential with balanced deployment options.' END "
            "AS energy_recommendation FROM k",
        ),
        "resource_mix, energy_summary, energy_recommendation",
        [*[f"{c}_mean" for c in ENERGY_COLUMNS], "energy_potential_score"],
        ["cluster", "points"],
    ),
)
def _(spark, sf_dir):
    return insights.energy(labelled(spark, sf_dir))


DISASTER_COLUMNS = [
    "heavy_rain_flag",
    "extreme_rain_flag",
    "precipitation_sum",
    "precipitation_sum_interannual_std",
    "wind_speed_120m_mean",
    "wind_power_density_120m",
    "cloud_cover_mean_interannual_std",
    "relative_humidity_2m_mean",
    "solar_utilization_ratio",
]
HAZARD = {
    "rain": "precipitation_sum_mean + precipitation_sum_interannual_std_mean/100",
    "wind": "wind_power_density_120m_mean + wind_speed_120m_mean_mean/10",
    "dry": "GREATEST(solar_utilization_ratio_mean - 0.5, 0) + GREATEST(1.5 - precipitation_sum_mean, 0)",
}
DISASTER_SCORE = (
    "0.24E0*LEAST(precipitation_sum_mean/3, 1) + "
    "0.18E0*LEAST(precipitation_sum_interannual_std_mean/150, 1) + "
    "0.18E0*LEAST(wind_power_density_120m_mean/3, 1) + "
    "0.14E0*LEAST(cloud_cover_mean_interannual_std_mean/10, 1) + "
    "0.10E0*LEAST(relative_humidity_2m_mean_mean/100, 1) + "
    "0.16E0*LEAST(GREATEST(2*(solar_utilization_ratio_mean - 0.5), 0) + "
    "GREATEST((1.5 - precipitation_sum_mean)/1.5, 0), 1)"
)


@query(
    "disaster_insights",
    rounded(
        with_(
            {
                **sector_ctes(DISASTER_COLUMNS),
                "h": "SELECT *, CASE WHEN {rain} >= {wind} AND {rain} >= {dry} "
                "THEN 'Heavy Rain / Flooding' WHEN {wind} >= {dry} THEN 'High Wind Exposure' "
                "ELSE 'Dry Spell / Drought Stress' END AS dominant_hazard FROM m".format(
                    **{k: f"({v})" for k, v in HAZARD.items()}
                ),
            },
            f"SELECT *, ROUND({DISASTER_SCORE}, 3) AS disaster_risk_score, "
            + tags_sql(
                [
                    ("flood-prone", "precipitation_sum_mean > 2.5"),
                    ("storm-exposed", "wind_power_density_120m_mean > 1.8"),
                    ("dry-spell-sensitive", "solar_utilization_ratio_mean > 0.55"),
                ],
                "lower-observed-extreme-risk",
            )
            + " AS disaster_summary, CASE dominant_hazard WHEN 'Heavy Rain / Flooding' THEN "
            "'Prioritize drainage, runoff management, and flood-resilient infrastructure.' "
            "WHEN 'High Wind Exposure' THEN "
            "'Strengthen wind-resilient design standards and network reliability planning.' ELSE "
            "'Prioritize water security, reservoir planning, and drought monitoring.' END "
            "AS risk_recommendation FROM h",
        ),
        "dominant_hazard, disaster_summary, risk_recommendation",
        [*[f"{c}_mean" for c in DISASTER_COLUMNS], "disaster_risk_score"],
        ["cluster", "points"],
    ),
)
def _(spark, sf_dir):
    return insights.disaster(labelled(spark, sf_dir))


URBAN_COLUMNS = [
    "temperature_2m_mean",
    "relative_humidity_2m_mean",
    "wind_speed_10m_mean",
    "cloud_cover_mean",
    "shortwave_radiation_sum",
    "temperature_2m_mean_interannual_std",
]
T, H, V = z("temperature_2m_mean", 25), z("relative_humidity_2m_mean", 60), z("wind_speed_10m_mean", 3)
S, C = z("shortwave_radiation_sum", 18), z("cloud_cover_mean", 50)
URBAN_CTES = {
    **sector_ctes(URBAN_COLUMNS),
    "u": f"SELECT *, ROUND(GREATEST(({T} - 24)/4.5, 0) + GREATEST(({H} - 65)/20, 0), 3) "
    "AS thermal_stress_index_mean, "
    f"ROUND(0.45E0*(1 - LEAST(ABS({T} - 24)/12, 1)) + 0.35E0*(1 - LEAST(ABS({H} - 58)/35, 1)) + "
    f"0.20E0*(1 - LEAST(ABS({V} - 3)/4, 1)), 3) AS outdoor_comfort_score_mean, "
    f"ROUND(LEAST(GREATEST((GREATEST(({T} - 25)/8, 0) + GREATEST(({S} - 18)/5, 0) + "
    f"GREATEST((55 - {C})/40, 0) + GREATEST((3 - {V})/3, 0))/4, 0), 1), 3) "
    "AS heat_island_potential_mean FROM m",
}


@query(
    "urban_insights",
    rounded(
        with_(
            URBAN_CTES,
            "SELECT *, ROUND(4*outdoor_comfort_score_mean - GREATEST(thermal_stress_index_mean, 0) "
            "- 2*heat_island_potential_mean - CASE WHEN relative_humidity_2m_mean_mean > 75 "
            "THEN 0.5 ELSE 0 END, 3) AS urban_comfort_score, "
            + tags_sql(
                [
                    ("cooling-infrastructure-priority", "heat_island_potential_mean > 0.5"),
                    ("outdoor-friendly", "outdoor_comfort_score_mean > 0.6"),
                    ("thermal-discomfort-prone", "thermal_stress_index_mean > 2"),
                ],
                "moderate-urban-comfort",
            )
            + " AS urban_summary, CASE WHEN heat_island_potential_mean > 0.5 THEN "
            "'Prioritize shade, reflective materials, and urban cooling infrastructure.' "
            "WHEN outdoor_comfort_score_mean > 0.65 THEN "
            "'Suitable for public-space activation and walkable urban design.' "
            "WHEN thermal_stress_index_mean > 1.2 THEN "
            "'Focus on cooling corridors, ventilation, and heat-health planning.' ELSE "
            "'Moderate comfort profile; use mixed passive cooling and open-space strategies.' END "
            "AS urban_recommendation FROM u",
        ),
        "urban_summary, urban_recommendation",
        [
            *[f"{c}_mean" for c in URBAN_COLUMNS],
            "thermal_stress_index_mean",
            "outdoor_comfort_score_mean",
            "heat_island_potential_mean",
            "urban_comfort_score",
        ],
        ["cluster", "points"],
    ),
)
def _(spark, sf_dir):
    return insights.urban(labelled(spark, sf_dir))


TOP = {
    "agriculture": ("k", AGRI_SCORE),
    "energy": ("k", ENERGY_SCORE),
    "disaster": ("k", DISASTER_SCORE),
}
TOP_CTES = {
    **LABEL_CTES,
    **{
        name: body
        for name, body in sector_ctes(
            list(dict.fromkeys([*AGRI_COLUMNS, *ENERGY_COLUMNS, *DISASTER_COLUMNS, *URBAN_COLUMNS])),
            [
                "precipitation_sum",
                "shortwave_radiation_sum",
                "wind_power_density_120m",
                "solar_utilization_ratio",
            ],
        ).items()
    },
    "u": URBAN_CTES["u"],
    "ranked_": " UNION ALL ".join(
        f"SELECT '{sector}' AS sector, cluster, ROUND({score}, 3) AS score FROM {source}"
        for sector, (source, score) in TOP.items()
    )
    + " UNION ALL SELECT 'urban', cluster, ROUND(4*outdoor_comfort_score_mean - "
    "GREATEST(thermal_stress_index_mean, 0) - 2*heat_island_potential_mean - "
    "CASE WHEN relative_humidity_2m_mean_mean > 75 THEN 0.5 ELSE 0 END, 3) FROM u",
}


@query(
    "top_regions",
    rounded(
        with_(
            TOP_CTES,
            "SELECT sector, ranked_.cluster, cluster_label, score FROM ranked_ JOIN named "
            "USING (cluster) QUALIFY ROW_NUMBER() OVER "
            "(PARTITION BY sector ORDER BY score DESC, ranked_.cluster) = 1",
        ),
        "sector, cluster_label",
        ["score"],
        ["cluster"],
    ),
)
def _(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    return insights.top_regions(rows, profile.cluster_labels(rows))
