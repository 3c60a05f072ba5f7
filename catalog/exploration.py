"""Queries behind exploration charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.clusters import LABELLED_CTES, labelled
from catalog.common import (
    DAILY_COLUMNS,
    KEYS,
    NORMALIZED_CTES,
    big,
    normalized,
    query,
    r,
    raw,
    rounded,
    with_,
)
from catalog.daily import CLEAN_CTES
from catalog.learning import BOX_CTES, box_projection
from catalog.rollups import MONTH, PLACE, SEASON_SQL, SEASON_YEAR, YEAR
from gridclime.functions.lineage import materialize
from gridclime.operators import explore, normalize, profile, reduce
from gridclime.plans import flows
from gridclime.sources import projections as P

MAIN = [
    "temperature_2m_mean",
    "precipitation_sum",
    "relative_humidity_2m_mean",
    "wind_speed_10m_mean",
    "cloud_cover_mean",
    "shortwave_radiation_sum",
]
AVERAGES = ", ".join(f"AVG({c}) AS {c}" for c in MAIN)
DESCRIBED = ["mean", "std", "min", "max", "p1", "q25", "median", "q75", "p99", "iqr"]


def describe_sql(source: str, columns, extra: str = "") -> str:
    def one(c: str) -> str:
        q = lambda p: f"QUANTILE_CONT({c}, {p})"
        return (
            f"SELECT {extra}'{c}' AS \"column\", COUNT({c}) AS count, AVG({c}) AS mean, "
            f"STDDEV_SAMP({c}) AS std, MIN({c}) AS min, MAX({c}) AS max, {q(0.01)} AS p1, "
            f"{q(0.25)} AS q25, {q(0.5)} AS median, {q(0.75)} AS q75, {q(0.99)} AS p99, "
            f"{q(0.75)} - {q(0.25)} AS iqr FROM {source}"
        )

    return " UNION ALL ".join(one(c) for c in columns)


@query(
    "describe",
    rounded(
        with_(NORMALIZED_CTES, describe_sql("norm", DAILY_COLUMNS)), '"column"', DESCRIBED, ["count"]
    ),
)
def _(spark, sf_dir):
    return explore.describe(normalized(spark, sf_dir), DAILY_COLUMNS)


BINS = 30


@query(
    "histogram",
    with_(
        {
            **NORMALIZED_CTES,
            "span": "SELECT MIN(shortwave_radiation_sum) AS lo, MAX(shortwave_radiation_sum) AS hi "
            "FROM norm",
            "binned": "SELECT LEAST(FLOOR((shortwave_radiation_sum - lo)/((hi - lo)/30)), 29) AS bin "
            "FROM norm, span WHERE shortwave_radiation_sum IS NOT NULL",
            "counted": "SELECT bin, COUNT(*) AS n FROM binned GROUP BY bin",
        },
        f"SELECT {big('bin')}, {r('lo + bin*(hi - lo)/30', 'low')}, "
        f"{r('lo + (bin + 1)*(hi - lo)/30', 'high')}, {big('n', 'count')} FROM counted, span",
    ),
)
def _(spark, sf_dir):
    return explore.histogram(normalized(spark, sf_dir), "shortwave_radiation_sum", BINS)


def correlation_sql(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, CORR({a}, {b}) AS r FROM {source}"
        for i, a in enumerate(MAIN)
        for b in MAIN[i + 1 :]
    )


@query(
    "correlations", rounded(with_(NORMALIZED_CTES, correlation_sql("norm")), "a, b", ["r"])
)
def _(spark, sf_dir):
    return explore.correlations(normalized(spark, sf_dir), MAIN)


@query(
    "cluster_correlations",
    rounded(
        with_(
            {**LABELLED_CTES, "one": "SELECT * FROM lab WHERE cluster = 3"}, correlation_sql("one")
        ),
        "a, b",
        ["r"],
    ),
)
def _(spark, sf_dir):
    return explore.correlations(labelled(spark, sf_dir).filter("cluster = 3"), MAIN)


STRONG = ["nasa_temperature_2m", "nasa_dewpoint_2m", "nasa_earth_skin_temperature", "cloud_cover_mean"]


@query(
    "strong_pairs",
    rounded(
        with_(
            NORMALIZED_CTES,
            "SELECT * FROM ("
            + " UNION ALL ".join(
                f"SELECT '{a}' AS a, '{b}' AS b, CORR({a}, {b}) AS r FROM norm"
                for i, a in enumerate(STRONG)
                for b in STRONG[i + 1 :]
            )
            + ") c WHERE ABS(r) > 0.7",
        ),
        "a, b",
        ["r"],
    ),
)
def _(spark, sf_dir):
    return explore.strong_pairs(normalized(spark, sf_dir), STRONG)


@query(
    "means_by_month",
    rounded(
        with_(NORMALIZED_CTES, f"SELECT {MONTH} AS month, {AVERAGES} FROM norm GROUP BY {MONTH}"),
        "",
        MAIN,
        ["month"],
    ),
)
def _(spark, sf_dir):
    return explore.means_by_month(normalized(spark, sf_dir), MAIN)


@query(
    "means_by_place",
    rounded(
        with_(NORMALIZED_CTES, f"SELECT {PLACE}, {AVERAGES} FROM norm GROUP BY {PLACE}"), PLACE, MAIN
    ),
)
def _(spark, sf_dir):
    return explore.means_by_place(normalized(spark, sf_dir), MAIN)


SEASON = SEASON_SQL.format(m=MONTH)


@query(
    "means_by_season",
    rounded(
        with_(
            NORMALIZED_CTES, f"SELECT {SEASON} AS season, {AVERAGES} FROM norm GROUP BY {SEASON}"
        ),
        "season",
        MAIN,
    ),
)
def _(spark, sf_dir):
    return explore.means_by_season(normalized(spark, sf_dir), MAIN)


REGION = (
    "CASE WHEN latitude > 28 THEN 'North' WHEN latitude < 15 THEN 'South' "
    "WHEN longitude > 85 THEN 'East' WHEN longitude < 73 THEN 'West' ELSE 'Central' END"
)


@query(
    "means_by_region",
    rounded(
        with_(
            NORMALIZED_CTES, f"SELECT {REGION} AS region, {AVERAGES} FROM norm GROUP BY {REGION}"
        ),
        "region",
        MAIN,
    ),
)
def _(spark, sf_dir):
    return explore.means_by_region(normalized(spark, sf_dir), MAIN)


DRAW = (
    "MD5('42|' || CAST(latitude AS VARCHAR) || '|' || CAST(longitude AS VARCHAR) || '|' || "
    f"CAST(date AS VARCHAR)), {KEYS}"
)


@query(
    "sample_per_region",
    rounded(
        with_(
            {"raw": P.NASA_RAW},
            f"SELECT {KEYS}, {REGION} AS region, T2M FROM raw QUALIFY ROW_NUMBER() OVER "
            f"(PARTITION BY {REGION} ORDER BY {DRAW}) <= 5000",
        ),
        f"{KEYS}, region",
        ["T2M"],
    ),
)
def _(spark, sf_dir):
    rows = raw(spark, sf_dir).withColumn(
        "region", explore.compass_region(F.col("latitude"), F.col("longitude"))
    )
    columns = ["latitude", "longitude", "date", "region", "T2M"]
    picked = explore.sample_per_group(
        rows.select(*columns), "region", 5000, ["latitude", "longitude", "date"]
    )
    return picked


@query(
    "sample_region_sizes",
    with_(
        {"raw": P.NASA_RAW},
        f"SELECT {REGION} AS region, {big('LEAST(COUNT(*), 5000)', 'n')} FROM raw GROUP BY {REGION}",
    ),
)
def _(spark, sf_dir):
    rows = raw(spark, sf_dir).withColumn(
        "region", explore.compass_region(F.col("latitude"), F.col("longitude"))
    )
    picked = explore.sample_per_group(rows, "region", 5000, ["latitude", "longitude", "date"])
    return picked.groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sample_rows",
    rounded(
        with_({"raw": P.NASA_RAW}, f"SELECT {KEYS}, T2M FROM raw ORDER BY {DRAW} LIMIT 500"),
        KEYS,
        ["T2M"],
    ),
)
def _(spark, sf_dir):
    rows = raw(spark, sf_dir).select("latitude", "longitude", "date", "T2M")
    return explore.sample(rows, 500, ["latitude", "longitude", "date"])


@query(
    "yearly_trend",
    rounded(
        with_(
            {
                **NORMALIZED_CTES,
                "y": f"SELECT CAST({YEAR} AS DOUBLE) AS year, {AVERAGES} FROM norm GROUP BY {YEAR}",
            },
            " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", REGR_SLOPE({c}, year) AS slope, "
                f"REGR_INTERCEPT({c}, year) AS intercept FROM y"
                for c in MAIN
            ),
        ),
        '"column"',
        ["slope", "intercept"],
    ),
)
def _(spark, sf_dir):
    return explore.yearly_trend(normalized(spark, sf_dir), MAIN)


BOXED = ["temperature_2m_mean", "precipitation_sum", "wind_speed_10m_mean"]


@query(
    "box_statistics",
    rounded(
        with_(
            LABELLED_CTES,
            " UNION ALL ".join(
                f"SELECT cluster, '{c}' AS \"column\", COUNT({c}) AS count, AVG({c}) AS mean, "
                f"STDDEV_SAMP({c}) AS std, MIN({c}) AS min, MAX({c}) AS max, "
                f"QUANTILE_CONT({c}, 0.25) AS q25, QUANTILE_CONT({c}, 0.5) AS median, "
                f"QUANTILE_CONT({c}, 0.75) AS q75 FROM lab GROUP BY cluster"
                for c in BOXED
            ),
        ),
        '"column"',
        ["mean", "std", "min", "max", "q25", "median", "q75"],
        ["cluster", "count"],
    ),
)
def _(spark, sf_dir):
    return explore.box_statistics(labelled(spark, sf_dir), BOXED)


GENERIC = (
    "CASE WHEN cluster IS NULL THEN 'Unassigned' WHEN cluster < 0 THEN 'Noise/Outlier' "
    "ELSE 'Cluster ' || CAST(cluster AS VARCHAR) END"
)


@query(
    "label_shares",
    rounded(
        with_(
            LABELLED_CTES,
            f"SELECT {GENERIC} AS cluster_label, COUNT(*) AS count, "
            f"COUNT(*)*1.0E0/(SELECT COUNT(*) FROM lab) AS share FROM lab GROUP BY {GENERIC}",
        ),
        "cluster_label",
        ["share"],
        ["count"],
    ),
)
def _(spark, sf_dir):
    return explore.label_shares(explore.generic_labels(labelled(spark, sf_dir), "cluster"))


@query(
    "headline",
    with_(
        LABELLED_CTES,
        f"SELECT {big('COUNT(DISTINCT (latitude, longitude))', 'places')}, "
        f"{big('COUNT(DISTINCT cluster)', 'clusters')} FROM lab",
    ),
)
def _(spark, sf_dir):
    return explore.headline(labelled(spark, sf_dir))


PROFILED = {**LABELLED_CTES, "prof": f"SELECT cluster, {AVERAGES} FROM lab GROUP BY cluster"}


@query(
    "scaled_profile_zscore",
    rounded(
        with_(
            PROFILED,
            "SELECT cluster, "
            + ", ".join(f"({c} - AVG({c}) OVER ())/STDDEV_POP({c}) OVER () AS {c}" for c in MAIN)
            + " FROM prof",
        ),
        "",
        MAIN,
        ["cluster"],
    ),
)
def _(spark, sf_dir):
    means = profile.profile_summary(labelled(spark, sf_dir), MAIN)
    return explore.scaled_profile(means, MAIN, "zscore")


@query(
    "scaled_profile_minmax",
    rounded(
        with_(
            PROFILED,
            "SELECT cluster, "
            + ", ".join(
                f"({c} - MIN({c}) OVER ())/(MAX({c}) OVER () - MIN({c}) OVER ()) AS {c}"
                for c in MAIN
            )
            + " FROM prof",
        ),
        "",
        MAIN,
        ["cluster"],
    ),
)
def _(spark, sf_dir):
    means = profile.profile_summary(labelled(spark, sf_dir), MAIN)
    return explore.scaled_profile(means, MAIN, "minmax")


ELLIPSE = [
    "center_x",
    "center_y",
    "var_x",
    "var_y",
    "cov_xy",
    "radius_major",
    "radius_minor",
    "angle",
]


@query(
    "cluster_ellipses",
    rounded(
        with_(
            {
                **LABELLED_CTES,
                "s": "SELECT cluster, COUNT(*) AS n, AVG(temperature_2m_mean) AS center_x, "
                "AVG(precipitation_sum) AS center_y, VAR_SAMP(temperature_2m_mean) AS var_x, "
                "VAR_SAMP(precipitation_sum) AS var_y, "
                "COVAR_SAMP(temperature_2m_mean, precipitation_sum) AS cov_xy FROM lab GROUP BY cluster",
                "e": "SELECT *, (var_x + var_y)/2 AS half, "
                "SQRT(POWER((var_x - var_y)/2, 2) + cov_xy*cov_xy) AS root FROM s "
                "WHERE n >= 3 AND var_x*var_y - cov_xy*cov_xy > 0",
            },
            "SELECT *, 1.8E0*SQRT(GREATEST(half + root, 1E-9)) AS radius_major, "
            "1.8E0*SQRT(GREATEST(half - root, 1E-9)) AS radius_minor, "
            "ATAN2(2*cov_xy, var_x - var_y)/2 AS angle FROM e",
        ),
        "",
        ELLIPSE,
        ["cluster", "n"],
    ),
)
def _(spark, sf_dir):
    return explore.cluster_ellipses(
        labelled(spark, sf_dir), "temperature_2m_mean", "precipitation_sum"
    )


@query(
    "component_ellipses_of_a_pair",
    rounded(
        with_(
            {
                **BOX_CTES,
                "s": "SELECT cluster, COUNT(*) AS n, AVG(pc1) AS center_x, AVG(pc2) AS center_y, "
                "VAR_SAMP(pc1) AS var_x, VAR_SAMP(pc2) AS var_y, COVAR_SAMP(pc1, pc2) AS cov_xy "
                "FROM pcs GROUP BY cluster",
                "e": "SELECT *, (var_x + var_y)/2 AS half, "
                "SQRT(POWER((var_x - var_y)/2, 2) + cov_xy*cov_xy) AS root FROM s "
                "WHERE n >= 3 AND var_x*var_y - cov_xy*cov_xy > 0",
            },
            "SELECT *, 1.8E0*SQRT(GREATEST(half + root, 1E-9)) AS radius_major, "
            "1.8E0*SQRT(GREATEST(half - root, 1E-9)) AS radius_minor, "
            "ATAN2(2*cov_xy, var_x - var_y)/2 AS angle FROM e",
        ),
        "",
        ELLIPSE,
        ["cluster", "n"],
    ),
)
def _(spark, sf_dir):
    return explore.cluster_ellipses(
        reduce.projection_table(*box_projection(spark, sf_dir)), "pc1", "pc2"
    )


@query(
    "map_scaled",
    rounded(
        with_(
            LABELLED_CTES,
            f"SELECT {PLACE}, (temperature_2m_mean - MIN(temperature_2m_mean) OVER ())/"
            "(MAX(temperature_2m_mean) OVER () - MIN(temperature_2m_mean) OVER () + 1E-8) AS scaled "
            "FROM lab",
        ),
        PLACE,
        ["scaled"],
    ),
)
def _(spark, sf_dir):
    out = explore.map_scaled(labelled(spark, sf_dir), "temperature_2m_mean")
    return out.select("latitude", "longitude", "scaled")


@query(
    "generic_labels",
    with_(LABELLED_CTES, f"SELECT DISTINCT {big('cluster')}, {GENERIC} AS cluster_label FROM lab"),
)
def _(spark, sf_dir):
    return explore.label_map(explore.generic_labels(labelled(spark, sf_dir), "cluster"))


EXTENTS = [
    "latitude_mean",
    "latitude_min",
    "latitude_max",
    "longitude_mean",
    "longitude_min",
    "longitude_max",
    "coverage_pct",
]


@query(
    "cluster_extents",
    rounded(
        with_(
            LABELLED_CTES,
            "SELECT cluster, COUNT(*) AS points, AVG(latitude) AS latitude_mean, "
            "MIN(latitude) AS latitude_min, MAX(latitude) AS latitude_max, "
            "AVG(longitude) AS longitude_mean, MIN(longitude) AS longitude_min, "
            "MAX(longitude) AS longitude_max, "
            "COUNT(*)*100.0E0/(SELECT COUNT(*) FROM lab) AS coverage_pct FROM lab GROUP BY cluster",
        ),
        "",
        EXTENTS,
        ["cluster", "points"],
    ),
)
def _(spark, sf_dir):
    return explore.cluster_extents(labelled(spark, sf_dir))


@query(
    "compare_stages",
    rounded(
        with_(
            CLEAN_CTES,
            describe_sql("norm", MAIN, "'before' AS stage, ")
            + " UNION ALL "
            + describe_sql("cleaned", MAIN, "'after' AS stage, "),
        ),
        'stage, "column"',
        DESCRIBED,
        ["count"],
    ),
)
def _(spark, sf_dir):
    rows = materialize(raw(spark, sf_dir))  # aggregated once for both stages
    return explore.compare_stages(normalize.normalize(rows), flows.cleaned(rows), MAIN)


SERIES = {
    **NORMALIZED_CTES,
    "one": f"SELECT {KEYS}, temperature_2m_mean FROM norm WHERE latitude = 10.0 AND longitude = 82.0",
    "seasons": f"SELECT {PLACE}, {SEASON} AS season, {SEASON_YEAR} AS sy, "
    f"AVG(temperature_2m_mean) AS value FROM one GROUP BY {PLACE}, {SEASON}, {SEASON_YEAR}",
}


@query(
    "place_series",
    rounded(
        with_(
            SERIES,
            f"SELECT {PLACE}, 'daily' AS resolution, date AS start, temperature_2m_mean AS value FROM one "
            f"UNION ALL SELECT {PLACE}, 'monthly', CAST(DATE_TRUNC('month', date) AS DATE), "
            f"AVG(temperature_2m_mean) FROM one GROUP BY {PLACE}, DATE_TRUNC('month', date) "
            f"UNION ALL SELECT {PLACE}, 'yearly', CAST(DATE_TRUNC('year', date) AS DATE), "
            f"AVG(temperature_2m_mean) FROM one GROUP BY {PLACE}, DATE_TRUNC('year', date) "
            f"UNION ALL SELECT {PLACE}, 'seasonal', CASE season "
            "WHEN 'Winter' THEN MAKE_DATE(CAST(sy - 1 AS BIGINT), 12, 1) "
            "WHEN 'Pre-Monsoon' THEN MAKE_DATE(CAST(sy AS BIGINT), 3, 1) "
            "WHEN 'Monsoon' THEN MAKE_DATE(CAST(sy AS BIGINT), 6, 1) "
            "ELSE MAKE_DATE(CAST(sy AS BIGINT), 10, 1) END, value FROM seasons",
        ),
        f"{PLACE}, resolution, start",
        ["value"],
    ),
)
def _(spark, sf_dir):
    return explore.place_series(normalized(spark, sf_dir), 10.0, 82.0, "temperature_2m_mean")


FILLED = ["nasa_uv_index", *MAIN]


@query(
    "fill_rates",
    rounded(
        with_(
            NORMALIZED_CTES,
            "SELECT *, CASE WHEN filled_pct > 90 THEN 'good' WHEN filled_pct > 50 THEN 'partial' "
            "ELSE 'poor' END AS status FROM ("
            + " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", COUNT({c})*100.0E0/COUNT(*) AS filled_pct, "
                f"AVG({c}) AS mean FROM norm"
                for c in FILLED
            )
            + ") f",
        ),
        '"column", status',
        ["filled_pct", "mean"],
    ),
)
def _(spark, sf_dir):
    return explore.fill_rates(normalized(spark, sf_dir), FILLED)
