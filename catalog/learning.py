"""Queries that scale, reduce, cluster and assign."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce as fold

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.clusters import LABELLED_CTES, VEC, labelled, stored, vectors
from catalog.common import big, query, r, raw, rounded, with_
from catalog.rollups import NORMALS_ADDED, PLACE, VALUES
from gridclime.functions.lineage import stage_folder
from gridclime.operators import (
    assign,
    density,
    explore,
    hdbscan,
    models,
    profile,
    reduce,
    sweeps,
    ward,
)
from gridclime.plans import flows, regions
from gridclime.registry import KNOWN_PLACES, REDUNDANT_RAW
from gridclime.sources import projections as P

# ------------------------------------------------------------------- scaling

CHOSEN = [c for c in [*VALUES, *NORMALS_ADDED] if c not in REDUNDANT_RAW]
SCALED = CHOSEN


@query(
    "usable_features",
    with_(
        LABELLED_CTES,
        f"SELECT feature, {big('n')} FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS feature, COUNT({c}) AS n FROM lab" for c in CHOSEN)
        + ") f WHERE n > 0",
    ),
)
def _(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    names = reduce.usable_features(rows, reduce.feature_columns(rows))
    return rows.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "n")


FILLED = {
    **LABELLED_CTES,
    "medians": "SELECT " + ", ".join(f"QUANTILE_CONT({c}, 0.5) AS m_{c}" for c in SCALED) + " FROM lab",
    "filled": f"SELECT {PLACE}, "
    + ", ".join(f"COALESCE({c}, m_{c}, 0) AS {c}" for c in SCALED)
    + " FROM lab, medians",
}
# A spread of zero, or of rounding noise alone, counts as one.
SCALERS = {
    "standard": ("AVG({0})", "STDDEV_POP({0})"),
    "minmax": ("MIN({0})", "MAX({0}) - MIN({0})"),
    "robust": ("QUANTILE_CONT({0}, 0.5)", "QUANTILE_CONT({0}, 0.75) - QUANTILE_CONT({0}, 0.25)"),
}


def scaled_sql(method: str) -> str:
    center, spread = SCALERS[method]
    learned_ = ", ".join(
        f"{center.format(c)} AS c_{c}, {spread.format(c)} AS s_{c}" for c in SCALED
    )
    cells = ", ".join(
        f"({c} - c_{c})/CASE WHEN s_{c} > 1E-12*ABS(c_{c}) THEN s_{c} ELSE 1 END AS {c}" for c in SCALED
    )
    return with_(
        {**FILLED, "learned": f"SELECT {learned_} FROM filled"},
        f"SELECT {PLACE}, {cells} FROM filled, learned",
    )


for _method in SCALERS:

    def _build(spark, sf_dir, method=_method):
        rows = labelled(spark, sf_dir)
        scaling = reduce.fit_scaling(rows, SCALED, method)
        out = scaling.transform(rows)
        names = [F.col("scaled")[i].alias(c) for i, c in enumerate(scaling.features)]
        return out.select("latitude", "longitude", *names)

    query(f"scale_{_method}", rounded(scaled_sql(_method), PLACE, SCALED))(_build)


@query("scale_inverse", rounded(with_(FILLED, "SELECT * FROM filled"), PLACE, SCALED))
def _(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    scaling = reduce.fit_scaling(rows, SCALED)
    there = scaling.transform(rows).select("latitude", "longitude", "scaled")
    return scaling.inverse(there).drop("scaled")


def projected(spark, sf_dir):
    """Scaling, projection and stored rows of one session."""
    rows = labelled(spark, sf_dir)
    return regions.reduced(rows.drop("cluster"))


# Of two standardized features the components are known: their sum and their
# difference over √2, with shares (1 ± |r|)/2.
PAIR = ["temperature_2m_mean", "precipitation_sum"]
PAIR_CTES = {
    **LABELLED_CTES,
    "zed": f"SELECT {PLACE}, (temperature_2m_mean - AVG(temperature_2m_mean) OVER ())/"
    "(STDDEV_POP(temperature_2m_mean) OVER ()) AS a, (precipitation_sum - "
    "AVG(precipitation_sum) OVER ())/(STDDEV_POP(precipitation_sum) OVER ()) AS b FROM lab",
    "rho": "SELECT CORR(a, b) AS r FROM zed",
}


def pair_projection(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    scaling = reduce.fit_scaling(rows, PAIR)
    return rows, scaling, reduce.fit_projection(scaling.transform(rows), variance=2)


@query(
    "explained_variance_of_a_pair",
    with_(
        PAIR_CTES,
        f"SELECT {big('1', 'component')}, {r('(1 + ABS(r))/2', 'ratio')}, "
        f"{r('(1 + ABS(r))/2', 'cumulative')} FROM rho UNION ALL SELECT {big('2', 'component')}, "
        f"{r('(1 - ABS(r))/2', 'ratio')}, {r('1E0', 'cumulative')} FROM rho",
    ),
)
def _(spark, sf_dir):
    return reduce.explained_variance(spark, pair_projection(spark, sf_dir)[2])


@query(
    "projection_of_a_pair",
    rounded(
        with_(
            PAIR_CTES,
            f"SELECT {PLACE}, (a + SIGN(r)*b)/SQRT(2) AS pc1, (a - SIGN(r)*b)/SQRT(2) AS pc2 "
            "FROM zed, rho",
        ),
        PLACE,
        ["pc1", "pc2"],
    ),
)
def _(spark, sf_dir):
    rows, scaling, projection = pair_projection(spark, sf_dir)
    return reduce.projection_table(rows, scaling, projection).select(
        "latitude", "longitude", "pc1", "pc2"
    )


# Two features that are not standardized have components of unequal loadings:
# the eigenvectors of their covariance, in closed form.
BOX_CTES = {
    **LABELLED_CTES,
    "box": f"SELECT {PLACE}, cluster, "
    + ", ".join(
        f"({c} - MIN({c}) OVER ())/(MAX({c}) OVER () - MIN({c}) OVER ()) AS {n}"
        for c, n in zip(PAIR, "ab")
    )
    + " FROM lab",
    "cov": "SELECT VAR_SAMP(a) AS va, VAR_SAMP(b) AS vb, COVAR_SAMP(a, b) AS vab FROM box",
    "eigen": "SELECT component, (va + vb)/2 + side*SQRT((va - vb)*(va - vb)/4 + vab*vab) AS value, "
    "va, vb, vab FROM cov, (VALUES (1, 1), (2, -1)) AS t(component, side)",
    "raw_loadings": "SELECT component, value/(va + vb) AS ratio, vab/SQRT(vab*vab + (value - va)*(value - va)) AS u, "
    "(value - va)/SQRT(vab*vab + (value - va)*(value - va)) AS v FROM eigen",
    "signed_": "SELECT component, ratio, u*s AS u, v*s AS v FROM (SELECT *, "
    "CASE WHEN ABS(u) >= ABS(v) THEN SIGN(u) ELSE SIGN(v) END AS s FROM raw_loadings) q",
    "loadings": f"SELECT component, ratio, '{PAIR[0]}' AS feature, u AS loading FROM signed_ "
    f"UNION ALL SELECT component, ratio, '{PAIR[1]}', v FROM signed_",
    "pcs": f"SELECT {PLACE}, cluster, a*one.u + b*one.v AS pc1, a*two.u + b*two.v AS pc2 FROM box, "
    "(SELECT * FROM signed_ WHERE component = 1) one, (SELECT * FROM signed_ WHERE component = 2) two",
}


def box_projection(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    scaling = reduce.fit_scaling(rows, PAIR, "minmax")
    return rows, scaling, reduce.fit_projection(scaling.transform(rows), variance=2)


@query(
    "top_loadings_of_a_pair",
    with_(
        BOX_CTES,
        f"SELECT {big('component')}, {r('ratio')}, feature, {r('loading')}, "
        + big("ROW_NUMBER() OVER (PARTITION BY component ORDER BY ABS(loading) DESC, feature)", "rank")
        + " FROM loadings",
    ),
)
def _(spark, sf_dir):
    _, scaling, projection = box_projection(spark, sf_dir)
    return reduce.top_loadings(reduce.loadings(spark, projection, scaling.features))


@query(
    "feature_importance_of_a_pair",
    with_(
        {
            **BOX_CTES,
            "weights": "SELECT feature, SUM(ABS(loading)*ratio) AS w FROM loadings GROUP BY feature",
        },
        f"SELECT feature, {r('100*w/MAX(w) OVER ()', 'importance')} FROM weights",
    ),
)
def _(spark, sf_dir):
    _, scaling, projection = box_projection(spark, sf_dir)
    return reduce.importance(reduce.loadings(spark, projection, scaling.features))


@query(
    "projection_table_of_a_pair",
    rounded(with_(BOX_CTES, "SELECT * FROM pcs"), PLACE, ["pc1", "pc2"], ["cluster"]),
)
def _(spark, sf_dir):
    out = reduce.projection_table(*box_projection(spark, sf_dir))
    return out.select("latitude", "longitude", "cluster", "pc1", "pc2")


@query("explained_variance")
def _(spark, sf_dir):
    return reduce.explained_variance(spark, projected(spark, sf_dir)[1])


@query("top_loadings")
def _(spark, sf_dir):
    scaling, projection, _ = projected(spark, sf_dir)
    return reduce.top_loadings(reduce.loadings(spark, projection, scaling.features))


@query("feature_importance")
def _(spark, sf_dir):
    scaling, projection, _ = projected(spark, sf_dir)
    return reduce.importance(reduce.loadings(spark, projection, scaling.features))


@query("projection_table")
def _(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    scaling, projection, _ = regions.reduced(rows.drop("cluster"))
    out = reduce.projection_table(rows, scaling, projection)
    return out.select("latitude", "longitude", "cluster", *[c for c in out.columns if c.startswith("pc")])


@query("component_ellipses")
def _(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    scaling, projection, _ = regions.reduced(rows.drop("cluster"))
    return explore.cluster_ellipses(
        reduce.projection_table(rows, scaling, projection), "pc1", "pc2"
    )


# ---------------------------------------------------------------- clustering


def points(spark, sf_dir):
    """Embeddings in the components that hold 95 percent of their variance."""

    def build():
        rows = vectors(spark, sf_dir).drop("cluster").withColumnRenamed("x", "scaled")
        return reduce.fit_projection(rows).transform(rows).drop("scaled")

    return stored(spark, sf_dir, "points", build)


@query("kmeans")
def _(spark, sf_dir):
    rows = points(spark, sf_dir)
    return models.fit_kmeans(rows, 8).labels(rows).select("vec_id", "cluster")


@query("kmeans_sizes")
def _(spark, sf_dir):
    rows = points(spark, sf_dir)
    return models.fit_kmeans(rows, 8).labels(rows).groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size")
    )


@query("mixture_memberships")
def _(spark, sf_dir):
    rows = points(spark, sf_dir)
    fitted = models.fit_mixture(rows, 8)
    return models.memberships(fitted.labels(rows), fitted).select(
        "vec_id", "cluster", F.array_max("membership").alias("confidence"), "uncertainty"
    )


@query("information_by_k")
def _(spark, sf_dir):
    return sweeps.information_by_k(points(spark, sf_dir))


@query("elbow")
def _(spark, sf_dir):
    return sweeps.elbow(points(spark, sf_dir))


@query("silhouette_by_k")
def _(spark, sf_dir):
    return sweeps.silhouette_by_k(points(spark, sf_dir))


# Points in three groups far apart: every model has one right answer.
GROUPED = (
    "SELECT c_custkey, 100.0E0*(c_nationkey % 3) + (c_custkey % 97)/10.0E0 AS x1, "
    "60.0E0*(c_nationkey % 3) + CAST(c_acctbal AS DOUBLE)/1000.0E0 AS x2, "
    "CAST(c_nationkey % 3 AS BIGINT) AS part FROM customer"
)
GROUPED_CTES = {
    "grouped": GROUPED,
    "parts": "SELECT part, COUNT(*) AS n, MIN([x1, x2]) AS first, VAR_POP(x1) AS v1, "
    "VAR_POP(x2) AS v2, COVAR_POP(x1, x2) AS c12 FROM grouped GROUP BY part",
    "numbers": "SELECT *, ROW_NUMBER() OVER (ORDER BY n DESC, first) - 1 AS cluster FROM parts",
}


def grouped_points(spark, sf_dir):
    return P.view(spark, sf_dir, GROUPED).select("c_custkey", F.array("x1", "x2").alias("x"))


@query(
    "kmeans_of_groups",
    with_(
        GROUPED_CTES,
        f"SELECT {big('c_custkey')}, {big('cluster')} FROM grouped JOIN numbers USING (part)",
    ),
)
def _(spark, sf_dir):
    rows = grouped_points(spark, sf_dir)
    return models.fit_kmeans(rows, 3).labels(rows).select("c_custkey", "cluster")


@query(
    "inertia_of_groups",
    with_(GROUPED_CTES, f"SELECT {big('3', 'k')}, {r('SUM(n*(v1 + v2))', 'inertia')} FROM parts"),
)
def _(spark, sf_dir):
    return sweeps.elbow(grouped_points(spark, sf_dir), [3]).select("k", "inertia")


@query(
    "best_k_of_groups_squared",
    with_(GROUPED_CTES, f"SELECT {big('COUNT(*)', 'best')} FROM parts"),
)
def _(spark, sf_dir):
    table = sweeps.silhouette_by_k(grouped_points(spark, sf_dir), range(2, 7), 3, distance="squared")
    return spark.createDataFrame([(sweeps.best_k(table),)], "best int")


@query(
    "candidates_of_groups",
    with_(
        GROUPED_CTES,
        "SELECT CAST(COUNT(*) AS BIGINT) AS best, CAST(UNNEST([3, 5, 6, 7, 8]) AS BIGINT) AS k FROM parts",
    ),
)
def _(spark, sf_dir):
    rows = grouped_points(spark, sf_dir)
    best = sweeps.best_k(sweeps.silhouette_by_k(rows, range(2, 7), 3))
    ks = sweeps.candidate_ks(best, rows.count())
    return spark.createDataFrame([(best, k) for k in ks], "best int, k int")


@query(
    "mixture_of_groups",
    rounded(
        with_(
            GROUPED_CTES,
            "SELECT c_custkey, cluster, 1.0E0 AS confidence, 0.0E0 AS uncertainty "
            "FROM grouped JOIN numbers USING (part)",
        ),
        "",
        ["confidence", "uncertainty"],
        ["c_custkey", "cluster"],
    ),
)
def _(spark, sf_dir):
    rows = grouped_points(spark, sf_dir)
    fitted = models.fit_mixture(rows, 3)
    return models.memberships(fitted.labels(rows), fitted).select(
        "c_custkey", "cluster", F.array_max("membership").alias("confidence"), "uncertainty"
    )


# Each part's points have the likelihood of its own normal distribution; 17 parameters.
LIKELIHOOD = {
    **GROUPED_CTES,
    "total": "SELECT SUM(n) AS n FROM parts",
    "ll": "SELECT SUM(parts.n*(LN(parts.n*1.0E0/total.n) - LN(2*PI()) - LN(v1*v2 - c12*c12)/2 - 1)) AS ll, "
    "ANY_VALUE(total.n) AS n FROM parts, total",
}


@query(
    "information_of_groups",
    with_(
        LIKELIHOOD,
        f"SELECT {big('3', 'k')}, {r('-2*ll + 17*LN(n)', 'bic')}, {r('-2*ll + 34', 'aic')}, "
        "TRUE AS converged FROM ll",
    ),
)
def _(spark, sf_dir):
    return sweeps.information_by_k(grouped_points(spark, sf_dir), [3], 5)


@query(
    "assign_groups_by_mixture",
    with_(
        GROUPED_CTES,
        f"SELECT {big('c_custkey')}, {big('cluster')}, {r('1.0E0', 'confidence')} "
        "FROM grouped JOIN numbers USING (part)",
    ),
)
def _(spark, sf_dir):
    rows = grouped_points(spark, sf_dir)
    found = assign.assign_by_mixture(rows, models.fit_mixture(rows, 3))
    return found.select("c_custkey", "cluster", "confidence")


# Points in columns, with copies, gaps and stray rows, from the customers.
SPREAD = (
    "SELECT c_custkey, 10.0E0*c_nationkey AS x1, CAST(FLOOR(c_acctbal/50.0E0) AS DOUBLE) AS x2 "
    "FROM customer"
)
EPS, MIN_SAMPLES = 4.0, 6


def spread_points(spark, sf_dir):
    return P.view(spark, sf_dir, SPREAD).select("c_custkey", F.array("x1", "x2").alias("x"))


DBSCAN_CTES = {
    "rows_": SPREAD,
    "spots": "SELECT x1, x2, COUNT(*) AS w, ROW_NUMBER() OVER (ORDER BY x1, x2) AS id "
    "FROM rows_ GROUP BY x1, x2",
    "near": "SELECT a.id AS a, b.id AS b, b.w FROM spots a JOIN spots b "
    f"ON b.x1 BETWEEN a.x1 - {EPS} AND a.x1 + {EPS} AND b.x2 BETWEEN a.x2 - {EPS} AND a.x2 + {EPS} "
    f"AND SQRT((a.x1 - b.x1)*(a.x1 - b.x1) + (a.x2 - b.x2)*(a.x2 - b.x2)) <= {EPS}",
    "cores": f"SELECT a AS id FROM near GROUP BY a HAVING SUM(w) >= {MIN_SAMPLES}",
    "links": "SELECT a, b FROM near WHERE a IN (SELECT id FROM cores) AND b IN (SELECT id FROM cores)",
    "reached": "SELECT id, id AS root FROM cores UNION "
    "SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.id WHERE r.root < l.b OR r.root >= l.b",
    "core_parts": "SELECT id, MIN(root) AS part FROM reached GROUP BY id",
}


@query(
    "dbscan_core_rows",
    with_(
        {k: DBSCAN_CTES[k] for k in ("rows_", "spots", "near", "cores")},
        f"SELECT {big('c_custkey')}, s.id IN (SELECT id FROM cores) AS is_core, "
        "CASE WHEN EXISTS (SELECT 1 FROM near n JOIN cores c ON n.b = c.id WHERE n.a = s.id) "
        "THEN FALSE ELSE TRUE END AS is_noise FROM rows_ JOIN spots s USING (x1, x2)",
    ),
)
def _(spark, sf_dir):
    found = density.dbscan(spread_points(spark, sf_dir), EPS, MIN_SAMPLES)
    return found.select("c_custkey", "is_core", (F.col("cluster") < 0).alias("is_noise"))


@query(
    "dbscan_core_clusters",
    "WITH RECURSIVE "
    + ", ".join(f"{k} AS ({v})" for k, v in DBSCAN_CTES.items())
    + ", core_rows AS (SELECT p.part, s.x1, s.x2, s.w FROM core_parts p JOIN spots s USING (id)) "
    "SELECT CAST(SUM(w) AS BIGINT) AS core_rows, CAST(COUNT(*) AS BIGINT) AS core_spots, "
    + r("MIN(x1)", "x1_min")
    + ", "
    + r("MAX(x1)", "x1_max")
    + ", "
    + r("MIN(x2)", "x2_min")
    + ", "
    + r("MAX(x2)", "x2_max")
    + " FROM core_rows GROUP BY part",
)
def _(spark, sf_dir):
    found = density.dbscan(spread_points(spark, sf_dir), EPS, MIN_SAMPLES).filter("is_core")
    return found.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("core_rows"),
        F.count_distinct("x").alias("core_spots"),
        F.min(F.col("x")[0]).alias("x1_min"),
        F.max(F.col("x")[0]).alias("x1_max"),
        F.min(F.col("x")[1]).alias("x2_min"),
        F.max(F.col("x")[1]).alias("x2_max"),
    ).drop("cluster")


DBSCAN_LABELS = {
    # The smallest spot of a cluster's core is its part; a border spot joins the smallest part near it.
    "parts": "SELECT n.a AS id, MIN(p.part) AS part FROM near n JOIN core_parts p ON p.id = n.b "
    "WHERE n.a NOT IN (SELECT id FROM cores) GROUP BY n.a UNION ALL SELECT id, part FROM core_parts",
    "sizes": "SELECT part, SUM(s.w) AS n, MIN(s.id) AS first FROM parts p JOIN spots s ON s.id = p.id GROUP BY part",
    "numbers": "SELECT part, ROW_NUMBER() OVER (ORDER BY n DESC, first) - 1 AS number FROM sizes",
}


@query(
    "dbscan",
    "WITH RECURSIVE "
    + ", ".join(f"{k} AS ({v})" for k, v in (DBSCAN_CTES | DBSCAN_LABELS).items())
    + f" SELECT {big('c_custkey')}, CAST(COALESCE(number, -1) AS INT) AS cluster, "
    "s.id IN (SELECT id FROM cores) AS is_core FROM rows_ JOIN spots s USING (x1, x2) "
    "LEFT JOIN parts p ON p.id = s.id LEFT JOIN numbers m ON m.part = p.part",
)
def _(spark, sf_dir):
    found = density.dbscan(spread_points(spark, sf_dir), EPS, MIN_SAMPLES)
    return found.select("c_custkey", "cluster", "is_core")


@query("dbscan_noise")
def _(spark, sf_dir):
    rows = points(spark, sf_dir)
    return density.noise_share(density.dbscan(rows, sweeps.estimate_eps(rows), 5))


@query(
    "dbscan_noise_of_spread",
    with_(
        {k: DBSCAN_CTES[k] for k in ("rows_", "spots", "near", "cores")}
        | {
            "reach": "SELECT DISTINCT a FROM near WHERE b IN (SELECT id FROM cores)",
            "noise": "SELECT 100.0E0*SUM(CASE WHEN id NOT IN (SELECT a FROM reach) THEN w ELSE 0 END)/SUM(w) "
            "AS pct FROM spots",
        },
        f"SELECT {r('pct', 'noise_pct')}, pct > 30 AS is_high FROM noise",
    ),
)
def _(spark, sf_dir):
    return density.noise_share(density.dbscan(spread_points(spark, sf_dir), EPS, MIN_SAMPLES))


@query(
    "k_distance_quantile",
    with_(
        {
            "spots": SPREAD,
            "d": "SELECT a.c_custkey, SQRT((a.x1 - b.x1)*(a.x1 - b.x1) + "
            "(a.x2 - b.x2)*(a.x2 - b.x2)) AS d FROM spots a, spots b",
            "k": "SELECT c_custkey, d FROM d QUALIFY ROW_NUMBER() OVER "
            "(PARTITION BY c_custkey ORDER BY d) = 5",
        },
        f"SELECT {r('QUANTILE_CONT(d, 0.9)', 'eps')} FROM k",
    ),
)
def _(spark, sf_dir):
    return sweeps.k_distance_quantile(spread_points(spark, sf_dir), 5)


# ------------------------------------------- hierarchies and given mixtures

# Patches of customers, one per nation, of unlike density.
PATCH_SIZE, PATCH_SAMPLES = 10, 5
PATCHES = (
    "SELECT c_custkey, 20.0E0*(c_nationkey % 5) + CAST(c_acctbal AS DOUBLE)*(1 + c_nationkey % 3)/4000.0E0 AS x1, "
    "20.0E0*FLOOR(c_nationkey/5) + CAST((c_custkey*37) % 101 AS DOUBLE)/20.0E0 AS x2 FROM customer"
)

HDB = {
    "rows_": PATCHES,
    "spots": "SELECT x1, x2, COUNT(*) AS w, ROW_NUMBER() OVER (ORDER BY x1, x2) AS id FROM rows_ GROUP BY x1, x2",
    "gaps": "SELECT a.id AS a, b.id AS b, b.w, SQRT((a.x1 - b.x1)*(a.x1 - b.x1) + (a.x2 - b.x2)*(a.x2 - b.x2)) AS d FROM spots a, spots b",
    "cores": "SELECT a AS id, MIN(d) AS core FROM (SELECT a, d, SUM(w) OVER (PARTITION BY a ORDER BY d, b) AS n FROM gaps) q "
    f"WHERE n > {PATCH_SAMPLES} GROUP BY a",
    "reach": "SELECT a, b, GREATEST(d, p.core, q.core) AS r FROM gaps JOIN cores p ON p.id = a JOIN cores q ON q.id = b WHERE a <> b",
    # Prim's order: points by the reach at which they join those before.
    "prim": "SELECT CAST(2 AS BIGINT) AS pos, b AS id, r FROM reach WHERE a = 1 UNION ALL "
    "SELECT p.pos + 1, p.id, LEAST(p.r, e.r) FROM (SELECT *, FIRST_VALUE(id) OVER (ORDER BY r, id) AS m FROM prim) p "
    "JOIN reach e ON e.a = p.m AND e.b = p.id WHERE p.id <> p.m",
    "picks": "SELECT pos, id, r FROM prim QUALIFY ROW_NUMBER() OVER (PARTITION BY pos ORDER BY r, id) = 1 "
    "UNION ALL SELECT 1, 1, 'infinity'::DOUBLE",
    "line": "SELECT pos, p.id, r, w, core, LEAST(r, LEAD(r, 1, 'infinity'::DOUBLE) OVER (ORDER BY pos)) AS joins "
    "FROM picks p JOIN spots USING (id) JOIN cores USING (id)",
    # A component at a reach is a run of that order between larger reaches.
    "runs": "SELECT DISTINCT i.r AS d, (SELECT MAX(j.pos) FROM line j WHERE j.pos < i.pos AND j.r > i.r) AS lo, "
    "COALESCE((SELECT MIN(j.pos) FROM line j WHERE j.pos > i.pos AND j.r > i.r), (SELECT MAX(pos) + 1 FROM line)) AS hi "
    "FROM line i WHERE i.pos > 1 UNION ALL SELECT core, pos, pos + 1 FROM line WHERE w > 1 AND core < joins",
    "large": "SELECT d, lo, hi, SUM(w) AS n FROM runs JOIN line ON pos >= lo AND pos < hi GROUP BY d, lo, hi "
    f"HAVING SUM(w) >= {PATCH_SIZE}",
    "ups": "SELECT c.d, c.lo, c.hi, c.n, ARG_MIN({'d': p.d, 'lo': p.lo, 'hi': p.hi}, p.d) AS up FROM large c "
    "LEFT JOIN large p ON p.d > c.d AND p.lo <= c.lo AND p.hi >= c.hi GROUP BY c.d, c.lo, c.hi, c.n",
    "tops": "SELECT *, ROW_NUMBER() OVER (ORDER BY d DESC, lo) AS top FROM (SELECT *, COUNT(*) OVER (PARTITION BY up) AS kin FROM ups) q "
    "WHERE up IS NULL OR kin > 1",
    "least": "SELECT MIN(r) AS least FROM reach WHERE r > 0",
    "owned": "SELECT c.d, c.lo, c.hi, ARG_MIN(t.top, t.d) AS top FROM large c JOIN tops t ON t.d >= c.d AND t.lo <= c.lo AND t.hi >= c.hi "
    "GROUP BY c.d, c.lo, c.hi",
    "clusters": "SELECT t.top, t.n, o.top AS above, CASE WHEN up IS NULL THEN 0 ELSE 1/GREATEST(t.up.d, least) END AS birth "
    "FROM tops t CROSS JOIN least LEFT JOIN owned o ON o.d = t.up.d AND o.lo = t.up.lo AND o.hi = t.up.hi",
    "leaves": "SELECT l.id, l.w, o.top, 1/GREATEST(o.d, least) AS fall FROM line l CROSS JOIN least JOIN owned o "
    "ON l.pos >= o.lo AND l.pos < o.hi QUALIFY ROW_NUMBER() OVER (PARTITION BY l.id ORDER BY o.d) = 1",
    "losses": "SELECT top, w, fall FROM leaves UNION ALL SELECT above, n, birth FROM clusters WHERE above IS NOT NULL",
    "masses": "SELECT c.top, c.above, SUM(w*(fall - birth)) AS mass, MAX(fall) AS death FROM clusters c JOIN losses l USING (top) "
    "GROUP BY c.top, c.above",
    "kids": "SELECT above AS top, COUNT(*) AS kids FROM clusters WHERE above IS NOT NULL GROUP BY above",
    "rising": "SELECT 0 AS round, m.top, above, mass, death, COALESCE(kids, 0) AS kids, CAST(NULL AS DOUBLE) AS best, "
    "CAST(NULL AS DOUBLE) AS below, death AS deepest FROM masses m LEFT JOIN kids USING (top) UNION ALL "
    "SELECT round + 1, u.top, u.above, u.mass, u.death, u.kids, "
    "COALESCE(u.best, CASE WHEN u.kids = COALESCE(k.n, 0) THEN GREATEST(u.mass, COALESCE(k.s, 0)) END), "
    "COALESCE(k.s, 0), GREATEST(u.deepest, COALESCE(k.deep, 0)) FROM rising u LEFT JOIN "
    "(SELECT above AS top, SUM(best) AS s, COUNT(best) AS n, MAX(deepest) AS deep FROM rising WHERE above IS NOT NULL GROUP BY above) k "
    "ON k.top = u.top WHERE round < 40",
    "settled": "SELECT r.*, mass >= below AND above IS NOT NULL AS stable FROM rising r WHERE round = 40",
    "chosen": "SELECT t.top, ARG_MAX(s.top, u.d) FILTER (WHERE s.stable) AS chosen FROM tops t JOIN tops u "
    "ON u.d >= t.d AND u.lo <= t.lo AND u.hi >= t.hi JOIN settled s ON s.top = u.top GROUP BY t.top",
    "marked": "SELECT l.id, l.w, c.chosen, CASE WHEN c.chosen IS NULL THEN 0 ELSE LEAST(fall, s.death)/s.death END AS probability, "
    "1 - fall/o.deepest AS outlier_score FROM leaves l JOIN chosen c USING (top) JOIN settled o ON o.top = l.top "
    "LEFT JOIN settled s ON s.top = c.chosen",
    "numbers": "SELECT chosen, ROW_NUMBER() OVER (ORDER BY SUM(w) DESC, MIN(id)) - 1 AS number FROM marked WHERE chosen IS NOT NULL GROUP BY chosen",
}
STORED_CTES = ("gaps", "reach", "line", "large", "leaves", "owned", "tops", "settled")


@query(
    "hdbscan",
    "WITH RECURSIVE "
    + ", ".join(f"{k} AS {'MATERIALIZED ' if k in STORED_CTES else ''}({v})" for k, v in HDB.items())
    + f" SELECT {big('c_custkey')}, {big('COALESCE(number, -1)', 'cluster')}, {r('probability')}, {r('outlier_score')} "
    "FROM rows_ JOIN spots USING (x1, x2) JOIN marked USING (id) LEFT JOIN numbers USING (chosen)",
)
def _(spark, sf_dir):
    rows = P.view(spark, sf_dir, PATCHES).select("c_custkey", F.array("x1", "x2").alias("x"))
    return hdbscan.hdbscan(rows, PATCH_SIZE, PATCH_SAMPLES).select("c_custkey", "cluster", "probability", "outlier_score")


@query("hdbscan_of_vectors")
def _(spark, sf_dir):
    """All embeddings; sizes of clusters and of noise, with the mean probability."""
    rows = points(spark, sf_dir)
    found = hdbscan.hdbscan(rows, max(10, rows.count() // 50), 5)
    return found.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.avg("probability").alias("probability"))


# Suppliers on a plane; no two pairs of clusters are equally far apart.
SITES = (
    "SELECT s_suppkey, CAST(s_acctbal AS DOUBLE)/1000.0E0 AS x1, "
    "CAST((s_suppkey*37) % 101 AS DOUBLE)/9.0E0 + 8.0E0*(s_nationkey % 3) AS x2 FROM supplier"
)
WARD = {
    "sites": SITES,
    "spots": "SELECT x1, x2, COUNT(*) AS w, ROW_NUMBER() OVER (ORDER BY x1, x2) AS id FROM sites GROUP BY x1, x2",
    # The nearest two of all clusters merge, one pair a step; the smaller id names the new cluster.
    "state": "SELECT 0 AS step, id, x1, x2, w*1.0E0 AS n, 0.0E0 AS height, CAST(0 AS BIGINT) AS other FROM spots UNION ALL "
    "SELECT p.step + 1, p.id, CASE WHEN p.id = m.a THEN m.x1 ELSE p.x1 END, CASE WHEN p.id = m.a THEN m.x2 ELSE p.x2 END, "
    "CASE WHEN p.id = m.a THEN m.n ELSE p.n END, CASE WHEN p.id = m.a THEN m.d ELSE 0 END, CASE WHEN p.id = m.a THEN m.b ELSE 0 END FROM state p, "
    "(SELECT a.id AS a, b.id AS b, a.n + b.n AS n, (a.n*a.x1 + b.n*b.x1)/(a.n + b.n) AS x1, (a.n*a.x2 + b.n*b.x2)/(a.n + b.n) AS x2, "
    "SQRT(2*a.n*b.n/(a.n + b.n)*((a.x1 - b.x1)*(a.x1 - b.x1) + (a.x2 - b.x2)*(a.x2 - b.x2))) AS d FROM state a JOIN state b ON a.id < b.id "
    "ORDER BY d, a.id, b.id LIMIT 1) m WHERE p.id <> m.b",
}
# Each spot's cluster after each step: the id that names it, followed from merge to merge.
WARD_CUT = {
    **WARD,
    "merges": "SELECT step, id AS a, other AS b FROM state WHERE other > 0",
    "last_step": "SELECT MAX(step) AS last FROM state",
    "named": "SELECT 0 AS step, id, id AS name FROM spots UNION ALL "
    "SELECT n.step + 1, n.id, COALESCE(m.a, n.name) FROM named n JOIN last_step ON n.step < last "
    "LEFT JOIN merges m ON m.step = n.step + 1 AND m.b = n.name",
    "cut": "SELECT k, id, name FROM named, last_step, (VALUES (3), (6), (8)) AS t(k) WHERE step = GREATEST(last + 1 - k, 0)",
    "numbers": "SELECT k, name, ROW_NUMBER() OVER (PARTITION BY k ORDER BY SUM(w) DESC, MIN(id)) - 1 AS cluster "
    "FROM cut JOIN spots USING (id) GROUP BY k, name",
}


def sites(spark, sf_dir):
    return P.view(spark, sf_dir, SITES).select("s_suppkey", F.array("x1", "x2").alias("x"))


def recursive(ctes: dict[str, str], final: str) -> str:
    return "WITH RECURSIVE " + ", ".join(f"{k} AS ({v})" for k, v in ctes.items()) + " " + final


@query(
    "ward_merges",
    recursive(WARD, f"SELECT {r('height')}, {big('n', 'size')} FROM state WHERE other > 0"),
)
def _(spark, sf_dir):
    return ward.fit_ward(sites(spark, sf_dir))[1].select("height", "size")


@query(
    "ward_clusters",
    recursive(
        WARD_CUT,
        f"SELECT {big('s_suppkey')}, {big('k')}, {big('cluster')} FROM sites JOIN spots USING (x1, x2) "
        "JOIN cut USING (id) JOIN numbers USING (k, name)",
    ),
)
def _(spark, sf_dir):
    found = ward.ward_each(sites(spark, sf_dir), (3, 6, 8), ("k3", "k6", "k8"))
    cells = [F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("cluster")) for k in (3, 6, 8)]
    return found.select("s_suppkey", F.inline(F.array(*cells)))


@query("ward_of_vectors")
def _(spark, sf_dir):
    """All embeddings in eight clusters: their sizes."""
    return ward.ward(points(spark, sf_dir), 8).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


# Three parts that overlap; the mixture with their shares, means and covariances.
OVERLAP = (
    "SELECT c_custkey, c_nationkey % 3 AS part, 2.0E0*(c_nationkey % 3) + CAST(c_acctbal AS DOUBLE)/3000.0E0 AS x1, "
    "CAST((c_custkey*37) % 101 AS DOUBLE)/25.0E0 + (c_nationkey % 3) AS x2 FROM customer"
)
GIVEN = {
    "rows_": OVERLAP,
    "parts": f"SELECT part, COUNT(*) AS n, AVG(x1) AS m1, AVG(x2) AS m2, VAR_POP(x1) + {models.FLOOR} AS v1, "
    f"VAR_POP(x2) + {models.FLOOR} AS v2, COVAR_POP(x1, x2) AS c FROM rows_ GROUP BY part",
    "total": "SELECT SUM(n)*1.0E0 AS total FROM parts",
    "logs": "SELECT c_custkey, x1, x2, p.part, LN(n/total) - LN(2*PI()) - LN(v1*v2 - c*c)/2 "
    "- (v2*(x1 - m1)*(x1 - m1) - 2*c*(x1 - m1)*(x2 - m2) + v1*(x2 - m2)*(x2 - m2))/(2*(v1*v2 - c*c)) AS l "
    "FROM rows_, parts p, total",
    "tops": "SELECT c_custkey, MAX(l) AS top FROM logs GROUP BY c_custkey",
    "sums": "SELECT c_custkey, top + LN(SUM(EXP(l - top))) AS ll FROM logs JOIN tops USING (c_custkey) GROUP BY c_custkey, top",
    "near": "SELECT c_custkey, x1, x2, part, EXP(l - ll) AS p FROM logs JOIN sums USING (c_custkey)",
}


def overlapping(spark, sf_dir):
    rows = P.view(spark, sf_dir, OVERLAP).select("c_custkey", F.col("part").alias("cluster"), F.array("x1", "x2").alias("x"))
    return rows, models.mixture_of_labels(rows)


@query(
    "memberships_of_parts",
    with_(
        GIVEN
        | {
            "ranked": "SELECT c_custkey, part, p, LEAD(p) OVER w AS second, ROW_NUMBER() OVER w AS rn FROM near "
            "WINDOW w AS (PARTITION BY c_custkey ORDER BY p DESC)"
        },
        f"SELECT {big('c_custkey')}, {big('part', 'cluster')}, {r('p', 'confidence')}, {r('1 - (p - second)', 'uncertainty')} "
        "FROM ranked WHERE rn = 1",
    ),
)
def _(spark, sf_dir):
    rows, mixture = overlapping(spark, sf_dir)
    return models.memberships(mixture.labels(rows), mixture).select(
        "c_custkey", "cluster", F.array_max("membership").alias("confidence"), "uncertainty"
    )


@query(
    "information_of_parts",
    with_(
        GIVEN | {"whole": "SELECT SUM(ll) AS ll, COUNT(*) AS n FROM sums"},
        f"SELECT {r('-2*ll + 17*LN(n)', 'bic')}, {r('-2*ll + 34', 'aic')}, {r('ll/n', 'mean_log_likelihood')} FROM whole",
    ),
)
def _(spark, sf_dir):
    rows, mixture = overlapping(spark, sf_dir)
    found = models.information(replace(mixture, cost=-models.log_likelihood(rows, mixture)), rows.count())
    kept = ["bic", "aic", "mean_log_likelihood"]
    return spark.createDataFrame([tuple(found[c] for c in kept)], ", ".join(f"{c} double" for c in kept))


@query(
    "mixture_step_of_parts",
    with_(
        GIVEN | {"moved": "SELECT part, SUM(p) AS w, SUM(p*x1)/SUM(p) AS m1, SUM(p*x2)/SUM(p) AS m2 FROM near GROUP BY part"},
        f"SELECT {big('part', 'cluster')}, {r('MIN(w)/MIN(total)', 'share')}, {r('MIN(m.m1)', 'm1')}, {r('MIN(m.m2)', 'm2')}, "
        f"{r(f'SUM(p*(x1 - m.m1)*(x1 - m.m1))/SUM(p) + {models.FLOOR}', 'v1')}, "
        f"{r(f'SUM(p*(x2 - m.m2)*(x2 - m.m2))/SUM(p) + {models.FLOOR}', 'v2')}, "
        f"{r('SUM(p*(x1 - m.m1)*(x2 - m.m2))/SUM(p)', 'c')} FROM near JOIN moved m USING (part), total GROUP BY part",
    ),
)
def _(spark, sf_dir):
    """One step of the fit from given parameters."""
    rows, mixture = overlapping(spark, sf_dir)
    step = models.next_mixture(rows, mixture)
    found = [
        (i, step.shares[i], *step.means[i], step.covariances[i][0][0], step.covariances[i][1][1], step.covariances[i][0][1])
        for i in range(len(step.shares))
    ]
    return spark.createDataFrame(found, "cluster int, share double, m1 double, m2 double, v1 double, v2 double, c double")


@query(
    "kmeans_step_by_k",
    with_(
        {
            "rows_": OVERLAP,
            "starts": "SELECT k, c_custkey % k AS c, AVG(x1) AS m1, AVG(x2) AS m2 FROM rows_, (VALUES (2), (3), (5)) AS t(k) GROUP BY k, c_custkey % k",
            "near": "SELECT k, c, x1, x2, (x1 - m1)*(x1 - m1) + (x2 - m2)*(x2 - m2) AS d FROM rows_, starts "
            "QUALIFY ROW_NUMBER() OVER (PARTITION BY k, c_custkey ORDER BY (x1 - m1)*(x1 - m1) + (x2 - m2)*(x2 - m2), c) = 1",
        },
        f"SELECT {big('k')}, {big('c', 'cluster')}, {big('COUNT(*)', 'size')}, {r('AVG(x1)', 'm1')}, {r('AVG(x2)', 'm2')}, "
        f"{r('SUM(SUM(d)) OVER (PARTITION BY k)', 'inertia')} FROM near GROUP BY k, c",
    ),
)
def _(spark, sf_dir):
    """Nearest centers, next centers and inertia of several k, from given centers, in one scan."""
    rows = P.view(spark, sf_dir, OVERLAP).select("c_custkey", F.array("x1", "x2").alias("x"))
    starts = {}
    for k in (2, 3, 5):
        grouped = rows.groupBy((F.col("c_custkey") % k).alias("c")).agg(F.avg(F.col("x")[0]).alias("a"), F.avg(F.col("x")[1]).alias("b"))
        starts[k] = [[r["a"], r["b"]] for r in grouped.orderBy("c").collect()]
    found = [
        (k, c, size, *center, inertia)
        for k, (inertia, sizes, centers) in models.next_centers(rows, starts).items()
        for c, (size, center) in enumerate(zip(sizes, centers, strict=True))
        if size
    ]
    return spark.createDataFrame(found, "k int, cluster int, size long, m1 double, m2 double, inertia double")


# Four parts at distances that grow by a factor: for every k the best clusters are known.
SCALES = (
    "SELECT c_custkey, c_nationkey % 4 AS part, CASE c_nationkey % 4 WHEN 0 THEN 0.0E0 WHEN 1 THEN 10.0E0 WHEN 2 THEN 200.0E0 "
    "ELSE 4000.0E0 END + CAST((c_custkey*37) % 101 AS DOUBLE)/101.0E0 AS x1 FROM customer"
)


@query(
    "elbow_of_scales",
    with_(
        {
            "rows_": SCALES,
            "best": "SELECT k, SUM(ss) AS inertia FROM (SELECT k, GREATEST(part, 4 - k) AS part, VAR_POP(x1)*COUNT(*) AS ss "
            "FROM rows_, (VALUES (2), (3), (4)) AS t(k) GROUP BY k, GREATEST(part, 4 - k)) q GROUP BY k",
            "one": "SELECT *, inertia - LAG(inertia) OVER (ORDER BY k) AS inertia_diff FROM best",
        },
        f"SELECT {big('k')}, {r('inertia')}, {r('inertia_diff')}, {r('inertia_diff - LAG(inertia_diff) OVER (ORDER BY k)', 'inertia_diff2')} FROM one",
    ),
)
def _(spark, sf_dir):
    rows = P.view(spark, sf_dir, SCALES).select("c_custkey", F.array("x1").alias("x"))
    return sweeps.elbow(rows, [2, 3, 4]).drop("n_iter")


# ------------------------------------------------------------------- regions


def learned(spark, sf_dir) -> regions.Regions:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LEARNED:
        rows = labelled(spark, sf_dir).drop("cluster")
        _LEARNED[key] = regions.run(rows)
    return _LEARNED[key]


_LEARNED: dict = {}


@query("region_models")
def _(spark, sf_dir):
    return learned(spark, sf_dir).comparison


@query("regions")
def _(spark, sf_dir):
    return learned(spark, sf_dir).rows.select("latitude", "longitude", "cluster", "cluster_label")


@query(
    "stored_run",
    with_(
        LABELLED_CTES,
        f"SELECT part, {big('(SELECT COUNT(*) FROM lab)', 'places')}, {big('0', 'moved')} FROM "
        "(VALUES ('K-Means'), ('GMM'), ('DBSCAN')) AS t(part)",
    ),
)
def _(spark, sf_dir):
    """A run stored and read again puts its own places where it had them.

    DBSCAN cannot predict: the stored run must send its places to the same
    nearest centers as a direct search over the rows.
    """
    folder = f"{stage_folder(spark)}/{uuid.uuid4().hex}"
    regions.save(learned(spark, sf_dir), folder)
    run = regions.load(spark, folder)
    key = ["latitude", "longitude"]
    parts = []
    for name in ("K-Means", "GMM", "DBSCAN"):
        chosen = replace(run, algorithm=name)
        before = run.rows.select(*key, F.col(run.columns[name]).alias("was"))
        if name == "DBSCAN":
            known = run.rows.select("x", F.col("cluster_dbscan").alias("cluster"))
            before = assign.assign_by_centroid(run.rows.select(*key, "x"), known).select(
                *key, F.col("cluster").alias("was")
            )
        new = labelled(spark, sf_dir).drop("cluster")
        found = regions.assign_places(chosen, new).join(before, key)
        moved = F.count_if(~F.col("cluster").eqNullSafe(F.col("was")))
        parts.append(
            found.agg(F.count(F.lit(1)).alias("places"), moved.alias("moved")).select(
                F.lit(name).alias("part"), "places", "moved"
            )
        )
    return fold(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- assignment


def _centroid_sql() -> str:
    return (
        "SELECT vec_id, cluster, confidence, alternative FROM (SELECT vec_id, cluster, "
        "1 - d/(d + LEAD(d) OVER w + 1E-9) AS confidence, LEAD(cluster) OVER w AS alternative, "
        "ROW_NUMBER() OVER w AS rn FROM gaps WINDOW w AS (PARTITION BY vec_id ORDER BY d, cluster)) q "
        "WHERE rn = 1"
    )


@query(
    "assign_by_centroid",
    rounded(
        with_(
            {
                "vec": VEC,
                "cells": "SELECT vec_id, cluster, UNNEST(GENERATE_SERIES(1, LEN(x))) AS pos, "
                "UNNEST(x) AS v FROM vec",
                "middle": "SELECT cluster, pos, AVG(v) AS m FROM cells WHERE cluster >= 0 "
                "GROUP BY cluster, pos",
                "gaps": "SELECT vec_id, m.cluster, SQRT(SUM((v - m)*(v - m))) AS d FROM cells c "
                "JOIN middle m USING (pos) GROUP BY vec_id, m.cluster",
            },
            _centroid_sql(),
        ),
        "",
        ["confidence"],
        ["vec_id", "cluster", "alternative"],
    ),
)
def _(spark, sf_dir):
    training = vectors(spark, sf_dir)
    found = assign.assign_by_centroid(training.drop("cluster"), training)
    return found.select("vec_id", "cluster", "confidence", "alternative")


@query("assign_by_mixture")
def _(spark, sf_dir):
    rows = points(spark, sf_dir)
    fitted = models.fit_mixture(rows, 6)
    return assign.assign_by_mixture(rows, fitted).select(
        "vec_id", "cluster", "confidence", "alternative"
    )


@query("describe_assignments")
def _(spark, sf_dir):
    """New places from the raw rows, each cleaned on its own, assigned and described."""
    training = labelled(spark, sf_dir)
    scaling, projection, _ = regions.reduced(training.drop("cluster"))
    placed = assign.align(training, scaling, projection)
    new = flows.place_normals(raw(spark, sf_dir), scope="place").withColumn(
        "query_id", F.xxhash64("latitude", "longitude")
    )
    found = assign.assign_by_centroid(assign.align(new, scaling, projection), placed)
    result = assign.describe_assignments(found, training, SCALED)
    return result.select(
        "latitude",
        "longitude",
        "cluster",
        "cluster_label",
        "confidence",
        "alternative_label",
        "summary",
        F.size("top_characteristics").alias("characteristics"),
        F.size("nearest_examples").alias("examples"),
    )


TYPED = (
    "SELECT c_custkey, SUBSTR(name, 1, CAST(FLOOR(c_custkey/40) AS INT) % LENGTH(name)) || "
    "SUBSTR(name, CAST(FLOOR(c_custkey/40) AS INT) % LENGTH(name) + 2, 100) AS typed "
    "FROM customer JOIN gazetteer ON CAST(c_custkey % 40 AS INT) = pos"
)
GAZETTEER = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{n}')" for i, n in enumerate(KNOWN_PLACES)
) + ") AS g(pos, name)"


@query(
    "match_names",
    with_(
        {
            "gazetteer": GAZETTEER,
            "typed": TYPED,
            "scored": "SELECT c_custkey, typed, pos, name, CONTAINS(LOWER(name), LOWER(typed)) AS hit, "
            "1 - LEVENSHTEIN(LOWER(name), LOWER(typed))*1.0E0/"
            "GREATEST(LENGTH(name), LENGTH(typed)) AS s FROM typed, gazetteer",
            "best": "SELECT * FROM scored WHERE s >= 0.4 QUALIFY ROW_NUMBER() OVER "
            "(PARTITION BY c_custkey ORDER BY s DESC, pos) <= 6",
            "both_": "SELECT c_custkey, typed, name, 0 AS kind, pos AS o1, 0 AS o2 FROM scored WHERE hit "
            "UNION ALL SELECT c_custkey, typed, name, 1, -s, pos FROM best WHERE NOT hit",
            "ranked": "SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY kind, o1, o2) "
            "AS rank FROM both_",
        },
        f"SELECT {big('c_custkey')}, typed, {big('rank')}, name AS match FROM ranked WHERE rank <= 6",
    ),
)
def _(spark, sf_dir):
    P.register(spark, sf_dir)
    spark.sql(GAZETTEER).createOrReplaceTempView("gazetteer")
    return assign.match_names(spark.sql(TYPED), "typed")


@query("region_labels_of_new_places")
def _(spark, sf_dir):
    """New places in the regions of the chosen model, with the names of those regions."""
    run = learned(spark, sf_dir)
    new = flows.place_normals(raw(spark, sf_dir), scope="place")
    labels = run.rows.select("cluster", "cluster_label").distinct()
    return regions.assign_places(run, new).join(labels, "cluster", "left").select(
        "latitude", "longitude", "cluster", "cluster_label", "confidence", "assignment_method"
    )


@query("alternate_labels")
def _(spark, sf_dir):
    """The chosen model's regions, with plain labels of an alternate model beside them."""
    found = learned(spark, sf_dir)
    other = next(c for name, c in found.columns.items() if name != found.algorithm)
    rows = found.rows.select("latitude", "longitude", F.col("cluster_label").alias("region"), other)
    labelled_rows = explore.generic_labels(rows, other)
    return profile.attach_labels(
        labelled_rows.drop("cluster_label"), explore.label_map(labelled_rows)
    ).drop(other)
