"""Quality of labellings, comparison of models, choice of one.

Tables have ``x`` (array of doubles) and one label column per model. A negative
label is noise and takes no part in the scores. All models are scored together,
so distances and scans are shared.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridclime.functions.columns import euclidean
from gridclime.operators import planar
from gridclime.operators.pairs import (
    ALL_ROWS,
    blocked,
    cluster_distance_sums,
    distinct_points,
)

# Fixed values of the model choice: prefixes, then per tier the cluster counts,
# the noise share and the largest cluster share allowed.
MODEL_PREFIXES = ("K-Means", "Hierarchical(Ward", "Hierarchical(Average", "GMM")
TIERS = ((6, 8, 0.0, 0.45), (6, 8, 0.0, 0.55), (5, 9, 0.05, 0.60))

ONE = {"cluster": "cluster"}


def long_labels(df: DataFrame, models: Mapping[str, str]) -> DataFrame:
    """(algorithm, cluster, x): the rows once per model."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("algorithm"), F.col(c).cast("int").alias("cluster"))
            for name, c in models.items()
        ]
    )
    return df.select("x", F.inline(cells))


def silhouette_samples(
    df: DataFrame, models: Mapping[str, str] = ONE, block_rows: int = ALL_ROWS
) -> DataFrame:
    """(algorithm, x, cluster, w, silhouette) per distinct vector, w being its rows.

    Exact with Euclidean distances, so the work grows with the square of the
    distinct points; it is spread over block pairs. In one or two dimensions cells
    far away are met through weights on a grid, to more than nine digits, and the
    work grows little faster than the points. ``silhouette_squared`` is the
    linear-time score.
    """
    names = F.array(*[F.lit(name) for name in models])
    labels = F.array(*[F.coalesce(F.col(c).cast("int"), F.lit(-1)) for c in models.values()])
    points = distinct_points(df.select("x", labels.alias("labels")), by=["labels"])
    first = points.select(F.size("x").alias("n")).first()
    flat = first is not None and first["n"] <= planar.SIZE
    blocks = blocked(points, min(block_rows, planar.BLOCK_ROWS) if flat else block_rows)
    own = blocks.points.select(
        "pid", "x", "w", F.posexplode("labels").alias("model", "cluster")
    ).filter("cluster >= 0")
    sizes = own.groupBy("model", F.col("cluster").alias("other")).agg(F.sum("w").alias("size"))
    sums = (planar.cluster_distance_sums if flat else cluster_distance_sums)(blocks).join(sizes, ["model", "other"])
    scored = sums.join(own.select("pid", "model", "cluster"), ["pid", "model"])
    mine = F.col("other") == F.col("cluster")
    sides = scored.groupBy("pid", "model").agg(
        F.max(F.when(mine, F.col("size"))).alias("size"),
        F.max(F.when(mine & (F.col("size") > 1), F.col("total") / (F.col("size") - 1))).alias("a"),
        F.min(F.when(~mine, F.col("total") / F.col("size"))).alias("b"),
    )
    widest = F.greatest("a", "b")
    score = F.when(F.col("size") == 1, F.lit(0.0)).otherwise(
        F.when(widest > 0, (F.col("b") - F.col("a")) / widest).otherwise(F.lit(0.0))
    )
    return (
        sides.filter("b IS NOT NULL")
        .join(own, ["pid", "model"])
        .select(
            names[F.col("model")].alias("algorithm"), "x", "cluster", "w", score.alias("silhouette")
        )
    )


def silhouette_rows(df: DataFrame, block_rows: int = ALL_ROWS) -> DataFrame:
    """Clustered input rows with their silhouette."""
    scores = silhouette_samples(df, block_rows=block_rows).drop("w", "algorithm")
    return df.filter("cluster >= 0").join(scores, ["x", "cluster"])


def silhouettes(
    df: DataFrame, models: Mapping[str, str] = ONE, block_rows: int = ALL_ROWS
) -> DataFrame:
    """(algorithm, silhouette): the mean over rows; no row with fewer than two clusters."""
    return (
        silhouette_samples(df, models, block_rows)
        .groupBy("algorithm")
        .agg((F.sum(F.col("silhouette") * F.col("w")) / F.sum("w")).alias("silhouette"))
    )


def silhouette_by_cluster(df: DataFrame, block_rows: int = ALL_ROWS) -> DataFrame:
    """Mean, population deviation, minimum and size per cluster."""
    s, w = F.col("silhouette"), F.col("w")
    sums = silhouette_samples(df, block_rows=block_rows).groupBy("cluster").agg(
        F.sum("w").alias("size"),
        (F.sum(s * w) / F.sum(w)).alias("mean"),
        (F.sum(s * s * w) / F.sum(w)).alias("_square"),
        F.min(s).alias("min"),
    )
    spread = F.sqrt(F.greatest(F.col("_square") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    return sums.select("cluster", "mean", spread.alias("std"), "min", "size")


def silhouette_squared(df: DataFrame) -> float:
    """Mean silhouette with squared distances, in linear time."""
    rows = df.filter("cluster >= 0").select(array_to_vector("x").alias("features"), "cluster")
    return ClusteringEvaluator(predictionCol="cluster").evaluate(rows)


def cluster_dimensions(df: DataFrame, models: Mapping[str, str] = ONE) -> DataFrame:
    """(algorithm, cluster, pos, n, mean, ss): mean and sum of squares per coordinate."""
    cells = (
        long_labels(df, models)
        .filter("cluster >= 0")
        .select("algorithm", "cluster", F.posexplode("x").alias("pos", "value"))
    )
    n = F.count("value")
    return cells.groupBy("algorithm", "cluster", "pos").agg(
        n.alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * n).alias("ss")
    )


def centroids(df: DataFrame, models: Mapping[str, str] = ONE) -> DataFrame:
    """(algorithm, cluster, size, centroid) of the clusters."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "mean")))
    return cluster_dimensions(df, models).groupBy("algorithm", "cluster").agg(
        F.max("n").alias("size"), ordered["mean"].alias("centroid")
    )


def calinski_harabasz(df: DataFrame, models: Mapping[str, str] = ONE) -> DataFrame:
    """(algorithm, score): between-cluster against within-cluster variance."""
    pos = Window.partitionBy("algorithm", "pos")
    n, mean = F.col("n"), F.col("mean")
    dims = cluster_dimensions(df, models).withColumn(
        "_grand", F.sum(n * mean).over(pos) / F.sum(n).over(pos)
    )
    gap = mean - F.col("_grand")
    sums = dims.groupBy("algorithm").agg(
        F.sum(n * gap * gap).alias("between"),
        F.sum("ss").alias("within"),
        F.count_if(F.col("pos") == 0).alias("k"),
        F.sum(F.when(F.col("pos") == 0, n)).alias("n"),
    )
    score = (F.col("between") / (F.col("k") - 1)) / (F.col("within") / (F.col("n") - F.col("k")))
    flat = F.when(F.col("within") > 0, score).otherwise(F.lit(1.0))
    return sums.filter("k > 1").select("algorithm", flat.alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, models: Mapping[str, str] = ONE) -> DataFrame:
    """(algorithm, score): mean over clusters of the worst spread-to-separation ratio."""
    middle = centroids(df, models)
    rows = long_labels(df, models).filter("cluster >= 0")
    located = rows.join(middle, ["algorithm", "cluster"])
    spread = located.groupBy("algorithm", "cluster").agg(F.avg(euclidean(F.col("x"), F.col("centroid"))).alias("spread"))
    table = middle.join(spread, ["algorithm", "cluster"])
    others = table.groupBy("algorithm").agg(
        F.collect_list(F.struct("cluster", "spread", "centroid")).alias("others")
    )
    paired = table.join(others, "algorithm")
    rest = F.filter("others", lambda o: o["cluster"] != F.col("cluster"))

    def ratio(other):
        apart = euclidean(F.col("centroid"), other["centroid"])
        return F.when(apart > 0, (F.col("spread") + other["spread"]) / apart).otherwise(F.lit(0.0))

    worst = paired.select("algorithm", F.array_max(F.transform(rest, ratio)).alias("worst"))
    return worst.groupBy("algorithm").agg(F.avg("worst").alias("davies_bouldin"))


def sizes(df: DataFrame) -> DataFrame:
    """(cluster, size), noise included."""
    return df.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))


def balance(df: DataFrame, models: Mapping[str, str] = ONE) -> DataFrame:
    """Per model: counts, noise share, size statistics and balance of the clusters."""
    counted = (
        long_labels(df, models)
        .groupBy("algorithm", "cluster")
        .agg(F.count(F.lit(1)).alias("size"))
    )
    real = F.when(F.col("cluster") >= 0, F.col("size"))
    noise = F.coalesce(F.sum(F.when(F.col("cluster") < 0, F.col("size"))), F.lit(0))
    total, valid = F.sum("size"), F.sum(real)
    return counted.groupBy("algorithm").agg(
        F.count(real).alias("n_clusters"),
        total.alias("n_samples"),
        noise.alias("n_noise"),
        F.bround(noise / total * 100, 1).alias("noise_pct"),
        F.bround(1 - F.stddev_pop(real) / F.avg(real), 4).alias("cluster_balance"),
        F.min(real).alias("min_cluster_size"),
        F.max(real).alias("max_cluster_size"),
        F.bround(F.avg(real), 1).alias("mean_cluster_size"),
        F.bround(F.min(real) / valid, 4).alias("min_cluster_share"),
        F.bround(F.max(real) / valid, 4).alias("max_cluster_share"),
    )


def evaluate(
    df: DataFrame, models: Mapping[str, str] = ONE, block_rows: int = ALL_ROWS
) -> DataFrame:
    """One row per model with every score; NULL with fewer than two clusters."""
    out = balance(df, models)
    for table, digits in (
        (silhouettes(df, models, block_rows), 4),
        (calinski_harabasz(df, models), 2),
        (davies_bouldin(df, models), 4),
    ):
        score = table.columns[1]
        rounded = table.select("algorithm", F.bround(score, digits).alias(score))
        out = out.join(rounded, "algorithm", "left")
    several = F.col("n_clusters") > 1
    keep = ("algorithm", "n_clusters", "n_samples", "n_noise")
    return out.select(
        *[F.col(c) if c in keep else F.when(several, F.col(c)).alias(c) for c in out.columns]
    )


def with_composite(comparison: DataFrame) -> DataFrame:
    """Add the weighted score of silhouette, Davies-Bouldin and balance."""
    filled = lambda c, value: F.coalesce(F.col(c), F.lit(float(value)))
    score = (
        filled("silhouette", 0) * 0.4
        + 1 / (filled("davies_bouldin", 10) + 0.01) * 0.3
        + filled("cluster_balance", 0) * 0.3
    )
    return comparison.withColumn("composite_score", score)


def best_by_composite(comparison: DataFrame) -> DataFrame:
    return (
        with_composite(comparison)
        .orderBy(F.desc_nulls_last("composite_score"), "algorithm")
        .limit(1)
    )


def choose_model(comparison: DataFrame) -> DataFrame:
    """The model of the first tier that any candidate meets.

    Tiers relax the cluster count, noise and largest share; within a tier the
    most even clusters win, then the better scores.
    """
    allowed = F.lit(False)
    for prefix in MODEL_PREFIXES:
        allowed = allowed | F.col("algorithm").startswith(prefix)
    noise = F.coalesce(F.col("n_noise"), F.lit(0))
    share = F.coalesce(F.col("max_cluster_share"), F.lit(1.0))
    most = comparison.agg(F.max("n_samples")).scalar()
    cases = []
    for i, (low, high, noise_share, largest) in enumerate(TIERS):
        quiet = noise <= (F.greatest(F.lit(1.0), noise_share * most) if noise_share else F.lit(0))
        meets = allowed & F.col("n_clusters").between(low, high) & quiet & (share <= largest)
        cases.append(F.when(meets, F.lit(i + 1)))
    tier = F.coalesce(*cases, F.when(allowed, F.lit(4)), F.lit(5))
    return (
        comparison.withColumn("tier", tier)
        .orderBy(
            "tier",
            F.asc_nulls_last("max_cluster_share"),
            F.desc_nulls_last("silhouette"),
            F.desc_nulls_last("cluster_balance"),
            F.asc_nulls_last("davies_bouldin"),
            F.desc_nulls_last("calinski_harabasz"),
            "algorithm",
        )
        .limit(1)
    )
