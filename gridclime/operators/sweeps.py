"""Choice of the number of clusters and of the neighbourhood radius."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridclime.functions.quantiles import quantiles
from gridclime.operators import metrics, models, pairs

# Fixed values.
K_RANGE = tuple(range(3, 16))
CLIMATE_KS = (6, 7, 8)


def kmeans_by_k(
    df: DataFrame, ks: Sequence[int] = K_RANGE, restarts: int = 10
) -> dict[int, models.Fitted]:
    """Fits that the elbow and the silhouettes can share."""
    n = df.count()
    return models.fit_kmeans_each(df, [k for k in ks if 2 <= k < n], restarts)


def elbow(
    df: DataFrame,
    ks: Sequence[int] = K_RANGE,
    restarts: int = 10,
    fits: dict[int, models.Fitted] | None = None,
) -> DataFrame:
    """(k, inertia, n_iter, inertia_diff, inertia_diff2)."""
    fits = kmeans_by_k(df, ks, restarts) if fits is None else fits
    rows = [(k, float(f.cost), int(f.iterations)) for k, f in fits.items()]
    return with_differences(
        df.sparkSession.createDataFrame(rows, "k int, inertia double, n_iter int")
    )


def with_differences(table: DataFrame) -> DataFrame:
    by_k = Window.orderBy("k")  # one row per k
    first = F.col("inertia") - F.lag("inertia").over(by_k)
    out = table.withColumn("inertia_diff", first)
    return out.withColumn(
        "inertia_diff2", F.col("inertia_diff") - F.lag("inertia_diff").over(by_k)
    )


def silhouette_by_k(
    df: DataFrame,
    ks: Sequence[int] = K_RANGE,
    restarts: int = 10,
    fits: dict[int, models.Fitted] | None = None,
    distance: str = "euclidean",
) -> DataFrame:
    """(k, silhouette); the labels of all k are scored on one set of distances.

    ``distance='squared'`` scores with squared distances, in time linear in the
    rows; ``'euclidean'`` meets all pairs of distinct points, in blocks.
    """
    if distance not in ("euclidean", "squared"):
        raise ValueError(f"unknown distance {distance!r}")
    fits = kmeans_by_k(df, ks, restarts) if fits is None else fits
    if distance == "squared":
        rows = [(k, metrics.silhouette_squared(f.labels(df.select("x")))) for k, f in fits.items()]
        return df.sparkSession.createDataFrame(rows, "k int, silhouette double")
    labelled, columns = df.select("x"), {}
    for k, fitted in fits.items():
        columns[str(k)] = f"k{k}"
        labelled = fitted.labels(labelled, f"k{k}")
    scores = metrics.silhouettes(labelled, columns)
    return scores.select(F.col("algorithm").cast("int").alias("k"), "silhouette")


def information_by_k(
    df: DataFrame, ks: Sequence[int] = K_RANGE, restarts: int = 3
) -> DataFrame:
    """(k, bic, aic, converged) of mixtures."""
    n = df.count()
    fits = models.fit_mixture_each(df, [k for k in ks if 1 <= k <= n], restarts)
    rows = []
    for k, fitted in fits.items():
        found = models.information(fitted, n)
        rows.append((k, found["bic"], found["aic"], found["converged"]))
    return df.sparkSession.createDataFrame(
        rows, "k int, bic double, aic double, converged boolean"
    )


# Method -> (score column, whether larger is better).
CRITERIA = {
    "silhouette": ("silhouette", True),
    "elbow": ("inertia_diff2", True),
    "bic": ("bic", False),
}


def best_k(table: DataFrame, method: str = "silhouette") -> int | None:
    """The k of the best score, the smaller k on ties; None without any score."""
    column, larger = CRITERIA[method]
    score = F.col(column) if larger else -F.col(column)
    scored = table.filter(F.col(column).isNotNull())
    best = scored.agg(F.max(F.struct(score.alias("s"), (-F.col("k")).alias("k"))).alias("b"))
    row = best.first()["b"]
    return None if row is None else -row["k"]


def clamp_k(k: int, n: int) -> int:
    return max(2, min(k, n - 1))


def candidate_ks(best: int, n: int) -> list[int]:
    """The best k, two and four more, and the usual numbers of climates."""
    wanted = {best, best + 2, best + 4, *CLIMATE_KS}
    return sorted(k for k in wanted if 2 <= k < n)


def k_distance_quantile(df: DataFrame, k: int = 5, share: float = 0.9) -> DataFrame:
    """One row, ``eps``: a quantile of the distances to the k-th neighbour."""
    curve = pairs.k_distance_rows(df, max(1, min(k, df.count())))
    return quantiles(curve, ["k_distance"], [share]).select(F.col("k_distance")[0].alias("eps"))


def estimate_eps(df: DataFrame, k: int = 5, share: float = 0.9) -> float:
    return k_distance_quantile(df, k, share).first()["eps"]
