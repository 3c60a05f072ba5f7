"""From long-term normals to named regions."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclime.functions.lineage import materialize
from gridclime.operators import assign, density, hdbscan, metrics, models, profile, sweeps, ward
from gridclime.operators.reduce import (
    Projection,
    Scaling,
    feature_columns,
    fit_projection,
    fit_scaling,
)
from gridclime.sources import tables

MIN_PLACES = 3
#: A cluster of HDBSCAN has one in so many rows at least.
HDBSCAN_SHARE = 50


@dataclass
class Regions:
    """Everything a run learned."""

    scaling: Scaling
    projection: Projection
    rows: DataFrame  # normals, x, one label column per model, cluster, cluster_label
    comparison: DataFrame
    algorithm: str
    fitted: dict[str, models.Fitted] = field(default_factory=dict)
    columns: dict[str, str] = field(default_factory=dict)
    by_k: dict[str, DataFrame] = field(default_factory=dict)  # tables of the search for k

    def metadata(self) -> dict:
        return {
            "best_algorithm": self.algorithm,
            "best_column": self.columns[self.algorithm],
            "features": self.scaling.features,
        }


def reduced(normals: DataFrame, variance: float = 0.95) -> tuple[Scaling, Projection, DataFrame]:
    """Normals with ``x``, their place in the principal component space; stored."""
    scaling = fit_scaling(normals, feature_columns(normals))
    scaled = materialize(scaling.transform(normals))
    projection = fit_projection(scaled, variance=variance)
    return scaling, projection, materialize(projection.transform(scaled).drop("scaled"))


def search_k(
    rows: DataFrame, ks: Sequence[int], restarts: int, distance: str = "euclidean"
) -> dict[str, DataFrame]:
    """Tables per k: ``silhouette``, ``elbow`` and ``information``; the first two share their fits."""
    fits = sweeps.kmeans_by_k(rows, ks, restarts)
    return {
        "silhouette": materialize(sweeps.silhouette_by_k(rows, fits=fits, distance=distance)),
        "elbow": sweeps.elbow(rows, fits=fits),
        "information": sweeps.information_by_k(rows, ks),
    }


def choose_k(by_k: dict[str, DataFrame], n: int) -> int:
    """By silhouette; by BIC, or 2 for three places, where that is undefined."""
    best = sweeps.best_k(by_k["silhouette"], "silhouette")
    if best is None and n > MIN_PLACES:
        best = sweeps.best_k(by_k["information"], "bic")
    return sweeps.clamp_k(best or 2, n)


def label_all(
    rows: DataFrame,
    n: int,
    ks: Sequence[int],
    eps: float,
    restarts: int = 10,
    mixture_restarts: int = 5,
    min_samples: int = 5,
) -> tuple[DataFrame, dict[str, str], dict[str, models.Fitted]]:
    """Labels of every model: rows, model name to column, and the fitted models."""
    columns, fitted = {}, {}
    points = rows.select("x")

    def names(title: str, key: str, i: int, k: int) -> tuple[str, str]:
        if title == "Hierarchical":
            return f"{title}(Ward, k={k})", f"cluster_{key}_k{k}"
        return (title, f"cluster_{key}") if i == 0 else (f"{title}(k={k})", f"cluster_{key}_k{k}")

    means = models.fit_kmeans_each(points, ks, restarts)
    mixtures = models.fit_mixture_each(points, ks, mixture_restarts)
    out = rows
    for i, k in enumerate(ks):
        name, column = names("K-Means", "kmeans", i, k)
        fitted[name] = means[k]
        out, columns[name] = fitted[name].labels(out, column), column
        name, column = names("GMM", "gmm", i, k)
        fitted[name] = mixtures[k]
        out, columns[name] = fitted[name].labels(out, column), column
    out = materialize(out)
    # The others label distinct vectors; each joins the rows once.
    for i, k in enumerate(ks):
        name, column = names("Hierarchical", "ward", i, k)
        columns[name] = column
    out = ward.ward_each(out, ks, [c for c in columns.values() if c.startswith("cluster_ward")])
    dense = {
        "DBSCAN": density.dbscan(points, eps, min_samples),
        "HDBSCAN": hdbscan.hdbscan(points, max(hdbscan.MIN_CLUSTER_SIZE, n // HDBSCAN_SHARE)),
    }
    for name, noisy in dense.items():
        columns[name] = f"cluster_{name.lower()}"
        out = out.join(noisy.groupBy("x").agg(F.first("cluster").alias(columns[name])), "x")
    return materialize(out), columns, fitted


def run(
    normals: DataFrame,
    ks: Sequence[int] = sweeps.K_RANGE,
    restarts: int = 10,
    mixture_restarts: int = 5,
    distance: str = "euclidean",
) -> Regions:
    """Scale, reduce, choose k, fit every model, compare, choose, and name the regions.

    ``distance`` is that of the silhouettes by which k is chosen.
    """
    n = normals.count()
    if n < MIN_PLACES:
        raise ValueError(f"need at least {MIN_PLACES} places, found {n}")
    scaling, projection, rows = reduced(normals)
    by_k = search_k(rows, ks, restarts, distance)
    best = choose_k(by_k, n)
    eps = sweeps.estimate_eps(rows)
    labelled, columns, fitted = label_all(
        rows, n, sweeps.candidate_ks(best, n), eps, restarts, mixture_restarts
    )
    comparison = materialize(metrics.with_composite(metrics.evaluate(labelled, columns)))
    algorithm = metrics.choose_model(comparison).first()["algorithm"]
    chosen = labelled.withColumn("cluster", F.col(columns[algorithm]))
    named = profile.attach_labels(chosen, profile.cluster_labels(chosen))
    return Regions(scaling, projection, named, comparison, algorithm, fitted, columns, by_k)


def save(run: Regions, path: str) -> None:
    """Store a run: its tables, projection and models, and the rest as one JSON record."""
    spark = run.rows.sparkSession
    tables.write_table(run.rows, f"{path}/rows")
    tables.write_table(run.comparison, f"{path}/comparison")
    for name, table in run.by_k.items():
        tables.write_table(table, f"{path}/by_k/{name}")
    tables.save_model(run.projection.model, f"{path}/projection")
    record = {
        **run.metadata(),
        "columns": run.columns,
        "by_k": list(run.by_k),
        "scaling": run.scaling.to_dict(),
        "ratios": run.projection.ratios,
        "components": run.projection.components,
        "models": {},
    }
    for name, fitted in run.fitted.items():
        record["models"][name] = fitted.to_dict()
    tables.write_metadata(spark, {"record": json.dumps(record)}, f"{path}/metadata")


def load(spark: SparkSession, path: str) -> Regions:
    """A stored run, in any session."""
    record = json.loads(tables.read_metadata(spark, f"{path}/metadata")["record"])
    columns = record["columns"]
    fitted = {name: models.Fitted(**found) for name, found in record["models"].items()}
    projection = tables.load_model(f"{path}/projection")
    return Regions(
        Scaling(**record["scaling"]),
        Projection(projection, record["ratios"], record["components"]),
        tables.read_table(spark, f"{path}/rows"),
        tables.read_table(spark, f"{path}/comparison"),
        record["best_algorithm"],
        fitted,
        columns,
        {name: tables.read_table(spark, f"{path}/by_k/{name}") for name in record["by_k"]},
    )


def assign_places(run: Regions, new: DataFrame) -> DataFrame:
    """New places in the regions of a run, by its chosen model.

    ``new`` has normals. Adds ``x``, ``cluster``, ``confidence``, ``alternative``
    and ``assignment_method``. A mixture gives probabilities; K-Means only the
    cluster, so confidence and alternative are NULL; a model that cannot
    predict gives way to the nearest center.
    """
    placed = assign.align(new, run.scaling, run.projection).drop("scaled")
    fitted = run.fitted.get(run.algorithm)
    column = run.columns[run.algorithm]
    if fitted is None:
        known = run.rows.select("x", F.col(column).alias("cluster"))
        found, method = assign.assign_by_centroid(placed, known), "nearest-centroid"
    elif fitted.is_mixture:
        found, method = assign.assign_by_mixture(placed, fitted), f"model:{run.algorithm}"
    else:
        found, method = fitted.labels(placed), f"model:{run.algorithm}"
        found = found.withColumns(
            {"confidence": F.lit(None).cast("double"), "alternative": F.lit(None).cast("int")}
        )
    return found.withColumn("assignment_method", F.lit(method))
