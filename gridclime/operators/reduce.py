"""Feature choice, scaling, principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, ElementwiseProduct, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridclime.functions.columns import numeric_columns
from gridclime.functions.quantiles import quantiles
from gridclime.registry import NOT_FEATURES, REDUNDANT_RAW


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns fit for a model: no keys or outputs, no copies of an alias."""
    columns = numeric_columns(df, exclude=NOT_FEATURES)
    return [c for c in columns if REDUNDANT_RAW.get(c) not in columns]


def usable_features(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at least one value; fails if there are none."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    kept = [c for c in columns if counts[c] > 0]
    if not kept:
        raise ValueError("no feature has any value")
    return kept


@dataclass(frozen=True)
class Scaling:
    """What one fit learned: a few numbers per feature."""

    method: str
    features: list[str]
    medians: list[float]
    centers: list[float]
    scales: list[float]

    def filled(self, name: str):
        """The feature with NULLs imputed."""
        i = self.features.index(name)
        return F.coalesce(F.col(name).cast("double"), F.lit(self.medians[i]))

    def transform(self, df: DataFrame, output: str = "scaled") -> DataFrame:
        """Add the scaled features as an array; features not present count as missing."""
        cells = []
        for i, name in enumerate(self.features):
            value = self.filled(name) if name in df.columns else F.lit(self.medians[i])
            cells.append((value - self.centers[i]) / self.scales[i])
        return df.withColumn(output, F.array(*cells))

    def inverse(self, df: DataFrame, scaled: str = "scaled") -> DataFrame:
        """The array back in the features' units, as columns."""
        return df.withColumns(
            {
                name: F.col(scaled)[i] * self.scales[i] + self.centers[i]
                for i, name in enumerate(self.features)
            }
        )

    def to_dict(self) -> dict:
        return asdict(self)


def fit_scaling(df: DataFrame, columns: Sequence[str], method: str = "standard") -> Scaling:
    """Learn medians for imputing and the centers and scales of a method.

    ``standard`` uses the population deviation, ``minmax`` maps to [0, 1],
    ``robust`` uses median and interquartile range, all after imputing.
    """
    names = usable_features(df, columns)
    found = quantiles(df, names, [0.5]).first()
    medians = [found[c][0] if found[c][0] is not None else 0.0 for c in names]
    filled = df.select(
        *[F.coalesce(F.col(c).cast("double"), F.lit(m)).alias(c) for c, m in zip(names, medians)]
    )
    if method == "robust":
        row = quantiles(filled, names, [0.25, 0.5, 0.75]).first()
        centers = [row[c][1] for c in names]
        spreads = [row[c][2] - row[c][0] for c in names]
    elif method in ("standard", "minmax"):
        low, wide = (
            (F.avg, F.stddev_pop)
            if method == "standard"
            else (F.min, lambda c: F.max(c) - F.min(c))
        )
        row = filled.agg(
            *[low(c).alias(f"c_{c}") for c in names], *[wide(c).alias(f"s_{c}") for c in names]
        ).first()
        centers = [row[f"c_{c}"] for c in names]
        spreads = [row[f"s_{c}"] for c in names]
    else:
        raise ValueError(f"unknown scaling {method!r}")
    # Rounding noise of a constant column is no spread.
    scales = [s if s > 1e-12 * abs(c) else 1.0 for s, c in zip(spreads, centers)]
    return Scaling(method, names, medians, centers, scales)


@dataclass(frozen=True)
class Projection:
    """A principal component model with fixed signs."""

    model: PipelineModel
    ratios: list[float]
    components: list[list[float]]

    def transform(self, df: DataFrame, scaled: str = "scaled", output: str = "x") -> DataFrame:
        vectors = df.withColumn("_scaled", array_to_vector(scaled))
        out = self.model.transform(vectors)
        return out.withColumn(output, vector_to_array("_flipped")).drop(
            "_scaled", "_projected", "_sliced", "_flipped"
        )


def fit_projection(
    df: DataFrame, scaled: str = "scaled", variance: float | int = 0.95
) -> Projection:
    """Keep the fewest components that explain a share of variance, or an exact number.

    Input must be centered. The largest loading of every component is positive,
    so results do not depend on the solver's choice of sign.
    """
    vectors = df.select(array_to_vector(scaled).alias("_scaled"))
    size = len(df.select(scaled).first()[0])
    pca = PCA(k=size, inputCol="_scaled", outputCol="_projected").fit(vectors)
    ratios = pca.explainedVariance.toArray()
    if isinstance(variance, float) and variance < 1:
        keep = min(int(np.searchsorted(ratios.cumsum(), variance)) + 1, size)
    else:
        keep = min(int(variance), size)
    loadings = pca.pc.toArray().T[:keep]
    # Rounded, so that equal loadings go to the first feature on any machine.
    largest = np.abs(loadings).round(9).argmax(axis=1)
    signs = np.sign(loadings[np.arange(keep), largest])
    signs[signs == 0] = 1.0
    slicer = VectorSlicer(inputCol="_projected", outputCol="_sliced", indices=list(range(keep)))
    flip = ElementwiseProduct(
        scalingVec=Vectors.dense(signs.tolist()), inputCol="_sliced", outputCol="_flipped"
    )
    return Projection(
        PipelineModel([pca, slicer, flip]),
        ratios[:keep].tolist(),
        (loadings * signs[:, None]).tolist(),
    )


def explained_variance(spark: SparkSession, projection: Projection) -> DataFrame:
    """(component, ratio, cumulative)."""
    total = np.cumsum(projection.ratios).tolist()
    rows = [(i + 1, r, c) for i, (r, c) in enumerate(zip(projection.ratios, total))]
    return spark.createDataFrame(rows, "component int, ratio double, cumulative double")


def loadings(
    spark: SparkSession, projection: Projection, features: Sequence[str]
) -> DataFrame:
    """(component, ratio, feature, loading)."""
    rows = [
        (i + 1, projection.ratios[i], feature, value)
        for i, component in enumerate(projection.components)
        for feature, value in zip(features, component)
    ]
    return spark.createDataFrame(
        rows, "component int, ratio double, feature string, loading double"
    )


def top_loadings(table: DataFrame, components: int = 3, n: int = 5) -> DataFrame:
    """The n strongest features of the first components."""
    rank = Window.partitionBy("component").orderBy(F.desc(F.abs("loading")), "feature")
    ranked = table.filter(F.col("component") <= components).withColumn(
        "rank", F.row_number().over(rank)
    )
    return ranked.filter(F.col("rank") <= n)


def importance(table: DataFrame, components: int = 3) -> DataFrame:
    """(feature, importance): loadings weighted by variance, the largest being 100."""
    weighed = (
        table.filter(F.col("component") <= components)
        .groupBy("feature")
        .agg(F.sum(F.abs("loading") * F.col("ratio")).alias("weight"))
    )
    top = weighed.agg(F.max("weight")).scalar()
    return weighed.select("feature", (100 * F.col("weight") / top).alias("importance"))


def projection_table(df: DataFrame, scaling: Scaling, projection: Projection) -> DataFrame:
    """Rows with every component as a column ``pc1``, ``pc2``, …"""
    placed = projection.transform(scaling.transform(df))
    names = {f"pc{i + 1}": F.col("x")[i] for i in range(len(projection.ratios))}
    return placed.withColumns(names).drop("x", "scaled")
