"""Assigning many new places to learned regions, and matching place names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclime.functions.columns import as_lookup, euclidean, with_one_row
from gridclime.functions.lineage import materialize
from gridclime.operators import metrics, profile
from gridclime.operators.models import Fitted, memberships
from gridclime.operators.reduce import Projection, Scaling
from gridclime.registry import KNOWN_PLACES, PLACE, PLACE_ALIASES

NAME_CUTOFF = 0.4
NAME_LIMIT = 6
TOP_CHARACTERISTICS = 5


def align(df: DataFrame, scaling: Scaling, projection: Projection) -> DataFrame:
    """New places in the trained space: missing features get the training medians."""
    return projection.transform(scaling.transform(df))


def assign_by_mixture(df: DataFrame, mixture: Fitted) -> DataFrame:
    """Cluster, confidence (first probability) and alternative (second)."""
    placed = memberships(df, mixture)
    ranked = F.array_sort(
        F.transform(
            "membership", lambda p, i: F.struct((-p).alias("minus"), i.alias("cluster"))
        )
    )
    return (
        placed.withColumn("_ranked", ranked)
        .withColumn("cluster", F.col("_ranked")[0]["cluster"].cast("int"))
        .withColumn("confidence", -F.col("_ranked")[0]["minus"])
        .withColumn("alternative", F.try_element_at("_ranked", F.lit(2))["cluster"].cast("int"))
        .drop("_ranked", "membership", "uncertainty")
    )


def assign_by_centroid(df: DataFrame, training: DataFrame) -> DataFrame:
    """Nearest cluster center, confidence 1 − d1/(d1 + d2), and the second nearest.

    ``training`` has ``x`` and ``cluster``; noise has no center.
    """
    centers = as_lookup(metrics.centroids(training), "cluster", "centroid")
    placed = with_one_row(df, centers, "_centers")
    near = F.array_sort(
        F.transform(
            F.map_entries("_centers.lookup"),
            lambda e: F.struct(
                euclidean(F.col("x"), e["value"]).alias("d"), e["key"].alias("cluster")
            ),
        )
    )
    first, second = F.col("_near")[0], F.try_element_at("_near", F.lit(2))
    share = 1 - first["d"] / (first["d"] + second["d"] + 1e-9)
    return (
        placed.withColumn("_near", near)
        .withColumn("cluster", first["cluster"])
        .withColumn("confidence", F.coalesce(share, F.lit(1.0)))
        .withColumn("alternative", second["cluster"])
        .drop("_near", "_centers")
    )


def describe_assignments(
    assigned: DataFrame,
    training: DataFrame,
    features: Sequence[str],
    query_id: str = "query_id",
    method: str = "nearest_centroid",
) -> DataFrame:
    """One nested row per new place: labels, summary, traits and nearest examples.

    ``assigned`` has ``cluster``, ``alternative``, ``confidence`` and ``x``;
    ``training`` has the features, coordinates and ``cluster``.
    """
    # Examples and texts read the new places three times; what they need is stored once.
    assigned = materialize(assigned.select(query_id, *PLACE, "cluster", "alternative", "confidence", "x"))
    labels = profile.cluster_labels(training)
    own = labels.select("cluster", F.col("cluster_label").alias("_label"))
    other = labels.select(F.col("cluster").alias("alternative"), F.col("cluster_label").alias("_other"))
    named = assigned.join(own, "cluster", "left").join(other, "alternative", "left")
    traits = (
        profile.characteristics(training, features)
        .filter(F.col("rank") <= TOP_CHARACTERISTICS)
        .groupBy("cluster")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("rank", "feature", "z_score", "description", "summary"))
            ).alias("traits")
        )
    )
    named = named.join(traits, "cluster", "left")
    near = profile.nearest_examples(assigned, training, query_id=query_id)
    examples = near.groupBy(query_id).agg(
        F.array_sort(
            F.collect_list(F.struct("rank", "latitude", "longitude", "distance_deg"))
        ).alias("nearest_examples")
    )

    def label(cluster: str, known: str = "_label") -> Column:
        return F.when(
            F.col(cluster).isNotNull(),
            F.coalesce(known, F.concat(F.lit("Cluster "), F.col(cluster))),
        )

    text = F.concat(
        F.lit("This location fits a "), F.lower(label("cluster")), F.lit(" climate pattern.")
    )
    answer = named.select(
        query_id,
        *PLACE,
        "cluster",
        label("cluster").alias("cluster_label"),
        F.lit(method).alias("assignment_method"),
        F.bround("confidence", 4).alias("confidence"),
        "alternative",
        label("alternative", "_other").alias("alternative_label"),
        text.alias("summary"),
        F.slice("x", 1, 3).alias("reduced_coords"),
        F.coalesce(
            F.col("traits"),
            F.array().cast(traits.schema["traits"].dataType),
        ).alias("top_characteristics"),
    )
    return answer.join(examples, query_id, "left")


def normalized_name(name: Column) -> Column:
    """Lower case, single spaces, aliases replaced."""
    plain = F.trim(F.regexp_replace(F.lower(name), r"\s+", " "))
    pairs = [F.lit(t) for a, n in PLACE_ALIASES.items() for t in (a, n.lower())]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), plain), plain)


def match_names(
    queries: DataFrame,
    name: str = "name",
    names: Sequence[str] = KNOWN_PLACES,
    limit: int = NAME_LIMIT,
    cutoff: float = NAME_CUTOFF,
) -> DataFrame:
    """(… query columns, rank, match): places a typed name may mean, best first.

    Names that contain the text come first, in list order; then similar names,
    by 1 − edit distance / longer length. The list is part of the plan, so no
    join takes place.
    """
    known = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name")) for i, n in enumerate(names)])
    text = F.col("_text")
    contains = lambda n: F.contains(F.lower(n["name"]), text)

    def scored(n):
        low = F.lower(n["name"])
        longer = F.greatest(F.length(low), F.length(text), F.lit(1))
        likeness = 1 - F.levenshtein(low, text) / longer
        return F.struct((-likeness).alias("minus"), n["pos"].alias("pos"), n["name"].alias("name"))

    direct = F.filter("_known", contains)
    similar = F.slice(
        F.array_sort(F.filter(F.transform("_known", scored), lambda s: s["minus"] <= -cutoff)),
        1,
        limit,
    )
    others = F.filter(similar, lambda s: ~contains(s))
    both = F.concat(
        F.transform(direct, lambda n: n["name"]), F.transform(others, lambda n: n["name"])
    )
    ranked = queries.withColumn("_text", normalized_name(F.col(name))).withColumn("_known", known)
    return ranked.select(
        *queries.columns, F.posexplode(F.slice(both, 1, limit)).alias("rank", "match")
    ).withColumn("rank", F.col("rank") + 1)
