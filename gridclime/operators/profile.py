"""What the clusters are like: profiles, characteristics, labels, examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclime.functions.columns import first_available, with_one_row
from gridclime.functions.lineage import materialize
from gridclime.functions.quantiles import quantiles
from gridclime.operators import pairs
from gridclime.registry import (
    CLASS_COLUMNS,
    CLASS_QUANTILES,
    FRIENDLY_NAMES,
    HUMIDITY_CLASSES,
    NOISE_LABEL,
    PLACE,
    RAIN_CLASSES,
    SOLAR_WORDS,
    TEMPERATURE_CLASSES,
    UNASSIGNED_LABEL,
    WIND_WORDS,
    features_where,
)

NOTABLE_Z = 0.5
VERY_Z = 1.5
CONSTANT = 1e-12


def profile(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean, std, min, max and count of every feature per cluster."""
    stats = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "count": F.count}
    return df.groupBy("cluster").agg(
        *[f(c).alias(f"{c}_{name}") for c in features for name, f in stats.items()]
    )


def profile_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Means per cluster, its size and its percent of all rows (1 digit)."""
    means = df.groupBy("cluster").agg(
        *[F.avg(c).alias(c) for c in features], F.count(F.lit(1)).alias("cluster_size")
    )
    total = df.select(F.count(F.lit(1))).scalar()
    return means.withColumn("cluster_pct", F.bround(F.col("cluster_size") / total * 100, 1))


def domain_columns(df: DataFrame, domain: str) -> list[str]:
    """Columns named after a feature of the domain or of all domains."""
    starts = tuple(features_where(domain=domain))
    return [c for c in df.columns if c.startswith(starts)]


def domain_profile(df: DataFrame, domain: str = "energy") -> DataFrame:
    return profile_summary(df, domain_columns(df, domain))


def friendly_name(feature: Column) -> Column:
    names = F.create_map(*[F.lit(t) for pair in FRIENDLY_NAMES.items() for t in pair])
    return F.coalesce(F.try_element_at(names, feature), F.replace(feature, F.lit("_"), F.lit(" ")))


def characteristic_text(feature: Column, z: Column) -> Column:
    """A short sentence on how a feature of a cluster differs."""
    much = F.when(F.abs(z) > VERY_Z, "much ").otherwise("")
    direction = F.when(z > 0, "higher").otherwise("lower")
    strength = F.when(z > 0, "stronger").otherwise("weaker")
    text = (
        F.when(
            feature == "wind_shear_coefficient",
            F.lit("stronger vertical wind change than the India sample average"),
        )
        .when(
            feature == "solar_utilization_ratio",
            F.lit("more reliable solar availability than average"),
        )
        .when(
            feature == "solar_wind_complementarity",
            F.concat(strength, F.lit(" solar-wind complementarity than average")),
        )
        .when(
            feature.rlike("^wind_power_density_(80|120|180)m$"),
            F.concat(direction, F.lit(" wind energy potential than average")),
        )
        .otherwise(
            F.concat(
                direction,
                F.lit(" "),
                friendly_name(feature),
                F.lit(" than the India sample average"),
            )
        )
    )
    return F.concat(much, text)


def characteristics(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features in which a cluster departs from all rows, most distinctive first.

    One row per cluster and feature, with ``rank`` in the cluster. Rows are
    aggregated before they are unpivoted. Means are not rounded: averages of a few
    decimals lie on ties.
    """
    features = list(features)
    one = df.agg(
        *[F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in features]
    )
    overall = one.unpivot([], features, "feature", "all")
    means = df.groupBy("cluster").agg(*[F.avg(c).cast("double").alias(c) for c in features])
    long = means.unpivot(["cluster"], features, "feature", "cluster_mean")
    order = F.array_position(F.array(*[F.lit(c) for c in features]), F.col("feature"))
    scored = (
        long.join(F.broadcast(overall), "feature")  # one row per feature
        # A constant column still shows rounding noise as deviation.
        .filter(F.col("all.std") > CONSTANT * F.abs("all.mean"))
        .withColumn("z", (F.col("cluster_mean") - F.col("all.mean")) / F.col("all.std"))
        .filter(F.abs("z") > NOTABLE_Z)
        .withColumn("z_score", F.bround("z", 2))
    )
    rank = Window.partitionBy("cluster").orderBy(F.desc(F.abs("z_score")), order)
    level = F.when(F.abs("z") > VERY_Z, "very ").otherwise("")
    side = F.when(F.col("z") > 0, "HIGH").otherwise("LOW")
    return scored.select(
        "cluster",
        F.row_number().over(rank).alias("rank"),
        "feature",
        "cluster_mean",
        F.col("all.mean").alias("global_mean"),
        "z_score",
        F.concat(level, side).alias("description"),
        characteristic_text(F.col("feature"), F.col("z")).alias("summary"),
    )


def threshold_class(value: Column, classes: tuple) -> Column:
    """The label of the half-open range that holds the value."""
    edges, labels = classes
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, name in zip(edges, labels):
        label = label.when(value < edge, F.lit(name))
    return label.otherwise(F.lit(labels[-1]))


def quantile_class(value: Column, cuts: Column, labels: Sequence[str]) -> Column:
    """Low, middle or high word by two cuts; NULL where either is missing."""
    known = value.isNotNull() & cuts[0].isNotNull()
    return (
        F.when(known & (value <= cuts[0]), F.lit(labels[0]))
        .when(known & (value <= cuts[1]), F.lit(labels[1]))
        .when(known, F.lit(labels[2]))
    )


def moisture_class(rain: Column, humidity: Column) -> Column:
    """One word from the rain and humidity classes; either may be NULL."""
    is_in = lambda label, *names: F.coalesce(label.isin(*names), F.lit(False))
    return (
        F.when(is_in(rain, "Arid", "Semi-Arid") | is_in(humidity, "Dry"), "Dry")
        .when(is_in(rain, "Wet", "Very Wet") | is_in(humidity, "Humid", "Very Humid"), "Humid")
        .when(is_in(humidity, "Comfortable"), "Balanced")
        .when(is_in(rain, "Moderate") | is_in(humidity, "Moderate"), "Moderate")
        .otherwise(F.coalesce(humidity, rain))
    )


def climate_classes(df: DataFrame) -> DataFrame:
    """Per cluster: mean position, class words and the climate label made of them."""
    columns = {role: first_available(df, names) for role, names in CLASS_COLUMNS.items()}
    used = {role: c for role, c in columns.items() if c}
    means = df.groupBy("cluster").agg(
        F.avg(PLACE[0]).alias("lat_mean"),
        F.avg(PLACE[1]).alias("lon_mean"),
        *[F.avg(c).alias(role) for role, c in used.items()],
    )
    missing = F.lit(None).cast("string")
    words = [(role, used[role]) for role in ("wind", "solar") if role in used]
    if words:
        cuts = quantiles(df, [c for _, c in words], CLASS_QUANTILES)
        means = with_one_row(means, cuts, "_cuts")

    def by_threshold(role: str, classes: tuple) -> Column:
        return threshold_class(F.col(role), classes) if role in used else missing

    def by_quantile(role: str, labels: Sequence[str]) -> Column:
        if role not in used:
            return missing
        return quantile_class(F.col(role), F.col(f"_cuts.{used[role]}"), labels)

    classed = means.select(
        "cluster",
        "lat_mean",
        "lon_mean",
        by_threshold("temperature", TEMPERATURE_CLASSES).alias("temperature_class"),
        by_threshold("rain", RAIN_CLASSES).alias("rain_class"),
        by_threshold("humidity", HUMIDITY_CLASSES).alias("humidity_class"),
        by_quantile("wind", WIND_WORDS).alias("wind_class"),
        by_quantile("solar", SOLAR_WORDS).alias("solar_class"),
    ).withColumn("moisture_class", moisture_class(F.col("rain_class"), F.col("humidity_class")))
    text = F.concat_ws(" ", "temperature_class", "moisture_class", "wind_class", "solar_class")
    plain = F.concat(F.lit("Cluster "), F.col("cluster"))
    return classed.withColumn("climate_label", F.when(text == "", plain).otherwise(text))


def regional_name(lat: Column, lon: Column, otherwise: Column) -> Column:
    """Name of the region that holds a position; the first matching rule counts."""
    # Rules in order.
    return (
        F.when(lat >= 33.3, "Upper Himalayan Cold Pocket")
        .when(lat >= 31.5, "Western Himalayan Highlands")
        .when((lat >= 29.0) & (lon <= 79.5), "Northwest Highland Transition")
        .when((lon >= 88.0) & (lat >= 23.0), "Northeast Humid Belt")
        .when((lon <= 74.5) & (lat >= 20.0), "Northwest Dry Plains")
        .when(lon.between(76.0, 88.5) & (lat >= 24.0), "Gangetic Alluvial Plains")
        .when((lon >= 81.5) & (lat >= 18.0) & (lat < 24.5), "East-Central Monsoon Corridor")
        .when(
            (lon >= 73.0) & (lon < 81.5) & (lat >= 18.0) & (lat < 24.5), "Central Inland Plateau"
        )
        .when((lat < 18.5) & (lon >= 76.0), "Southern Peninsular Belt")
        .when((lat < 19.5) & (lon < 76.0), "Western Coastal South")
        .when((lon >= 82.0) & (lat < 24.0), "Eastern Coastal Transition")
        .otherwise(otherwise)
    )


def cluster_labels(df: DataFrame) -> DataFrame:
    """(cluster, cluster_label, summary): a name per cluster."""
    name = F.when(F.col("cluster") < 0, F.lit(NOISE_LABEL)).otherwise(
        regional_name(F.col("lat_mean"), F.col("lon_mean"), F.col("climate_label"))
    )
    return climate_classes(df).select("cluster", name.alias("cluster_label")).withColumn(
        "summary",
        F.concat(
            F.lit("This location fits a "), F.lower("cluster_label"), F.lit(" climate pattern.")
        ),
    )


def attach_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with the label of their cluster; clusters without one are unassigned."""
    kept = df.drop("cluster_label")
    found = kept.join(labels.select("cluster", "cluster_label"), "cluster", "left")
    label = F.coalesce("cluster_label", F.lit(UNASSIGNED_LABEL)).alias("cluster_label")
    return found.select(*kept.columns, label)


def nearest_examples(
    queries: DataFrame,
    places: DataFrame,
    n: int = 3,
    query_id: str = "query_id",
    block_rows: int = pairs.BLOCK_ROWS,
) -> DataFrame:
    """The n nearest places of the same cluster, by distance in degrees.

    One row per query and example: rank, coordinates and distance. Ties go by
    latitude and longitude. Only places near a query are compared with it.
    """
    spot = lambda df: F.array(*[F.col(c).cast("double") for c in PLACE]).alias("x")
    cluster = F.col("cluster").alias("g")
    def spots(df: DataFrame) -> DataFrame:
        known = df.filter("cluster IS NOT NULL").select(spot(df), cluster).distinct()
        return materialize(known.withColumns({"pid": F.monotonically_increasing_id(), "w": F.lit(1).cast("long")}))

    targets, asked = spots(places), spots(queries)
    right = pairs.blocked(targets, block_rows)
    left = pairs.placed_in(asked, right, block_rows)
    near = pairs.neighbours(left, right, n).select("pid", F.explode("near").alias("e"))
    found = near.select("pid", F.col("e.id").alias("id"), F.col("e.d").alias("d")).join(
        targets.select(F.col("pid").alias("id"), F.col("x").alias("at")), "id"
    )
    asked_at = asked.select("pid", "x", "g")
    rank = Window.partitionBy("pid").orderBy("d", F.col("at")[0], F.col("at")[1])
    ranked = found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= n)
    answer = ranked.join(asked_at, "pid")
    return queries.select(
        query_id, F.col("cluster").alias("g"), spot(queries)
    ).join(answer, ["g", "x"]).select(
        query_id,
        "rank",
        F.bround(F.col("at")[0], 4).alias("latitude"),
        F.bround(F.col("at")[1], 4).alias("longitude"),
        F.bround("d", 4).alias("distance_deg"),
    )
