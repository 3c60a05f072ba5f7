"""Grids of places: generation, summary, land mask, sampling."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridclime.functions.columns import with_one_row
from gridclime.functions.quantiles import quantiles
from gridclime.registry import KM_PER_DEGREE, REGIONS

POINT_FORMAT = "PT_%05d"


def axis_length(low: float, high: float, spacing: float) -> int:
    """Steps in the half-open range [low, high + spacing)."""
    return math.ceil((high + spacing - low) / spacing)


def grid(spark: SparkSession, region: str | tuple = "india") -> DataFrame:
    """Every place of a region, latitude first: point_id, latitude, longitude."""
    bounds = REGIONS[region] if isinstance(region, str) else region
    lat_min, lat_max, lon_min, lon_max, spacing = bounds
    n_lat = axis_length(lat_min, lat_max, spacing)
    n_lon = axis_length(lon_min, lon_max, spacing)
    step = F.lit(float(spacing))
    return spark.range(n_lat * n_lon).select(
        F.format_string(POINT_FORMAT, "id").alias("point_id"),
        F.bround(lat_min + F.floor(F.col("id") / n_lon) * step, 4).alias("latitude"),
        F.bround(lon_min + (F.col("id") % n_lon) * step, 4).alias("longitude"),
    )


def point_number(point_id="point_id"):
    return F.substring_index(point_id, "_", -1).cast("bigint")


def renumber(places: DataFrame, block: int = 100_000) -> DataFrame:
    """New dense point ids in the order of the old ones.

    Old numbers are unique, so a block of them holds at most ``block`` rows:
    rows are ranked inside blocks and only block sizes are summed across.
    """
    numbered = places.withColumn("_n", point_number()).withColumn(
        "_block", F.floor(F.col("_n") / block)
    )
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_block")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_block").orderBy("_n")) - 1
    return (
        numbered.withColumn("_rank", within)
        .join(offsets, "_block")
        .withColumn("point_id", F.format_string(POINT_FORMAT, F.col("_rank") + F.col("_offset")))
        .select(*places.columns)
    )


def ring_edges(spark: SparkSession, ring) -> DataFrame:
    """Edges (x1, y1, x2, y2) of a ring of (longitude, latitude) corners."""
    corners = [(float(x), float(y)) for x, y in ring]
    closed = [*corners, corners[0]]
    rows = [(*a, *b) for a, b in zip(closed, closed[1:])]
    return spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double")


def inside(
    places: DataFrame, edges: DataFrame, band: float = 1.0, spread: int = 32
) -> DataFrame:
    """Places inside the boundary: an odd number of edges lies to their east.

    Edges meet places by latitude band, an equi-join that needs no bound on the
    size of either side. The places of a band are spread over ``spread`` parts
    by longitude, each with a copy of the band's edges.
    """
    parts = F.sequence(F.lit(0), F.lit(spread - 1))
    banded = edges.withColumn(
        "_band",
        F.explode(
            F.sequence(
                F.floor(F.least("y1", "y2") / band), F.floor(F.greatest("y1", "y2") / band)
            )
        ),
    ).withColumn("_part", F.explode(parts))
    x_cross = F.col("x1") + (F.col("latitude") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (
        F.col("y2") - F.col("y1")
    )
    straddles = (F.col("y1") > F.col("latitude")) != (F.col("y2") > F.col("latitude"))
    spots = places.select("latitude", "longitude").distinct()
    crossed = (
        spots.withColumn("_band", F.floor(F.col("latitude") / band))
        .withColumn("_part", F.pmod(F.hash("longitude"), F.lit(spread)))
        .join(banded, ["_band", "_part"])
        .filter(F.when(straddles, F.col("longitude") < x_cross))
        .groupBy("latitude", "longitude")
        .agg(F.count(F.lit(1)).alias("_crossings"))
        .filter(F.col("_crossings") % 2 == 1)
    )
    return places.join(crossed, ["latitude", "longitude"], "left_semi").select(*places.columns)


def land_mask(places: DataFrame, edges: DataFrame) -> DataFrame:
    return renumber(inside(places, edges))


def sample_head(places: DataFrame, limit: int) -> DataFrame:
    """The first places by id."""
    return places.withColumn("_n", point_number()).orderBy("_n").limit(limit).drop("_n")


def sample_stratified(places: DataFrame, limit: int) -> DataFrame:
    """Spread ``limit`` places over quantile cells of latitude and longitude.

    Takes the first place of every cell, then the second, and so on; inside the
    last tier places go by latitude and longitude. All places if there are no
    more than ``limit``.
    """
    bins = max(2, min(int(math.sqrt(limit)), 12))
    counts = places.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("latitude").alias("latitude"),
        F.count_distinct("longitude").alias("longitude"),
    ).first()
    if limit >= counts["n"]:
        return places
    cells = places
    for axis in ("latitude", "longitude"):
        parts = min(bins, counts[axis])
        edges = quantiles(places, [axis], [i / parts for i in range(parts + 1)])
        cells = with_one_row(cells, edges, f"_{axis}_edges")
        inner = F.array_distinct(F.col(f"_{axis}_edges.{axis}"))
        # Right-closed bins: the number of edges below the value, at least 1.
        below = F.size(F.filter(inner, lambda edge: edge < F.col(axis)))
        cells = cells.withColumn(f"_{axis}_bin", F.greatest(below, F.lit(1)))
    cell = ["_latitude_bin", "_longitude_bin"]
    # Only the first ``limit`` of a cell matter: they are found in parts first,
    # so a crowded cell is not ranked whole in one task.
    part = Window.partitionBy(*cell, point_number() % 64).orderBy(point_number())
    whole = Window.partitionBy(*cell).orderBy(point_number())
    few = cells.withColumn("_rank", F.row_number().over(part)).filter(F.col("_rank") <= limit)
    return (
        few.withColumn("_rank", F.row_number().over(whole))
        .filter(F.col("_rank") <= limit)
        .orderBy("_rank", "latitude", "longitude")
        .limit(limit)
        .select(*places.columns)
    )


def grid_summary(places: DataFrame, spacing: float) -> DataFrame:
    return places.agg(
        F.count(F.lit(1)).alias("total_points"),
        F.min("latitude").alias("lat_min"),
        F.max("latitude").alias("lat_max"),
        F.min("longitude").alias("lon_min"),
        F.max("longitude").alias("lon_max"),
        F.lit(float(spacing)).alias("grid_spacing"),
        F.lit(float(spacing * KM_PER_DEGREE)).alias("approx_resolution_km"),
    )
