"""Numbers behind exploration charts."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclime.functions.columns import numeric_columns, with_one_row
from gridclime.functions.lineage import materialize
from gridclime.functions.quantiles import quantiles
from gridclime.operators.rollup import season_of, to_monthly, to_seasonal, to_yearly
from gridclime.registry import NOISE_LABEL, PLACE, SEASONS, UNASSIGNED_LABEL

QUARTERS = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, value) cells."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(*by, F.inline(cells))


def _quantile_rows(
    df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """(by, column, one column per quantile)."""
    found = quantiles(df, columns, list(probs.values()), by)
    cells = [
        F.struct(
            F.lit(c).alias("column"), *[F.col(c)[i].alias(name) for i, name in enumerate(probs)]
        )
        for c in columns
    ]
    return found.select(*by, F.inline(F.array(*cells)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, std, extremes, quartiles, P1, P99 and IQR, one row per column.

    The columns are stored, since they are read three times.
    """
    columns = list(columns)
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    rows = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    wide = rows.agg(*[F.struct(*[f(c).alias(name) for name, f in stats.items()]).alias(c) for c in columns])
    moments = wide.unpivot([], columns, "column", "m").select("column", "m.*")
    cuts = _quantile_rows(rows, columns, {"p1": 0.01, **QUARTERS, "p99": 0.99})
    return moments.join(cuts, "column").withColumn("iqr", F.col("q75") - F.col("q25"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, count) with equal widths; the last bin holds the maximum."""
    span = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    ranged = with_one_row(df.filter(F.col(column).isNotNull()).select(column), span, "_s")
    lo, width = F.col("_s.lo"), (F.col("_s.hi") - F.col("_s.lo")) / bins
    place = F.floor((F.col(column) - lo) / F.when(width > 0, width))
    bin_ = F.coalesce(F.least(place, F.lit(bins - 1)), F.lit(0))
    counted = ranged.groupBy(bin_.alias("bin"), "_s").agg(F.count(F.lit(1)).alias("count"))
    return counted.select(
        "bin",
        (lo + F.col("bin") * width).alias("low"),
        (lo + (F.col("bin") + 1) * width).alias("high"),
        "count",
    )


def _pair_moments(batch: pa.RecordBatch) -> np.ndarray:
    """[n, mean of a, squares of a about it, products about the means], each for all (a, b), over rows that know both."""
    x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
    known = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float)
    middle = np.where(known, x, 0).sum(axis=0) / np.maximum(known.sum(axis=0), 1)
    gap = np.where(known > 0, x - middle, 0)
    n = known.T @ known
    held = np.maximum(n, 1)
    shift = gap.T @ known
    return np.stack([n, middle[:, None] + shift / held, (gap * gap).T @ known - shift * shift / held, gap.T @ gap - shift * shift.T / held])


def _together(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The moments of both parts."""
    n = one[0] + two[0]
    step = two[1] - one[1]
    share = one[0] * two[0] / np.maximum(n, 1)
    return np.stack([n, one[1] + step * two[0] / np.maximum(n, 1), one[2] + two[2] + step * step * share, one[3] + two[3] + step * step.T * share])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) of every two columns; NULLs are dropped pair by pair. NULL if one of the two never varies.

    One read of the rows, however many columns: a task gives the moments of all
    pairs, which are then put together about the means of all tasks.
    """
    pairs = list(combinations(range(len(columns)), 2))
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    a, b = np.array(pairs).T
    names = ["pair", "n", "ma", "mb", "qa", "qb", "c"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                found = _pair_moments(batch)
                held = found if held is None else _together(held, found)
        if held is not None:
            n, mean, square, product = held
            cells = [np.arange(len(a)), n[a, b], mean[a, b], mean[b, a], square[a, b], square[b, a], product[a, b]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=names)

    values = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    parts = materialize(values.mapInArrow(work, "pair long, " + ", ".join(f"{c} double" for c in names[1:])))
    known = F.when(F.sum("n") > 0, F.sum("n"))
    whole = parts.groupBy("pair").agg((F.sum(F.col("n") * F.col("ma")) / known).alias("A"), (F.sum(F.col("n") * F.col("mb")) / known).alias("B"))
    off = {c: F.col(m) - F.col(w) for c, m, w in (("x", "ma", "A"), ("y", "mb", "B"))}
    sums = parts.join(whole, "pair").withColumns(off).groupBy("pair").agg(
        F.sum(F.col("qa") + F.col("n") * F.col("x") * F.col("x")).alias("qa"),
        F.sum(F.col("qb") + F.col("n") * F.col("y") * F.col("y")).alias("qb"),
        F.sum(F.col("c") + F.col("n") * F.col("x") * F.col("y")).alias("c"),
    )
    spread = F.sqrt(F.greatest("qa", F.lit(0.0))) * F.sqrt(F.greatest("qb", F.lit(0.0)))
    title = lambda at: F.array(*[F.lit(columns[i]) for i in at])[F.col("pair").cast("int")]
    return sums.select(title(a.tolist()).alias("a"), title(b.tolist()).alias("b"), (F.col("c") / F.when(spread > 0, spread)).alias("r"))


def strong_pairs(df: DataFrame, columns: Sequence[str], above: float = 0.7) -> DataFrame:
    return correlations(df, columns).filter(F.abs("r") > above)


def means_by(df: DataFrame, keys: Mapping[str, Column], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        *[F.avg(c).alias(c) for c in columns]
    )


def means_by_month(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return means_by(df, {"month": F.month("date")}, columns)


def means_by_place(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return means_by(df, {c: F.col(c) for c in PLACE}, columns)


def means_by_season(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Seasons in the order of the year."""
    order = F.array_position(F.array(*[F.lit(s) for s in SEASONS]), F.col("season"))
    return means_by(df, {"season": season_of(F.month("date"))}, columns).orderBy(order)


def compass_region(lat: Column, lon: Column) -> Column:
    # Rules in order.
    return (
        F.when(lat > 28, "North")
        .when(lat < 15, "South")
        .when(lon > 85, "East")
        .when(lon < 73, "West")
        .otherwise("Central")
    )


def means_by_region(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return means_by(
        df, {"region": compass_region(F.col("latitude"), F.col("longitude"))}, columns
    )


def draw(key: Sequence[str], seed: int) -> Column:
    """A digest that puts keys into an arbitrary but reproducible order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]))


def sample_per_group(
    df: DataFrame, group: str, n: int, key: Sequence[str], seed: int = 42, spread: int = 64
) -> DataFrame:
    """At most n rows per group, chosen by a seeded digest of the key.

    A group is first limited inside ``spread`` salted parts, so the final
    ranking sees at most ``spread * n`` rows of it.
    """
    drawn = df.withColumn("_h", draw(key, seed))
    order = ["_h", *key]
    salt = F.pmod(F.xxhash64("_h"), F.lit(spread))
    part = Window.partitionBy(group, salt).orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    few = drawn.withColumn("_r", F.row_number().over(part)).filter(F.col("_r") <= n)
    kept = few.withColumn("_r", F.row_number().over(whole)).filter(F.col("_r") <= n)
    return kept.drop("_h", "_r")


def sample(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """n rows, chosen by a seeded digest of the key."""
    return df.orderBy(draw(key, seed), *key).limit(n)


def yearly_trend(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, slope, intercept) of the yearly means over the year."""
    yearly = means_by(df, {"year": F.year("date")}, columns)
    cells = _long(yearly, columns, ["year"])
    return cells.groupBy("column").agg(
        F.regr_slope("value", "year").alias("slope"),
        F.regr_intercept("value", "year").alias("intercept"),
    )


def box_statistics(df: DataFrame, columns: Sequence[str], by: str = "cluster") -> DataFrame:
    """Quartiles, mean, deviation, extremes and count per group and column."""
    columns = list(columns)
    moments = _long(df, columns, [by]).groupBy(by, "column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return moments.join(_quantile_rows(df, columns, QUARTERS, [by]), [by, "column"])


def label_shares(df: DataFrame, label: str = "cluster_label") -> DataFrame:
    """(label, count, share) of all rows."""
    total = df.select(F.count(F.lit(1))).scalar()
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("share", F.col("count") / total)


def headline(df: DataFrame) -> DataFrame:
    """One row: distinct places and clusters."""
    return df.agg(
        F.count_distinct(F.struct(*PLACE)).alias("places"),
        F.count_distinct("cluster").alias("clusters"),
    )


def scaled_profile(
    means: DataFrame, columns: Sequence[str], method: str = "zscore", key: str = "cluster"
) -> DataFrame:
    """A profile table scaled over its rows: population z-score, or to [0, 1]."""
    low, size = (F.avg, F.stddev_pop) if method == "zscore" else (F.min, lambda c: F.max(c) - F.min(c))
    stats = means.agg(
        *[F.struct(low(c).alias("low"), size(c).alias("size")).alias(c) for c in columns]
    )
    placed = with_one_row(means, stats, "_s")

    def scaled(c: str) -> Column:
        size = F.col(f"_s.{c}.size")
        return (F.col(c) - F.col(f"_s.{c}.low")) / F.when(size > 0, size).otherwise(F.lit(1.0))

    return placed.select(key, *[scaled(c).alias(c) for c in columns])


def cluster_ellipses(df: DataFrame, x: str, y: str, scale: float = 1.8) -> DataFrame:
    """Center, covariance, radii and angle of each cluster in a plane.

    Clusters of at least 3 points with a positive determinant.
    """
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    sums = both.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(x).alias("center_x"),
        F.avg(y).alias("center_y"),
        F.var_samp(x).alias("var_x"),
        F.var_samp(y).alias("var_y"),
        F.covar_samp(x, y).alias("cov_xy"),
    )
    half = (F.col("var_x") + F.col("var_y")) / 2
    root = F.sqrt(F.pow((F.col("var_x") - F.col("var_y")) / 2, F.lit(2.0)) + F.col("cov_xy") * F.col("cov_xy"))
    radius = lambda value: scale * F.sqrt(F.greatest(value, F.lit(1e-9)))
    det = F.col("var_x") * F.col("var_y") - F.col("cov_xy") * F.col("cov_xy")
    return sums.filter((F.col("n") >= 3) & (det > 0)).select(
        "*",
        radius(half + root).alias("radius_major"),
        radius(half - root).alias("radius_minor"),
        (F.atan2(2 * F.col("cov_xy"), F.col("var_x") - F.col("var_y")) / 2).alias("angle"),
    )


def map_scaled(df: DataFrame, column: str) -> DataFrame:
    """Add ``scaled``: the value between the column's extremes."""
    span = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    placed = with_one_row(df, span, "_s")
    value = (F.col(column) - F.col("_s.lo")) / (F.col("_s.hi") - F.col("_s.lo") + 1e-8)
    return placed.withColumn("scaled", value).drop("_s")


def generic_labels(df: DataFrame, cluster: str) -> DataFrame:
    """Rows under another model's clusters, with plain labels."""
    c = F.col(cluster)
    label = (
        F.when(c.isNull(), F.lit(UNASSIGNED_LABEL))
        .when(c < 0, F.lit(NOISE_LABEL))
        .otherwise(F.concat(F.lit("Cluster "), c))
    )
    return df.withColumn("cluster", c).withColumn("cluster_label", label)


def label_map(df: DataFrame) -> DataFrame:
    """One label per cluster."""
    return df.filter("cluster IS NOT NULL AND cluster_label IS NOT NULL").groupBy("cluster").agg(
        F.min("cluster_label").alias("cluster_label")
    )


def cluster_extents(df: DataFrame) -> DataFrame:
    """Mean position, coordinate ranges and coverage percent per cluster."""
    total = df.select(F.count(F.lit(1))).scalar()
    extents = df.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("points"),
        *[
            f(c).alias(f"{c}_{name}")
            for c in PLACE
            for name, f in (("mean", F.avg), ("min", F.min), ("max", F.max))
        ],
    )
    return extents.withColumn("coverage_pct", F.col("points") / total * 100)


def compare_stages(
    before: DataFrame, after: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Column descriptions before and after cleaning, with a ``stage`` column."""
    named = lambda df, stage: describe(df, columns).withColumn("stage", F.lit(stage))
    return named(before, "before").unionByName(named(after, "after"))


def place_series(daily: DataFrame, latitude: float, longitude: float, column: str) -> DataFrame:
    """One place's values at every resolution in time order; the first place if it is absent.

    (latitude, longitude, resolution, start, value). The place is looked up
    first, so that its filter is on literals; its rows are stored and read for
    every resolution.
    """
    asked = (F.col("latitude") == latitude) & (F.col("longitude") == longitude)
    first = F.min(F.struct(*PLACE))
    chosen = F.coalesce(F.min(F.when(asked, F.struct(*PLACE))), first)
    spot = daily.agg(chosen.alias("spot")).first()["spot"]
    here = F.lit(False)
    if spot is not None:
        here = (F.col("latitude") == spot["latitude"]) & (F.col("longitude") == spot["longitude"])
    one = materialize(daily.filter(here).select(*PLACE, "date", column))

    def part(df: DataFrame, name: str, start: Column) -> DataFrame:
        return df.select(
            *PLACE, F.lit(name).alias("resolution"), start.alias("start"), F.col(column).alias("value")
        )

    # The first month of each season, and its calendar year.
    opening = {name: months[0] for name, months in SEASONS.items()}
    month = reduce(
        lambda w, item: w.when(F.col("season") == item[0], F.lit(item[1])),
        opening.items(),
        F.when(F.lit(False), F.lit(0)),
    )
    year = F.col("season_year") - (month == 12).cast("int")
    parts = [
        part(one, "daily", F.col("date")),
        part(to_monthly(one), "monthly", F.make_date("year", "month", F.lit(1))),
        part(to_seasonal(one), "seasonal", F.make_date(year, month, F.lit(1))),
        part(to_yearly(one), "yearly", F.make_date("year", F.lit(1), F.lit(1))),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("resolution", "start")


def fill_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, filled_pct, mean, status) per numeric column."""
    columns = numeric_columns(df, exclude=PLACE) if columns is None else list(columns)
    pct = F.count("value") / F.count(F.lit(1)) * 100
    status = (
        F.when(F.col("filled_pct") > 90, "good")
        .when(F.col("filled_pct") > 50, "partial")
        .otherwise("poor")
    )
    return (
        _long(df, columns)
        .groupBy("column")
        .agg(pct.alias("filled_pct"), F.avg("value").alias("mean"))
        .withColumn("status", status)
    )
