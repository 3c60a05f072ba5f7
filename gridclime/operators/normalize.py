"""Raw columns to common names, and merging of two daily sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclime.registry import ALIASES, PLACE, RAW_CODES, SET_FROM_MEAN

AGREEMENT_PAIRS = (
    ("temperature_2m_mean", "nasa_temperature_2m"),
    ("precipitation_sum", "nasa_precipitation"),
    ("wind_speed_10m_mean", "nasa_wind_speed_10m"),
)


def rename_codes(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in RAW_CODES.items() if k in df.columns})


def add_aliases(df: DataFrame) -> DataFrame:
    """Common names for raw columns, where the name is still free."""
    return df.withColumns(
        {
            alias: F.col(source)
            for alias, source in ALIASES.items()
            if source in df.columns and alias not in df.columns
        }
    )


def fill_from_mean(df: DataFrame, keep_existing: bool = False) -> DataFrame:
    """Set daily extremes and cloud layers to the daily mean.

    Overwrites columns that exist, unless ``keep_existing``.
    """
    return df.withColumns(
        {
            target: F.col(mean)
            for mean, targets in SET_FROM_MEAN.items()
            if mean in df.columns
            for target in targets
            if not (keep_existing and target in df.columns)
        }
    )


def normalize(df: DataFrame, keep_existing: bool = False) -> DataFrame:
    return fill_from_mean(add_aliases(rename_codes(df)), keep_existing)


def common_dates(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sources limited to the date range they share.

    The two bounds are fetched, so that the filters are on literals and reach
    the scans.
    """
    span = lambda df: df.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    bounds = (
        span(left)
        .unionByName(span(right))
        .agg(F.max("lo").alias("start"), F.min("hi").alias("end"))
    )

    start, end = bounds.first()
    shared = F.col("date").between(F.lit(start), F.lit(end))
    return left.filter(shared), right.filter(shared)


def _matched(left: DataFrame, right: DataFrame, how: str, place: Sequence[str]) -> DataFrame:
    """Join on coordinates rounded to 1 digit and date; right columns get a suffix on collision."""
    spots = [f"_{c}" for c in place]
    rounded = [F.bround(c, 1).alias(s) for c, s in zip(place, spots)]
    taken = set(left.columns)
    right_columns = [
        F.col(c).alias(f"{c}_nasa" if c in taken else c)
        for c in right.columns
        if c != "date" and c not in place
    ]
    return (
        left.select("*", *rounded)
        .join(right.select("date", *rounded, *right_columns), [*spots, "date"], how)
        .drop(*spots)
    )


def merge_sources(left: DataFrame, right: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """All rows of the first source with the second beside them where it matches."""
    left, right = common_dates(left, rename_codes(right))
    merged = _matched(left, right, "left", place)
    return merged.select(*left.columns, *[c for c in merged.columns if c not in left.columns])


def merge_quality(merged: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """One row: sizes, date range, match percent and missing share per column."""
    second = [c for c in merged.columns if c.startswith("nasa_")]
    total = F.count(F.lit(1))
    matched = F.count(second[0]) if second else F.lit(0)
    share = lambda c: F.count_if(F.col(c).isNull()) / F.when(total > 0, total)
    return merged.agg(
        total.alias("total_rows"),
        F.lit(len(merged.columns)).cast("bigint").alias("total_columns"),
        F.count_distinct(F.struct(*place)).alias("unique_places"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.lit(len(merged.columns) - len(second)).cast("bigint").alias("first_source_columns"),
        F.lit(len(second)).cast("bigint").alias("second_source_columns"),
        (matched / F.when(total > 0, total) * 100).alias("match_pct"),
        *[share(c).alias(f"missing_{c}") for c in merged.columns],
    )


def agreement(
    left: DataFrame, right: DataFrame, pairs=AGREEMENT_PAIRS, place: Sequence[str] = PLACE
) -> DataFrame:
    """Pearson correlation of variable pairs over all matching place-days; NULL if one of the two never varies."""
    both = _matched(left, rename_codes(right), "inner", place)

    def correlation(a: str, b: str) -> Column:
        known = F.col(a).isNotNull() & F.col(b).isNotNull()
        one, two = F.when(known, F.col(a)), F.when(known, F.col(b))
        spread = F.stddev_pop(one) * F.stddev_pop(two)
        return F.covar_pop(one, two) / F.when(spread > 0, spread)

    wide = both.agg(
        F.count(F.lit(1)).alias("pairs"), *[correlation(a, b).alias(a) for a, b in pairs]
    )
    return wide.unpivot(["pairs"], [a for a, _ in pairs], "variable", "pearson_r")
