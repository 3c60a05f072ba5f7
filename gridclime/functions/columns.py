"""Small Column and DataFrame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclime.registry import EARTH_RADIUS_KM, MISSING_SENTINEL


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric column names in schema order; a plan-time test."""
    skip = set(exclude)
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in skip
    ]


def clip(value: Column, low: Column | float, high: Column | float) -> Column:
    """Limit to [low, high]; NULL stays NULL and a NULL limit does not apply."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def ratio_or(numerator: Column, denominator: Column, otherwise: Column | float | None) -> Column:
    """numerator / denominator where the denominator is positive, else a default."""
    return F.when(denominator > 0, numerator / denominator).otherwise(
        otherwise if isinstance(otherwise, Column) else F.lit(otherwise).cast("double")
    )


def flag(condition: Column) -> Column:
    """1 where the condition holds; 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def known(value: Column) -> Column:
    """Sentinel and NaN become NULL."""
    value = value.cast("double")
    return F.when(~F.isnan(value) & (value != MISSING_SENTINEL), value)


def truthy_or(value: Column, default: float) -> Column:
    """The value, or the default where it is missing or exactly zero."""
    return F.when(value.isNull() | (value == 0), F.lit(float(default))).otherwise(value)


def unit(value: Column) -> Column:
    return clip(value, 0.0, 1.0)


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance on a sphere."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def first_available(df: DataFrame, names: Sequence[str]) -> str | None:
    return next((name for name in names if name in df.columns), None)


def with_one_row(df: DataFrame, stats: DataFrame, name: str) -> DataFrame:
    """Add a one-row result to every row as a struct, by scalar subquery."""
    return df.withColumn(name, stats.select(F.struct("*")).scalar())


def as_lookup(df: DataFrame, key: str, value: str | Column, limit: int = 100_000) -> DataFrame:
    """A small keyed table as one row holding one map; fails beyond ``limit`` keys.

    Meant for tables with one row per cluster. The row count is checked before
    the entries are gathered, so a large table is refused, not collected.
    """
    value = F.col(value) if isinstance(value, str) else value
    size = df.select(F.count(F.lit(1))).scalar()
    entry = F.when(
        size > limit, F.raise_error(F.lit(f"lookup table has more than {limit} rows"))
    ).otherwise(F.struct(F.col(key), value))
    return df.select(entry.alias("entry")).agg(
        F.map_from_entries(F.collect_list("entry")).alias("lookup")
    )


def euclidean(a: Column, b: Column) -> Column:
    """Distance of two arrays of doubles."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
