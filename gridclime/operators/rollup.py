"""Rollups over time: hourly to daily, monthly, seasonal, yearly, normals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclime.functions.columns import numeric_columns, ratio_or
from gridclime.functions.lineage import materialize
from gridclime.operators.features import add_features
from gridclime.registry import (
    HOURLY_RULES,
    MAX_COLUMNS,
    MIN_COLUMNS,
    PLACE,
    ROLLUP_KEYS,
    SEASONAL_COLUMNS,
    SEASONS,
    SUM_COLUMNS,
    VARIABILITY_COLUMNS,
)


def _sum(column) -> Column:
    """A sum that is 0, not NULL, over no values."""
    return F.coalesce(F.sum(column), F.lit(0))


STATISTICS = {
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "std": F.stddev_samp,
    "sum": _sum,
    "mode": lambda c: F.mode(c, True),
}

#: Columns whose monthly figures describe a year's course.
MONTH_COLUMNS = ("precipitation_sum", "temperature_2m_mean")


def _hour_counts() -> dict[str, tuple[str, Column]]:
    t, p, w = F.col("temperature_2m"), F.col("precipitation"), F.col("wind_speed_10m")
    h, c = F.col("relative_humidity_2m"), F.col("cloud_cover")
    return {
        "frost_hours": ("temperature_2m", t < 0),
        "hot_hours": ("temperature_2m", t > 35),
        "comfortable_hours": ("temperature_2m", t.between(18, 28)),
        "precipitation_hours": ("precipitation", p > 0),
        "dry_hours": ("precipitation", p == 0),
        "calm_hours": ("wind_speed_10m", w < 5),
        "strong_wind_hours": ("wind_speed_10m", w > 40),
        "high_humidity_hours": ("relative_humidity_2m", h > 90),
        "low_cloud_hours": ("cloud_cover", c < 20),
        "overcast_hours": ("cloud_cover", c > 80),
    }


def hourly_to_daily(hourly: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """Daily statistics and hour counts of every parameter present."""
    have = set(hourly.columns)
    stats = [
        STATISTICS[stat](name).alias(f"{name}_{stat}")
        for name, wanted in HOURLY_RULES.items()
        if name in have
        for stat in wanted
    ]
    hours = [
        F.count_if(test).alias(name)
        for name, (needs, test) in _hour_counts().items()
        if needs in have
    ]
    return hourly.groupBy(*place, F.to_date("hour").alias("date")).agg(*stats, *hours)


def rule(column: str) -> str:
    """How a daily column is rolled up."""
    if column in SUM_COLUMNS:
        return "sum"
    if column in MAX_COLUMNS:
        return "max"
    if column in MIN_COLUMNS:
        return "min"
    return "mode" if "mode" in column else "mean"


def value_columns(df: DataFrame) -> list[str]:
    return numeric_columns(df, exclude=ROLLUP_KEYS)


def season_of(month: Column) -> Column:
    cases = [F.when(month.isin(*months), F.lit(name)) for name, months in SEASONS.items()]
    return F.coalesce(*cases)


def season_year_of(year: Column, month: Column) -> Column:
    """December opens the winter of the next year."""
    return year + (month == 12).cast("int")


def season_suffix(season: str) -> str:
    return season.lower().replace("-", "_").replace(" ", "_")


def _rolled(daily: DataFrame, keys: dict[str, Column], place: Sequence[str]) -> DataFrame:
    located = reduce(lambda df, c: df.filter(F.col(c).isNotNull()), place, daily)
    groups = [column.alias(name) for name, column in keys.items()]
    return located.groupBy(*place, *groups).agg(
        *[STATISTICS[rule(c)](c).alias(c) for c in value_columns(daily)],
        F.count("date").alias("days_count"),
    )


def to_monthly(daily: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    return _rolled(daily, {"year": F.year("date"), "month": F.month("date")}, place)


def to_seasonal(daily: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    year, month = F.year("date"), F.month("date")
    return _rolled(
        daily, {"season_year": season_year_of(year, month), "season": season_of(month)}, place
    )


def to_yearly(daily: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    return _rolled(daily, {"year": F.year("date")}, place)


def month_parts(daily: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """Sums, counts and extremes per place, year and month.

    Everything the normals need can be combined from these, so the daily rows
    are shuffled once and every later step works on a thirtieth of them.
    """
    parts = []
    for c in value_columns(daily):
        parts += [F.sum(c).alias(f"s_{c}"), F.count(c).alias(f"n_{c}")]
        if rule(c) in ("max", "min"):
            parts.append(STATISTICS[rule(c)](c).alias(f"x_{c}"))
    return (
        daily.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in place]))
        .groupBy(*place, F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(*parts)
    )


def _combined(column: str) -> Column:
    """A column's rollup from month parts."""
    how = rule(column)
    if how == "sum":
        return _sum(f"s_{column}")
    if how in ("max", "min"):
        return STATISTICS[how](f"x_{column}")
    return _mean(column)


def _mean(column: str) -> Column:
    n = F.sum(f"n_{column}")
    return F.sum(f"s_{column}") / F.when(n > 0, n)


def _columns_of(parts: DataFrame) -> list[str]:
    return [c[2:] for c in parts.columns if c.startswith("n_")]


def place_means(parts: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """Mean of every daily column, sums and extremes included."""
    return parts.groupBy(*place).agg(*[_mean(c).alias(c) for c in _columns_of(parts)])


def place_parts(parts: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """The means of every place, and ``months``: the parts that years, seasons and months are made of.

    Most columns are needed as a mean only, so one row per place, as long as the
    calendar, is a small share of all month parts.
    """
    rolled = {*VARIABILITY_COLUMNS, *SEASONAL_COLUMNS, *MONTH_COLUMNS}
    kept = [c for c in parts.columns if c in ("year", "month") or (c[1] == "_" and c[2:] in rolled)]
    return parts.groupBy(*place).agg(
        *[_mean(c).alias(c) for c in _columns_of(parts)], F.collect_list(F.struct(*kept)).alias("months")
    )


def interannual(parts: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """Sample standard deviation over years, and the mean yearly rain."""
    columns = [c for c in VARIABILITY_COLUMNS if c in _columns_of(parts)]
    yearly = parts.groupBy(*place, "year").agg(*[_combined(c).alias(c) for c in columns])
    out = [F.stddev_samp(c).alias(f"{c}_interannual_std") for c in columns]
    if "precipitation_sum" in columns:
        out.append(F.avg("precipitation_sum").alias("_yearly_rain"))
    return yearly.groupBy(*place).agg(*out)


def seasonal_signatures(parts: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """Mean over years of each season's rollup, one column per feature and season."""
    columns = [c for c in SEASONAL_COLUMNS if c in _columns_of(parts)]
    seasonal = parts.groupBy(
        *place,
        season_year_of(F.col("year"), F.col("month")).alias("season_year"),
        season_of(F.col("month")).alias("season"),
    ).agg(*[_combined(c).alias(c) for c in columns])
    return seasonal.groupBy(*place).agg(
        *[
            F.avg(F.when(F.col("season") == name, F.col(c))).alias(f"{c}_{season_suffix(name)}")
            for c in columns
            for name in SEASONS
        ]
    )


def month_profile(parts: DataFrame, columns: Sequence[str], place: Sequence[str] = PLACE) -> DataFrame:
    """Mean over years by calendar month of the monthly rollup."""
    monthly = parts.groupBy(*place, "year", "month").agg(*[_combined(c).alias(c) for c in columns])
    return monthly.groupBy(*place, "month").agg(*[F.avg(c).alias(c) for c in columns])


def month_seasonality(parts: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """How rain and temperature vary over the calendar months."""
    columns = [c for c in MONTH_COLUMNS if c in _columns_of(parts)]
    profile = month_profile(parts, columns, place)
    out = []
    if "precipitation_sum" in columns:
        rain = F.col("precipitation_sum")
        mean, total = F.avg(rain), F.sum(rain)
        wettest = F.max(F.when(rain.isNotNull(), F.struct(rain, (-F.col("month")).alias("m"))))
        out += [
            F.coalesce(F.stddev_samp(rain) / F.when(mean != 0, mean), F.lit(0.0)).alias(
                "rainfall_seasonality_index"
            ),
            F.coalesce(F.max(rain) / F.when(total != 0, total), F.lit(0.0)).alias(
                "peak_month_rainfall_share"
            ),
            (-wettest["m"]).cast("double").alias("wettest_month"),
        ]
    if "temperature_2m_mean" in columns:
        heat = F.col("temperature_2m_mean")
        out += [
            F.max(heat).alias("monthly_temp_peak"),
            F.min(heat).alias("monthly_temp_trough"),
            F.stddev_samp(heat).alias("monthly_temp_variability"),
            (F.max(heat) - F.min(heat)).alias("annual_temp_cycle_range"),
        ]
    return profile.groupBy(*place).agg(*out)


# Contrast -> (season column, season column subtracted).
CONTRASTS = {
    "pre_monsoon_heat_contrast": ("temperature_2m_mean_pre_monsoon", "temperature_2m_mean_winter"),
    "seasonal_humidity_contrast": (
        "relative_humidity_2m_mean_monsoon",
        "relative_humidity_2m_mean_pre_monsoon",
    ),
    "seasonal_wind_contrast": ("wind_speed_10m_mean_monsoon", "wind_speed_10m_mean_winter"),
    "seasonal_cloud_contrast": ("cloud_cover_mean_monsoon", "cloud_cover_mean_winter"),
}
# Ratio -> (numerator, denominator). The first divides a season's
# total by a daily mean, so it exceeds 1; the second is the share of a year.
RATIOS = {
    "monsoon_rainfall_share": ("precipitation_sum_monsoon", "precipitation_sum"),
    "monsoon_rainfall_share_annual": ("precipitation_sum_monsoon", "_yearly_rain"),
    "winter_to_monsoon_solar_ratio": (
        "shortwave_radiation_sum_winter",
        "shortwave_radiation_sum_monsoon",
    ),
}


def contrasts(normals: DataFrame) -> DataFrame:
    have = set(normals.columns)
    wanted = {
        name: F.col(a) - F.col(b) for name, (a, b) in CONTRASTS.items() if {a, b} <= have
    }
    wanted |= {
        name: ratio_or(F.col(a), F.col(b), 0) for name, (a, b) in RATIOS.items() if {a, b} <= have
    }
    return normals.withColumns(wanted)


def normals(
    daily: DataFrame, refeature: bool = False, scope: str = "table", place: Sequence[str] = PLACE
) -> DataFrame:
    """Long-term figures, one row per place.

    With ``refeature`` the row features are computed again from the means and
    replace their own averages.
    """
    stored = materialize(place_parts(month_parts(daily, place), place))
    parts = stored.select(*place, F.inline("months"))
    tables = [f(parts, place) for f in (interannual, seasonal_signatures, month_seasonality)]
    joined = reduce(lambda a, b: a.join(b, list(place), "left"), tables, stored.drop("months"))
    out = contrasts(joined).drop("_yearly_rain")
    return add_features(out, scope=scope, place=place) if refeature else out
