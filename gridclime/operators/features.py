"""Features of a row. Each is added only where its inputs exist."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridclime.functions.columns import flag, ratio_or, with_one_row
from gridclime.registry import (
    AIR_DENSITY,
    FEATURES,
    PLACE,
    WIND_HEIGHTS_M,
    WIND_SHEAR_EXPONENTS,
)

# Feature -> (upper, lower), the difference of two columns.
DIFFERENCES = {
    "temp_range_daily": ("temperature_2m_max", "temperature_2m_min"),
    "apparent_temp_range": ("apparent_temperature_max", "apparent_temperature_min"),
    "humidity_range": ("relative_humidity_2m_max", "relative_humidity_2m_min"),
    "pressure_range": ("pressure_msl_max", "pressure_msl_min"),
    "cloud_stratification": ("cloud_cover_high_mean", "cloud_cover_low_mean"),
    "soil_air_temp_diff": ("nasa_earth_skin_temperature", "temperature_2m_mean"),
    "thermal_stress_index": ("apparent_temperature_mean", "temperature_2m_mean"),
}
# Flag -> (column, sign, threshold).
FLAGS = {
    "frost_risk": ("temperature_2m_min", "<", 0),
    "heat_stress": ("temperature_2m_max", ">", 40),
    "heavy_rain_flag": ("precipitation_sum", ">", 50),
    "extreme_rain_flag": ("precipitation_sum", ">", 100),
    "extreme_wind_flag": ("wind_gusts_10m_max", ">", 60),
    "storm_wind_flag": ("wind_gusts_10m_max", ">", 90),
    "pressure_instability": ("pressure_msl_std", ">", 5),
}
RANGES = (
    "temp_range_daily",
    "apparent_temp_range",
    "humidity_range",
    "pressure_range",
    "cloud_stratification",
)
HAZARD_FLAGS = (
    "heavy_rain_flag",
    "extreme_rain_flag",
    "extreme_wind_flag",
    "storm_wind_flag",
    "pressure_instability",
)
# Score -> hour counts summed and divided by 72.
HOUR_SCORES = {
    "outdoor_comfort_score": ("comfortable_hours", "dry_hours", "calm_hours"),
    "heat_island_potential": ("hot_hours", "calm_hours", "low_cloud_hours"),
}
GROWING_BASE = 10
Z_EPSILON = 1e-8


def _where_present(df: DataFrame, wanted: dict[str, tuple[Sequence[str], Column]]) -> DataFrame:
    have = set(df.columns)
    return df.withColumns(
        {name: column for name, (needs, column) in wanted.items() if have.issuperset(needs)}
    )


def core_features(df: DataFrame) -> DataFrame:
    """Ranges, mean temperature if absent, sunshine share, rain intensity."""
    ends = ("temperature_2m_max", "temperature_2m_min")
    if "temperature_2m_mean" not in df.columns:
        middle = (F.col(ends[0]) + F.col(ends[1])) / 2
        df = _where_present(df, {"temperature_2m_mean": (ends, middle)})
    wanted = {
        name: (pair, F.col(pair[0]) - F.col(pair[1]))
        for name, pair in DIFFERENCES.items()
        if name in RANGES
    }
    wanted["sunshine_fraction"] = (["low_cloud_hours"], F.col("low_cloud_hours") / 24.0)
    wanted["precipitation_intensity"] = (
        ["precipitation_sum", "precipitation_hours"],
        ratio_or(F.col("precipitation_sum"), F.col("precipitation_hours"), 0),
    )
    return _where_present(df, wanted)


def wind_features(df: DataFrame, terrain: str = "default") -> DataFrame:
    """Wind at greater heights by a power law, and the shear between 10 and 120 m."""
    if "wind_speed_10m_mean" not in df.columns:
        return df
    alpha = WIND_SHEAR_EXPONENTS[terrain]
    wanted = {
        f"wind_speed_{h}m_{stat}": (
            [f"wind_speed_10m_{stat}"],
            F.col(f"wind_speed_10m_{stat}") * (h / 10) ** alpha,
        )
        for h in WIND_HEIGHTS_M
        for stat in ("mean", "max")
    }
    df = _where_present(df, wanted)
    low, high = F.col("wind_speed_10m_mean"), F.col("wind_speed_120m_mean")
    shear = F.when((low > 0) & (high > 0), F.log(high / low) / math.log(120 / 10))
    return df.withColumn("wind_shear_coefficient", shear.otherwise(F.lit(alpha)))


def complementarity(
    df: DataFrame, scope: str = "table", place: Sequence[str] = PLACE
) -> DataFrame:
    """Minus the product of the solar and wind z-scores over the table or the place."""
    pair = ("shortwave_radiation_sum", "wind_speed_10m_mean")
    if not set(pair) <= set(df.columns):
        return df
    stats = [f(c).alias(f"{k}_{c}") for c in pair for k, f in (("m", F.avg), ("s", F.stddev_samp))]
    if scope == "table":
        out = with_one_row(df, df.agg(*stats), "_z")
    else:
        whole = Window.partitionBy(*place)
        named = [
            f(c).over(whole).alias(f"{k}_{c}")
            for c in pair
            for k, f in (("m", F.avg), ("s", F.stddev_samp))
        ]
        out = df.withColumn("_z", F.struct(*named))
    z = lambda c: (F.col(c) - F.col(f"_z.m_{c}")) / (F.col(f"_z.s_{c}") + Z_EPSILON)
    return out.withColumn("solar_wind_complementarity", -(z(pair[0]) * z(pair[1]))).drop("_z")


def energy_features(
    df: DataFrame, scope: str = "table", place: Sequence[str] = PLACE
) -> DataFrame:
    """Wind power density, solar utilization, solar-wind complementarity."""
    speed = {h: f"wind_speed_{h}m_mean" for h in WIND_HEIGHTS_M}
    wanted = {
        f"wind_power_density_{h}m": ([c], 0.5 * AIR_DENSITY * F.pow(F.col(c) / 3.6, F.lit(3.0)))
        for h, c in speed.items()
    }
    allsky, clearsky = "nasa_solar_irradiance_allsky", "nasa_solar_irradiance_clearsky"
    wanted["solar_utilization_ratio"] = (
        [allsky, clearsky],
        ratio_or(F.col(allsky), F.col(clearsky), 0),
    )
    return complementarity(_where_present(df, wanted), scope, place)


def _flags(names: Sequence[str]) -> dict[str, tuple[Sequence[str], Column]]:
    out = {}
    for name in names:
        column, sign, limit = FLAGS[name]
        test = F.col(column) < limit if sign == "<" else F.col(column) > limit
        out[name] = ([column], flag(test))
    return out


def agriculture_features(df: DataFrame) -> DataFrame:
    mean = F.col("temperature_2m_mean")
    rain, demand = "precipitation_sum", "et0_fao_evapotranspiration_sum"
    upper, lower = DIFFERENCES["soil_air_temp_diff"]
    wanted = {
        "growing_degree_days": (
            ["temperature_2m_mean"],
            F.when(mean.isNotNull(), F.greatest(F.lit(0.0), mean - GROWING_BASE)),
        ),
        **_flags(["frost_risk", "heat_stress"]),
        "aridity_index": ([rain, demand], ratio_or(F.col(rain), F.col(demand), None)),
        "soil_temp_proxy": ([upper], F.col(upper)),
        "soil_air_temp_diff": ([upper, lower], F.col(upper) - F.col(lower)),
    }
    return _where_present(df, wanted)


def hazard_features(df: DataFrame) -> DataFrame:
    df = _where_present(df, _flags(HAZARD_FLAGS))
    product = F.col("heavy_rain_flag") * F.col("precipitation_hours")
    needs = ["heavy_rain_flag", "precipitation_hours"]
    return _where_present(df, {"flood_risk_indicator": (needs, product)})


def urban_features(df: DataFrame) -> DataFrame:
    pair = DIFFERENCES["thermal_stress_index"]
    wanted = {"thermal_stress_index": (pair, F.col(pair[0]) - F.col(pair[1]))}
    for name, hours in HOUR_SCORES.items():
        wanted[name] = (hours, sum((F.col(h) for h in hours[1:]), F.col(hours[0])) / 72)
    return _where_present(df, wanted)


def add_features(
    df: DataFrame, terrain: str = "default", scope: str = "table", place: Sequence[str] = PLACE
) -> DataFrame:
    """Every feature whose inputs are present."""
    df = wind_features(core_features(df), terrain)
    df = agriculture_features(energy_features(df, scope, place))
    return urban_features(hazard_features(df))


def feature_registry(spark: SparkSession) -> DataFrame:
    """The feature catalogue as a table: feature, unit, tier, source, domain."""
    rows = [(name, *values) for name, values in FEATURES.items()]
    return spark.createDataFrame(
        rows, "feature string, unit string, tier int, source string, domain string"
    )
