"""Names, rules, ranges, thresholds and texts. Data only."""

from __future__ import annotations

PLACE = ("latitude", "longitude")
DAILY_KEY = (*PLACE, "date")

# ---------------------------------------------------------------- fixed values
# Regions as (lat_min, lat_max, lon_min, lon_max, spacing), in degrees.
REGIONS = {
    "india": (8.0, 37.0, 68.0, 97.5, 0.5),
    "global": (-60.0, 70.0, -180.0, 180.0, 1.0),
}
KM_PER_DEGREE = 111
EARTH_RADIUS_KM = 6371.0
MISSING_SENTINEL = -999.0

# Raw parameter code -> column.
RAW_CODES = {
    "ALLSKY_SFC_SW_DWN": "nasa_solar_irradiance_allsky",
    "CLRSKY_SFC_SW_DWN": "nasa_solar_irradiance_clearsky",
    "ALLSKY_KT": "nasa_clearness_index",
    "ALLSKY_SFC_LW_DWN": "nasa_longwave_radiation",
    "ALLSKY_SFC_UV_INDEX": "nasa_uv_index",
    "T2M": "nasa_temperature_2m",
    "T2MDEW": "nasa_dewpoint_2m",
    "TS": "nasa_earth_skin_temperature",
    "RH2M": "nasa_relative_humidity",
    "QV2M": "nasa_specific_humidity",
    "PRECTOTCORR": "nasa_precipitation",
    "WS10M": "nasa_wind_speed_10m",
    "WD10M": "nasa_wind_direction_10m",
    "PS": "nasa_surface_pressure",
    "CLOUD_AMT": "nasa_cloud_amount",
}

# Alias -> the column it copies.
ALIASES = {
    "temperature_2m_mean": "nasa_temperature_2m",
    "dewpoint_2m_mean": "nasa_dewpoint_2m",
    "relative_humidity_2m_mean": "nasa_relative_humidity",
    "precipitation_sum": "nasa_precipitation",
    "wind_speed_10m_mean": "nasa_wind_speed_10m",
    "wind_direction_10m_mean": "nasa_wind_direction_10m",
    "surface_pressure_mean": "nasa_surface_pressure",
    "pressure_msl_mean": "nasa_surface_pressure",
    "cloud_cover_mean": "nasa_cloud_amount",
    "shortwave_radiation_sum": "nasa_solar_irradiance_allsky",
}

# Columns set to a daily mean, by that mean.
SET_FROM_MEAN = {
    "temperature_2m_mean": ("temperature_2m_max", "temperature_2m_min"),
    "relative_humidity_2m_mean": (
        "relative_humidity_2m_max",
        "relative_humidity_2m_min",
    ),
    "wind_speed_10m_mean": ("wind_speed_10m_max",),
    "cloud_cover_mean": (
        "cloud_cover_low_mean",
        "cloud_cover_mid_mean",
        "cloud_cover_high_mean",
    ),
}

HOUR_COUNTS = (
    "frost_hours",
    "hot_hours",
    "comfortable_hours",
    "precipitation_hours",
    "dry_hours",
    "calm_hours",
    "strong_wind_hours",
    "high_humidity_hours",
    "low_cloud_hours",
    "overcast_hours",
)

# Hourly parameter -> daily statistics.
HOURLY_RULES = {
    "temperature_2m": ("mean", "max", "min", "std"),
    "apparent_temperature": ("mean", "max", "min"),
    "dewpoint_2m": ("mean", "min"),
    "relative_humidity_2m": ("mean", "max", "min"),
    "vapour_pressure_deficit": ("mean", "max"),
    "precipitation": ("sum", "max"),
    "rain": ("sum",),
    "showers": ("sum",),
    "snowfall": ("sum",),
    "snow_depth": ("max", "mean"),
    "pressure_msl": ("mean", "min", "max", "std"),
    "surface_pressure": ("mean",),
    "cloud_cover": ("mean", "max", "min"),
    "cloud_cover_low": ("mean",),
    "cloud_cover_mid": ("mean",),
    "cloud_cover_high": ("mean",),
    "wind_speed_10m": ("mean", "max", "std"),
    "wind_direction_10m": ("mean",),
    "wind_gusts_10m": ("max",),
    "shortwave_radiation": ("sum", "max", "mean"),
    "et0_fao_evapotranspiration": ("sum",),
    "weather_code": ("mode",),
}

# Rollup rule by column; any other number is averaged.
SUM_COLUMNS = (
    "precipitation_sum",
    "rain_sum",
    "showers_sum",
    "snowfall_sum",
    "shortwave_radiation_sum",
    "et0_fao_evapotranspiration_sum",
    *HOUR_COUNTS,
)
MAX_COLUMNS = (
    "temperature_2m_max",
    "apparent_temperature_max",
    "wind_speed_10m_max",
    "wind_gusts_10m_max",
    "precipitation_max",
    "shortwave_radiation_max",
    "vapour_pressure_deficit_max",
)
MIN_COLUMNS = (
    "temperature_2m_min",
    "apparent_temperature_min",
    "dewpoint_2m_min",
    "relative_humidity_2m_min",
    "pressure_msl_min",
)
ROLLUP_KEYS = ("latitude", "longitude", "year", "month", "season_year")

SEASONS = {
    "Winter": (12, 1, 2),
    "Pre-Monsoon": (3, 4, 5),
    "Monsoon": (6, 7, 8, 9),
    "Post-Monsoon": (10, 11),
}
SEASONAL_COLUMNS = (
    "temperature_2m_mean",
    "temperature_2m_max",
    "temperature_2m_min",
    "precipitation_sum",
    "relative_humidity_2m_mean",
    "wind_speed_10m_mean",
    "cloud_cover_mean",
    "shortwave_radiation_sum",
)
VARIABILITY_COLUMNS = (
    "temperature_2m_mean",
    "precipitation_sum",
    "wind_speed_10m_mean",
    "cloud_cover_mean",
)

# Physical limits used when cleaning.
CLIP_RANGES = {
    "temperature_2m_mean": (-50.0, 55.0),
    "temperature_2m_max": (-50.0, 60.0),
    "temperature_2m_min": (-60.0, 50.0),
    "apparent_temperature_mean": (-60.0, 65.0),
    "dewpoint_2m_mean": (-60.0, 35.0),
    "relative_humidity_2m_mean": (0.0, 100.0),
    "relative_humidity_2m_max": (0.0, 100.0),
    "relative_humidity_2m_min": (0.0, 100.0),
    "precipitation_sum": (0.0, 500.0),
    "pressure_msl_mean": (870.0, 1084.0),
    "cloud_cover_mean": (0.0, 100.0),
    "wind_speed_10m_mean": (0.0, 150.0),
    "wind_speed_10m_max": (0.0, 250.0),
    "shortwave_radiation_sum": (0.0, 50000.0),
    "nasa_solar_irradiance_allsky": (0.0, 12.0),
    "nasa_temperature_2m": (-50.0, 55.0),
    "nasa_relative_humidity": (0.0, 100.0),
}
# Physical limits used when validating.
VALID_RANGES = {
    "temperature_2m_mean": (-50.0, 60.0),
    "temperature_2m_max": (-50.0, 65.0),
    "temperature_2m_min": (-60.0, 50.0),
    "relative_humidity_2m_mean": (0.0, 100.0),
    "precipitation_sum": (0.0, 500.0),
    "pressure_msl_mean": (870.0, 1084.0),
    "cloud_cover_mean": (0.0, 100.0),
    "wind_speed_10m_mean": (0.0, 200.0),
    "wind_speed_10m_max": (0.0, 300.0),
}
UNCAPPED_COLUMNS = ("latitude", "longitude", *HOUR_COUNTS, "weather_code_mode")

WIND_SHEAR_EXPONENTS = {
    "open_terrain": 0.14,
    "rural": 0.20,
    "suburban": 0.25,
    "urban": 0.33,
    "water": 0.10,
    "default": 0.14,
}
WIND_HEIGHTS_M = (80, 120, 180)
AIR_DENSITY = 1.225

# Feature -> (unit, tier, source, domain).
FEATURES = {
    "temperature_2m": ("°C", 1, "normalized_weather", "all"),
    "apparent_temperature": ("°C", 1, "normalized_weather", "urban"),
    "dewpoint_2m": ("°C", 1, "normalized_weather", "all"),
    "relative_humidity_2m": ("%", 1, "normalized_weather", "all"),
    "vapour_pressure_deficit": ("kPa", 1, "normalized_weather", "all"),
    "precipitation": ("mm", 1, "normalized_weather", "all"),
    "rain": ("mm", 1, "normalized_weather", "all"),
    "showers": ("mm", 1, "normalized_weather", "all"),
    "snowfall": ("cm", 1, "normalized_weather", "all"),
    "snow_depth": ("m", 1, "normalized_weather", "disaster"),
    "pressure_msl": ("hPa", 1, "normalized_weather", "all"),
    "surface_pressure": ("hPa", 1, "normalized_weather", "all"),
    "cloud_cover": ("%", 1, "normalized_weather", "all"),
    "cloud_cover_low": ("%", 1, "normalized_weather", "energy"),
    "cloud_cover_mid": ("%", 1, "normalized_weather", "energy"),
    "cloud_cover_high": ("%", 1, "normalized_weather", "energy"),
    "wind_speed_10m": ("km/h", 1, "normalized_weather", "all"),
    "wind_direction_10m": ("°", 1, "normalized_weather", "all"),
    "wind_gusts_10m": ("km/h", 1, "normalized_weather", "disaster"),
    "shortwave_radiation": ("W/m²", 1, "normalized_weather", "energy"),
    "et0_fao_evapotranspiration": ("mm", 1, "normalized_weather", "agriculture"),
    "nasa_solar_irradiance_allsky": ("kWh/m²/day", 2, "nasa", "energy"),
    "nasa_solar_irradiance_clearsky": ("kWh/m²/day", 2, "nasa", "energy"),
    "nasa_clearness_index": ("ratio", 2, "nasa", "energy"),
    "nasa_longwave_radiation": ("kWh/m²/day", 2, "nasa", "energy"),
    "nasa_uv_index": ("index", 2, "nasa", "all"),
    "nasa_earth_skin_temperature": ("°C", 2, "nasa", "agriculture"),
    "nasa_specific_humidity": ("g/kg", 2, "nasa", "all"),
    "nasa_cloud_amount": ("%", 2, "nasa", "all"),
}

# Columns never used as model features, and raw columns dropped beside an alias.
NOT_FEATURES = (
    "latitude",
    "longitude",
    "date",
    "year",
    "month",
    "season",
    "cluster",
    "cluster_size",
    "cluster_pct",
    "days_count",
)
REDUNDANT_RAW = {
    "nasa_temperature_2m": "temperature_2m_mean",
    "nasa_relative_humidity": "relative_humidity_2m_mean",
    "nasa_precipitation": "precipitation_sum",
    "nasa_wind_speed_10m": "wind_speed_10m_mean",
    "nasa_wind_direction_10m": "wind_direction_10m_mean",
    "nasa_surface_pressure": "surface_pressure_mean",
    "nasa_cloud_amount": "cloud_cover_mean",
}

# Class edges: first label below the first edge, last label from the last edge up.
TEMPERATURE_CLASSES = ((10.0, 20.0, 28.0, 35.0), ("Cold", "Cool", "Moderate", "Warm", "Hot"))
RAIN_CLASSES = ((2.0, 5.0, 10.0, 20.0), ("Arid", "Semi-Arid", "Moderate", "Wet", "Very Wet"))
HUMIDITY_CLASSES = (
    (30.0, 50.0, 70.0, 85.0),
    ("Dry", "Comfortable", "Moderate", "Humid", "Very Humid"),
)
WIND_WORDS = ("Calm", "Breezy", "Windy")
SOLAR_WORDS = ("Low Solar", "Sunny", "High Solar")
CLASS_QUANTILES = (0.33, 0.66)
# First available column is the one classified.
CLASS_COLUMNS = {
    "temperature": ("temperature_2m_mean", "nasa_temperature_2m"),
    "rain": ("precipitation_sum", "nasa_precipitation"),
    "humidity": ("relative_humidity_2m_mean", "nasa_relative_humidity"),
    "wind": ("wind_speed_80m_mean", "wind_speed_10m_mean", "nasa_wind_speed_10m"),
    "solar": (
        "shortwave_radiation_sum",
        "nasa_solar_irradiance_allsky",
        "solar_utilization_ratio",
    ),
}
NOISE_LABEL = "Noise/Outlier"
UNASSIGNED_LABEL = "Unassigned"

FRIENDLY_NAMES = {
    "temperature_2m_mean": "average temperature",
    "temperature_2m_max": "daytime temperature",
    "temperature_2m_min": "night temperature",
    "temperature_2m_mean_interannual_std": "year-to-year temperature variability",
    "precipitation_sum": "rainfall",
    "precipitation_sum_interannual_std": "year-to-year rainfall variability",
    "relative_humidity_2m_mean": "humidity",
    "relative_humidity_2m_max": "peak humidity",
    "relative_humidity_2m_min": "minimum humidity",
    "wind_speed_10m_mean": "surface wind speed",
    "wind_speed_80m_mean": "elevated wind speed",
    "wind_speed_10m_mean_interannual_std": "year-to-year wind variability",
    "wind_shear_coefficient": "wind shear",
    "shortwave_radiation_sum": "solar radiation",
    "solar_utilization_ratio": "solar consistency",
    "solar_wind_complementarity": "solar and wind complementarity",
    "wind_power_density_80m": "wind energy potential",
    "wind_power_density_120m": "mid-height wind energy potential",
    "wind_power_density_180m": "high-altitude wind energy potential",
    "cloud_cover_mean_interannual_std": "year-to-year cloud variability",
    "nasa_solar_irradiance_allsky": "all-sky solar potential",
    "nasa_solar_irradiance_clearsky": "clear-sky solar potential",
    "nasa_uv_index": "UV intensity",
    "nasa_relative_humidity": "humidity",
    "nasa_temperature_2m": "average temperature",
    "nasa_precipitation": "rainfall",
}

KNOWN_PLACES = (
    "Agra", "Ahmedabad", "Amritsar", "Bengaluru", "Bhopal", "Bhubaneswar",
    "Chandigarh", "Chennai", "Coimbatore", "Dehradun", "Delhi", "Gangtok",
    "Guwahati", "Hyderabad", "Indore", "Jaipur", "Jammu", "Kanpur", "Kochi",
    "Kolkata", "Kozhikode", "Leh", "Lucknow", "Mangaluru", "Mumbai", "Mysuru",
    "Nagpur", "Patna", "Port Blair", "Pune", "Raipur", "Ranchi", "Shillong",
    "Shimla", "Srinagar", "Surat", "Thiruvananthapuram", "Udaipur", "Varanasi",
    "Visakhapatnam",
)
PLACE_ALIASES = {
    "bangalore": "Bengaluru",
    "bombay": "Mumbai",
    "calcutta": "Kolkata",
    "cochin": "Kochi",
    "madras": "Chennai",
    "mysore": "Mysuru",
    "new delhi": "Delhi",
    "trivandrum": "Thiruvananthapuram",
    "vizag": "Visakhapatnam",
}
# ------------------------------------------------------------ end fixed values


def features_where(tier=None, domain=None, source=None) -> list[str]:
    """Feature names by tier, domain (``all`` counts for each) and source."""
    return [
        name
        for name, (_, feature_tier, feature_source, feature_domain) in FEATURES.items()
        if (tier is None or feature_tier == tier)
        and (domain is None or feature_domain in (domain, "all"))
        and (source is None or feature_source == source)
    ]


def hourly_output_columns() -> list[str]:
    return [f"{name}_{stat}" for name, stats in HOURLY_RULES.items() for stat in stats]
