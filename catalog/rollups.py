"""Queries on time rollups and long-term normals."""

from __future__ import annotations

from catalog.common import DAILY_COLUMNS, KEYS, NORMALIZED_CTES, query, raw, rounded, with_
from catalog.daily import (
    CLEAN_COLUMNS,
    CLEAN_CTES,
    NASA_FEATURES,
    NASA_FLAGS,
    featured_sql,
)
from gridclime.functions.lineage import together
from gridclime.operators import features, normalize, rollup
from gridclime.plans import flows
from gridclime.registry import (
    MAX_COLUMNS,
    MIN_COLUMNS,
    SEASONAL_COLUMNS,
    SEASONS,
    SUM_COLUMNS,
    VARIABILITY_COLUMNS,
)

PLACE = "latitude, longitude"
ADDED = [*NASA_FEATURES, *NASA_FLAGS]
VALUES = [*DAILY_COLUMNS, *ADDED]
FEATURED_CTES = {
    **NORMALIZED_CTES,
    "feat": featured_sql("norm", ", ".join(["norm.latitude, norm.longitude, norm.date", *DAILY_COLUMNS])),
}
SEASON_SQL = (
    "CASE WHEN {m} IN (12, 1, 2) THEN 'Winter' WHEN {m} IN (3, 4, 5) THEN 'Pre-Monsoon' "
    "WHEN {m} IN (6, 7, 8, 9) THEN 'Monsoon' ELSE 'Post-Monsoon' END"
)
YEAR, MONTH = "EXTRACT(YEAR FROM date)", "EXTRACT(MONTH FROM date)"
SEASON_YEAR = f"{YEAR} + CASE WHEN {MONTH} = 12 THEN 1 ELSE 0 END"


def agg_sql(c: str) -> str:
    if c in SUM_COLUMNS:
        return f"COALESCE(SUM({c}), 0)"
    if c in MAX_COLUMNS:
        return f"MAX({c})"
    if c in MIN_COLUMNS:
        return f"MIN({c})"
    return f"AVG({c})"


def roll_sql(source: str, keys: dict[str, str], columns) -> str:
    groups = ", ".join(f"{e} AS {k}" for k, e in keys.items())
    values = ", ".join(f"{agg_sql(c)} AS {c}" for c in columns)
    return (
        f"SELECT {PLACE}, {groups}, {values}, COUNT(date) AS days_count FROM {source} "
        f"GROUP BY {PLACE}, {', '.join(keys.values())}"
    )


def featured(spark, sf_dir):
    return features.add_features(normalize.normalize(together(raw(spark, sf_dir), ["latitude", "longitude"])))


ROLLUPS = {
    "monthly": (rollup.to_monthly, {"year": YEAR, "month": MONTH}, PLACE, ["year", "month"]),
    "seasonal": (
        rollup.to_seasonal,
        {"season_year": SEASON_YEAR, "season": SEASON_SQL.format(m=MONTH)},
        f"{PLACE}, season",
        ["season_year"],
    ),
    "yearly": (rollup.to_yearly, {"year": YEAR}, PLACE, ["year"]),
}
for _name, (_roll, _keys, _select, _bigs) in ROLLUPS.items():

    def _build(spark, sf_dir, roll=_roll):
        return roll(featured(spark, sf_dir))

    query(
        _name,
        rounded(
            with_(FEATURED_CTES, roll_sql("feat", _keys, VALUES)),
            _select,
            VALUES,
            [*_bigs, "days_count"],
        ),
    )(_build)


def normals_ctes(source: str, columns) -> dict[str, str]:
    """Long-term figures of a daily CTE, each part stated from the daily rows."""
    suffix = rollup.season_suffix
    return {
        "means": f"SELECT {PLACE}, "
        + ", ".join(f"AVG({c}) AS {c}" for c in columns)
        + f" FROM {source} GROUP BY {PLACE}",
        "yearly": roll_sql(source, {"year": YEAR}, VARIABILITY_COLUMNS),
        "varied": f"SELECT {PLACE}, AVG(precipitation_sum) AS yearly_rain, "
        + ", ".join(f"STDDEV_SAMP({c}) AS {c}_interannual_std" for c in VARIABILITY_COLUMNS)
        + f" FROM yearly GROUP BY {PLACE}",
        "seasonal": roll_sql(
            source,
            {"season_year": SEASON_YEAR, "season": SEASON_SQL.format(m=MONTH)},
            SEASONAL_COLUMNS,
        ),
        "signed": f"SELECT {PLACE}, "
        + ", ".join(
            f"AVG(CASE WHEN season = '{s}' THEN {c} END) AS {c}_{suffix(s)}"
            for c in SEASONAL_COLUMNS
            for s in SEASONS
        )
        + f" FROM seasonal GROUP BY {PLACE}",
        "months": roll_sql(
            source,
            {"year": YEAR, "month": MONTH},
            ["precipitation_sum", "temperature_2m_mean"],
        ),
        "profile": f"SELECT {PLACE}, month, AVG(precipitation_sum) AS precipitation_sum, "
        f"AVG(temperature_2m_mean) AS temperature_2m_mean FROM months GROUP BY {PLACE}, month",
        "cycled": f"SELECT {PLACE}, COALESCE(STDDEV_SAMP(precipitation_sum)/"
        "NULLIF(AVG(precipitation_sum), 0), 0) AS rainfall_seasonality_index, "
        "COALESCE(MAX(precipitation_sum)/NULLIF(SUM(precipitation_sum), 0), 0) "
        "AS peak_month_rainfall_share, MAX(temperature_2m_mean) AS monthly_temp_peak, "
        "MIN(temperature_2m_mean) AS monthly_temp_trough, "
        "STDDEV_SAMP(temperature_2m_mean) AS monthly_temp_variability, "
        "MAX(temperature_2m_mean) - MIN(temperature_2m_mean) AS annual_temp_cycle_range "
        f"FROM profile GROUP BY {PLACE}",
        "wet": f"SELECT {PLACE}, CAST(month AS DOUBLE) AS wettest_month FROM profile QUALIFY "
        f"ROW_NUMBER() OVER (PARTITION BY {PLACE} ORDER BY precipitation_sum DESC, month) = 1",
        "base": f"SELECT * FROM means JOIN varied USING ({PLACE}) JOIN signed USING ({PLACE}) "
        f"JOIN cycled USING ({PLACE}) JOIN wet USING ({PLACE})",
        "normals": "SELECT base.*, "
        "temperature_2m_mean_pre_monsoon - temperature_2m_mean_winter AS pre_monsoon_heat_contrast, "
        "relative_humidity_2m_mean_monsoon - relative_humidity_2m_mean_pre_monsoon "
        "AS seasonal_humidity_contrast, "
        "wind_speed_10m_mean_monsoon - wind_speed_10m_mean_winter AS seasonal_wind_contrast, "
        "cloud_cover_mean_monsoon - cloud_cover_mean_winter AS seasonal_cloud_contrast, "
        "CASE WHEN precipitation_sum > 0 THEN precipitation_sum_monsoon/precipitation_sum "
        "ELSE 0 END AS monsoon_rainfall_share, "
        "CASE WHEN yearly_rain > 0 THEN precipitation_sum_monsoon/yearly_rain "
        "ELSE 0 END AS monsoon_rainfall_share_annual, "
        "CASE WHEN shortwave_radiation_sum_monsoon > 0 THEN "
        "shortwave_radiation_sum_winter/shortwave_radiation_sum_monsoon "
        "ELSE 0 END AS winter_to_monsoon_solar_ratio FROM base",
    }


INTERANNUAL = [f"{c}_interannual_std" for c in VARIABILITY_COLUMNS]
SIGNATURES = [f"{c}_{rollup.season_suffix(s)}" for c in SEASONAL_COLUMNS for s in SEASONS]
CYCLE = [
    "rainfall_seasonality_index",
    "peak_month_rainfall_share",
    "wettest_month",
    "monthly_temp_peak",
    "monthly_temp_trough",
    "monthly_temp_variability",
    "annual_temp_cycle_range",
]
CONTRASTS = [*rollup.CONTRASTS, *rollup.RATIOS]
NORMALS_ADDED = [*INTERANNUAL, *SIGNATURES, *CYCLE, *CONTRASTS]
NORMALS_CTES = {**FEATURED_CTES, **normals_ctes("feat", VALUES)}


def parts(spark, sf_dir):
    return rollup.month_parts(featured(spark, sf_dir))


@query("place_means", rounded(with_(NORMALS_CTES, "SELECT * FROM means"), PLACE, VALUES))
def _(spark, sf_dir):
    return rollup.place_means(parts(spark, sf_dir))


@query("interannual_std", rounded(with_(NORMALS_CTES, "SELECT * FROM varied"), PLACE, INTERANNUAL))
def _(spark, sf_dir):
    return rollup.interannual(parts(spark, sf_dir)).drop("_yearly_rain")


@query("seasonal_signatures", rounded(with_(NORMALS_CTES, "SELECT * FROM signed"), PLACE, SIGNATURES))
def _(spark, sf_dir):
    return rollup.seasonal_signatures(parts(spark, sf_dir))


@query(
    "month_profile",
    rounded(
        with_(NORMALS_CTES, "SELECT * FROM profile"),
        PLACE,
        ["precipitation_sum", "temperature_2m_mean"],
        ["month"],
    ),
)
def _(spark, sf_dir):
    return rollup.month_profile(parts(spark, sf_dir), ["precipitation_sum", "temperature_2m_mean"])


@query(
    "month_seasonality",
    rounded(with_(NORMALS_CTES, "SELECT * FROM base"), PLACE, CYCLE),
)
def _(spark, sf_dir):
    return rollup.month_seasonality(parts(spark, sf_dir))


@query(
    "normals",
    rounded(with_(NORMALS_CTES, "SELECT * FROM normals"), PLACE, [*VALUES, *NORMALS_ADDED]),
)
def _(spark, sf_dir):
    return rollup.normals(featured(spark, sf_dir))


@query(
    "season_contrasts",
    rounded(with_(NORMALS_CTES, "SELECT * FROM normals"), PLACE, CONTRASTS),
)
def _(spark, sf_dir):
    return rollup.normals(featured(spark, sf_dir)).select("latitude", "longitude", *CONTRASTS)


CLEAN_VALUES = [*CLEAN_COLUMNS, *ADDED]
CLEAN_FEATURED_CTES = {
    **CLEAN_CTES,
    "feat": featured_sql("cleaned", ", ".join([KEYS, *CLEAN_COLUMNS])),
}
PLAIN_NORMALS = [*CLEAN_COLUMNS, *NORMALS_ADDED]
PLACE_NORMALS_CTES = {
    **CLEAN_FEATURED_CTES,
    **normals_ctes("feat", CLEAN_VALUES),
    "place_normals": featured_sql(
        "normals", ", ".join([PLACE, *PLAIN_NORMALS])
    ),
}


@query(
    "daily_features",
    rounded(
        with_(CLEAN_FEATURED_CTES, "SELECT * FROM feat"),
        KEYS,
        [*CLEAN_COLUMNS, *NASA_FEATURES],
        NASA_FLAGS,
    ),
)
def _(spark, sf_dir):
    return flows.daily_features(raw(spark, sf_dir))


@query(
    "place_normals",
    rounded(
        with_(PLACE_NORMALS_CTES, "SELECT * FROM place_normals"),
        PLACE,
        [*PLAIN_NORMALS, *NASA_FEATURES],
        NASA_FLAGS,
    ),
)
def _(spark, sf_dir):
    return flows.place_normals(raw(spark, sf_dir))
