"""Queries on daily and hourly rows: validation, merging, cleaning, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import (
    ALIAS_NAMES,
    DAILY_COLUMNS,
    KEYS,
    MEAN_TARGETS,
    NORMALIZED_CTES,
    RAW_NAMES,
    RENAMED_SQL,
    big,
    day,
    hourly,
    normalized,
    query,
    r,
    raw,
    rounded,
    with_,
)
from gridclime.operators import clean, features, normalize, rollup, validate
from gridclime.plans import flows
from gridclime.registry import ALIASES, CLIP_RANGES, HOURLY_RULES, RAW_CODES, VALID_RANGES
from gridclime.sources import projections as P

RAW = {"raw": P.NASA_RAW}
CODES = list(RAW_CODES)
PLACE = "latitude, longitude"

# ---------------------------------------------------------------- validation


def long_union(columns, select) -> str:
    return " UNION ALL ".join(select(c) for c in columns)


@query(
    "missing_values",
    with_(
        RAW,
        f'SELECT "column", {big("n", "missing_count")}, {r("missing_pct")} FROM ('
        + long_union(
            CODES,
            lambda c: f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS n, "
            f"ROUND((COUNT(*) - COUNT({c}))*100.0E0/COUNT(*), 2) AS missing_pct FROM raw",
        )
        + ") m WHERE n > 0",
    ),
)
def _(spark, sf_dir):
    return validate.missing_values(raw(spark, sf_dir))


GAPS = (
    f"SELECT {PLACE}, DATE_DIFF('day', MIN(date), MAX(date)) + 1 - COUNT(DISTINCT date) "
    f"AS missing_dates FROM raw GROUP BY {PLACE}"
)


@query(
    "date_gaps",
    with_(RAW, f"SELECT {PLACE}, {big('missing_dates')} FROM ({GAPS}) g WHERE missing_dates > 0"),
)
def _(spark, sf_dir):
    return validate.date_gaps(raw(spark, sf_dir))


@query(
    "missing_dates",
    with_(
        {
            **RAW,
            "days": f"SELECT {PLACE}, CAST(UNNEST(GENERATE_SERIES(MIN(date), MAX(date), "
            f"INTERVAL 1 DAY)) AS DATE) AS date FROM raw GROUP BY {PLACE}",
        },
        f"SELECT d.latitude, d.longitude, {day('d.date', 'date')} FROM days d "
        f"ANTI JOIN raw w USING ({KEYS})",
    ),
)
def _(spark, sf_dir):
    return validate.missing_dates(raw(spark, sf_dir))


def outside(c: str, low: float, high: float) -> str:
    return f"COUNT(CASE WHEN {c} < {low} OR {c} > {high} THEN 1 END)"


RANGES = {c: v for c, v in VALID_RANGES.items() if c in DAILY_COLUMNS}
OUTSIDE = long_union(
    RANGES,
    lambda c: f"SELECT '{c}' AS \"column\", {outside(c, *RANGES[c])} AS n, "
    "COUNT(*) AS total FROM norm",
)


@query(
    "out_of_range",
    with_(
        NORMALIZED_CTES,
        f'SELECT "column", {big("n", "outside_count")}, {r("n*100.0E0/total", "outside_pct")} '
        f"FROM ({OUTSIDE}) o WHERE n > 0",
    ),
)
def _(spark, sf_dir):
    return validate.out_of_range(normalized(spark, sf_dir))


COVERAGE = (
    "SELECT COUNT(*) AS total_places, MIN(n) AS min_records, MAX(n) AS max_records, "
    "AVG(n) AS mean_records, 3540 AS expected_places, COUNT(*)*100.0E0/3540 AS coverage_pct "
    f"FROM (SELECT COUNT(*) AS n FROM raw GROUP BY {PLACE}) c"
)


@query(
    "place_coverage",
    with_(
        RAW,
        "SELECT "
        + ", ".join(
            [
                *[big(c) for c in ("total_places", "min_records", "max_records")],
                r("ROUND(mean_records, 1)", "mean_records"),
                big("expected_places"),
                r("ROUND(coverage_pct, 1)", "coverage_pct"),
            ]
        )
        + f" FROM ({COVERAGE}) c",
    ),
)
def _(spark, sf_dir):
    return validate.coverage(raw(spark, sf_dir), 3540)




REPORT_PARTS = [
    "SELECT 'missing_values' AS \"check\", \"column\" AS subject, pct AS value, pct > 10 AS is_issue "
    "FROM ("
    + long_union(
        DAILY_COLUMNS,
        lambda c: f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS n, "
        f"ROUND((COUNT(*) - COUNT({c}))*100.0E0/COUNT(*), 2) AS pct FROM norm",
    )
    + ") m WHERE n > 0",
    "SELECT 'date_continuity', CAST(latitude AS VARCHAR) || ',' || CAST(longitude AS VARCHAR), "
    f"CAST(missing_dates AS DOUBLE), missing_dates > 30 FROM ({GAPS}) g WHERE missing_dates > 0",
    f"SELECT 'value_ranges', \"column\", CAST(n AS DOUBLE), n*100.0E0/total > 1 FROM ({OUTSIDE}) o "
    "WHERE n > 0",
    *[
        f"SELECT 'coverage', '{c}', {e}, FALSE FROM ({COVERAGE}) c"
        for c, e in {
            "total_places": "total_places",
            "min_records": "min_records",
            "max_records": "max_records",
            "mean_records": "ROUND(mean_records, 1)",
            "expected_places": "expected_places",
            "coverage_pct": "ROUND(coverage_pct, 1)",
        }.items()
    ],
]


@query(
    "validation_report",
    with_(
        NORMALIZED_CTES,
        f'SELECT "check", subject, {r("value")}, is_issue FROM ({" UNION ALL ".join(REPORT_PARTS)}) v',
    ),
)
def _(spark, sf_dir):
    return validate.report(normalized(spark, sf_dir), 3540)


# ------------------------------------------------------------- normalization


@query("rename_codes", rounded(with_(RAW, RENAMED_SQL), KEYS, RAW_NAMES))
def _(spark, sf_dir):
    return normalize.rename_codes(raw(spark, sf_dir))


@query(
    "add_aliases",
    rounded(
        with_(NORMALIZED_CTES, "SELECT * FROM norm"), KEYS, [*RAW_NAMES, *ALIAS_NAMES]
    ),
)
def _(spark, sf_dir):
    return normalize.add_aliases(normalize.rename_codes(raw(spark, sf_dir)))


@query(
    "fill_from_mean",
    rounded(
        with_(
            RAW,
            f"SELECT {KEYS}, T2M AS temperature_2m_mean, T2M AS temperature_2m_max, "
            "T2M AS temperature_2m_min, WS10M AS wind_speed_10m_mean, WS10M AS wind_speed_10m_max "
            "FROM raw",
        ),
        KEYS,
        [
            "temperature_2m_mean",
            "temperature_2m_max",
            "temperature_2m_min",
            "wind_speed_10m_mean",
            "wind_speed_10m_max",
        ],
    ),
)
def _(spark, sf_dir):
    means = raw(spark, sf_dir).select(
        "latitude",
        "longitude",
        "date",
        F.col("T2M").alias("temperature_2m_mean"),
        F.col("TS").alias("temperature_2m_max"),
        F.col("WS10M").alias("wind_speed_10m_mean"),
    )
    return normalize.fill_from_mean(means)


@query(
    "normalize",
    rounded(with_(NORMALIZED_CTES, "SELECT * FROM norm"), KEYS, DAILY_COLUMNS),
)
def _(spark, sf_dir):
    return normalized(spark, sf_dir)


SECOND = {**RAW, "second": P.SECOND_SOURCE}
SHARED_RANGE = {
    **SECOND,
    "span": "SELECT GREATEST((SELECT MIN(date) FROM second), (SELECT MIN(date) FROM raw)) AS lo, "
    "LEAST((SELECT MAX(date) FROM second), (SELECT MAX(date) FROM raw)) AS hi",
}


@query(
    "common_dates",
    rounded(
        with_(SHARED_RANGE, "SELECT raw.* FROM raw, span WHERE date BETWEEN lo AND hi"), KEYS, CODES
    ),
)
def _(spark, sf_dir):
    second = P.view(spark, sf_dir, P.SECOND_SOURCE)
    return normalize.common_dates(raw(spark, sf_dir), second)[0]


SECOND_VALUES = ["temperature_2m_mean", "precipitation_sum", "wind_speed_10m_mean"]
MERGED = {
    **SHARED_RANGE,
    "renamed": RENAMED_SQL,
    "merged": "SELECT s.*, "
    + ", ".join(f"w.{c}" for c in RAW_NAMES)
    + " FROM (SELECT second.* FROM second, span WHERE date BETWEEN lo AND hi) s "
    "LEFT JOIN (SELECT renamed.* FROM renamed, span WHERE date BETWEEN lo AND hi) w "
    "ON ROUND(s.latitude, 1) = ROUND(w.latitude, 1) "
    "AND ROUND(s.longitude, 1) = ROUND(w.longitude, 1) AND s.date = w.date",
}


def merged_sources(spark, sf_dir):
    return normalize.merge_sources(P.view(spark, sf_dir, P.SECOND_SOURCE), raw(spark, sf_dir))


@query(
    "merge_sources",
    rounded(
        with_(MERGED, "SELECT * FROM merged"),
        "date",
        ["latitude", "longitude", *SECOND_VALUES, *RAW_NAMES],
    ),
)
def _(spark, sf_dir):
    return merged_sources(spark, sf_dir)


@query(
    "merge_quality",
    with_(
        MERGED,
        "SELECT "
        + ", ".join(
            [
                big("COUNT(*)", "total_rows"),
                big("21", "total_columns"),
                big("COUNT(DISTINCT (latitude, longitude))", "unique_places"),
                day("MIN(date)", "first_date"),
                day("MAX(date)", "last_date"),
                big("6", "first_source_columns"),
                big("15", "second_source_columns"),
                r("COUNT(nasa_solar_irradiance_allsky)*100.0E0/COUNT(*)", "match_pct"),
                *[
                    r(f"(COUNT(*) - COUNT({c}))*1.0E0/COUNT(*)", f"missing_{c}")
                    for c in ("latitude", "longitude", "date", *SECOND_VALUES, *RAW_NAMES)
                ],
            ]
        )
        + " FROM merged",
    ),
)
def _(spark, sf_dir):
    return normalize.merge_quality(merged_sources(spark, sf_dir))


@query(
    "source_agreement",
    with_(
        {
            **SECOND,
            "renamed": RENAMED_SQL,
            "both_": "SELECT s.*, w.nasa_temperature_2m, w.nasa_precipitation, w.nasa_wind_speed_10m "
            "FROM second s JOIN renamed w ON ROUND(s.latitude, 1) = ROUND(w.latitude, 1) "
            "AND ROUND(s.longitude, 1) = ROUND(w.longitude, 1) AND s.date = w.date",
        },
        f"SELECT variable, {big('pairs')}, {r('pearson_r')} FROM ("
        + " UNION ALL ".join(
            f"SELECT '{a}' AS variable, COUNT(*) AS pairs, CORR({a}, {b}) AS pearson_r FROM both_"
            for a, b in normalize.AGREEMENT_PAIRS
        )
        + ") c",
    ),
)
def _(spark, sf_dir):
    return normalize.agreement(P.view(spark, sf_dir, P.SECOND_SOURCE), raw(spark, sf_dir))


# ------------------------------------------------------------------ cleaning


@query(
    "drop_duplicates",
    rounded(
        with_(
            {"seen": P.OBSERVATIONS},
            "SELECT * FROM seen QUALIFY ROW_NUMBER() OVER "
            f"(PARTITION BY {KEYS} ORDER BY source_file, source_row, T2M, WS10M) = 1",
        ),
        KEYS,
        ["T2M", "WS10M"],
        ["source_file", "source_row"],
    ),
)
def _(spark, sf_dir):
    seen = P.view(spark, sf_dir, P.OBSERVATIONS)
    return clean.drop_duplicates(seen, ["source_file", "source_row", "T2M", "WS10M"])


@query(
    "null_shares",
    with_(
        RAW,
        f'SELECT "column", {r("null_share")} FROM ('
        + long_union(
            ["latitude", "longitude", "date", *CODES],
            lambda c: f"SELECT '{c}' AS \"column\", "
            f"(COUNT(*) - COUNT({c}))*1.0E0/COUNT(*) AS null_share FROM raw",
        )
        + ") n",
    ),
)
def _(spark, sf_dir):
    return clean.null_shares(raw(spark, sf_dir))


DENSE = [c for c in CODES if c != "ALLSKY_SFC_UV_INDEX"]


@query("drop_sparse_columns", rounded(with_(RAW, "SELECT * FROM raw"), KEYS, DENSE))
def _(spark, sf_dir):
    return clean.drop_sparse_columns(raw(spark, sf_dir))


@query(
    "drop_sparse_columns_by_place",
    rounded(
        with_(
            RAW,
            f"SELECT {KEYS}, "
            + ", ".join(
                f"CASE WHEN COUNT({c}) OVER w >= 0.95E0*COUNT(*) OVER w THEN {c} END AS {c}"
                for c in CODES
            )
            + f" FROM raw WINDOW w AS (PARTITION BY {PLACE})",
        ),
        KEYS,
        CODES,
    ),
)
def _(spark, sf_dir):
    return clean.drop_sparse_columns(raw(spark, sf_dir), 0.05, scope="place")


def interpolate_sql(source: str, columns, others, limit: int = 7) -> str:
    """Linear fill by row position, stated with value and position windows."""
    positions = f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {PLACE} ORDER BY date) AS rn FROM {source}"
    before = f"(PARTITION BY {PLACE} ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = f"(PARTITION BY {PLACE} ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    sides = ", ".join(
        f"LAST_VALUE({c} IGNORE NULLS) OVER {before} AS pv_{c}, "
        f"LAST_VALUE(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER {before} AS pr_{c}, "
        f"FIRST_VALUE({c} IGNORE NULLS) OVER {after} AS nv_{c}, "
        f"FIRST_VALUE(CASE WHEN {c} IS NOT NULL THEN rn END IGNORE NULLS) OVER {after} AS nr_{c}"
        for c in columns
    )
    filled = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {c} "
        f"WHEN pr_{c} IS NOT NULL AND nr_{c} IS NOT NULL THEN "
        f"CASE WHEN rn - pr_{c} <= {limit} OR nr_{c} - rn <= {limit} THEN "
        f"pv_{c} + (nv_{c} - pv_{c})*(rn - pr_{c})/(nr_{c} - pr_{c}) END "
        f"WHEN rn - pr_{c} <= {limit} THEN pv_{c} WHEN nr_{c} - rn <= {limit} THEN nv_{c} END AS {c}"
        for c in columns
    )
    keep = "".join(f", {c}" for c in others)
    return f"SELECT {KEYS}{keep}, {filled} FROM (SELECT *, {sides} FROM ({positions}) p) s"


# Longer holes than scattered NULLs: three months of every year are missing.
GAP = "EXTRACT(MONTH FROM date) <= 3 OR EXTRACT(YEAR FROM date) = 1997"
HOLES = {
    **RAW,
    "holes": f"SELECT {KEYS}, "
    + ", ".join(f"CASE WHEN NOT ({GAP}) THEN {c} END AS {c}" for c in CODES)
    + " FROM raw",
}


def holes(spark, sf_dir):
    gap = (F.month("date") <= 3) | (F.year("date") == 1997)
    return raw(spark, sf_dir).select(
        "latitude", "longitude", "date", *[F.when(~gap, F.col(c)).alias(c) for c in CODES]
    )


GAPPY = CODES


@query("interpolate", rounded(with_(HOLES, interpolate_sql("holes", GAPPY, [])), KEYS, GAPPY))
def _(spark, sf_dir):
    return clean.interpolate(holes(spark, sf_dir), GAPPY)


@query(
    "fill_month_median",
    rounded(
        with_(
            {
                **HOLES,
                "medians": f"SELECT {PLACE}, EXTRACT(MONTH FROM date) AS month, "
                + ", ".join(f"QUANTILE_CONT({c}, 0.5) AS m_{c}" for c in GAPPY)
                + f" FROM holes GROUP BY {PLACE}, EXTRACT(MONTH FROM date)",
            },
            "SELECT h.latitude, h.longitude, h.date, "
            + ", ".join(f"COALESCE(h.{c}, m_{c}) AS {c}" for c in GAPPY)
            + " FROM holes h JOIN medians m "
            "ON h.latitude = m.latitude AND h.longitude = m.longitude "
            "AND EXTRACT(MONTH FROM h.date) = m.month",
        ),
        KEYS,
        GAPPY,
    ),
)
def _(spark, sf_dir):
    return clean.fill_month_median(holes(spark, sf_dir), GAPPY)


@query(
    "fill_median",
    rounded(
        with_(
            HOLES,
            f"SELECT {KEYS}, "
            + ", ".join(
                f"COALESCE({c}, (SELECT QUANTILE_CONT({c}, 0.5) FROM holes)) AS {c}" for c in GAPPY
            )
            + " FROM holes",
        ),
        KEYS,
        GAPPY,
    ),
)
def _(spark, sf_dir):
    return clean.fill_median(holes(spark, sf_dir), GAPPY)


@query(
    "fill_median_by_place",
    rounded(
        with_(
            HOLES,
            f"SELECT {KEYS}, "
            + ", ".join(
                f"COALESCE({c}, QUANTILE_CONT({c}, 0.5) OVER (PARTITION BY {PLACE})) AS {c}"
                for c in GAPPY
            )
            + " FROM holes",
        ),
        KEYS,
        GAPPY,
    ),
)
def _(spark, sf_dir):
    return clean.fill_median(holes(spark, sf_dir), GAPPY, scope="place")


def iqr_limits(columns, source: str, factor: float) -> str:
    quarters = ", ".join(
        f"QUANTILE_CONT({c}, 0.25) AS q1_{c}, QUANTILE_CONT({c}, 0.75) AS q3_{c}" for c in columns
    )
    limits = ", ".join(
        f"q1_{c} - {factor}E0*(q3_{c} - q1_{c}) AS lo_{c}, "
        f"q3_{c} + {factor}E0*(q3_{c} - q1_{c}) AS hi_{c}"
        for c in columns
    )
    return f"SELECT {limits} FROM (SELECT {quarters} FROM {source}) q"


def clipped(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN LEAST(GREATEST({c}, lo_{c}), hi_{c}) END AS {c}"


@query(
    "cap_outliers_iqr",
    rounded(
        with_(
            {**RAW, "limits": iqr_limits(CODES, "raw", 0.5)},
            f"SELECT {KEYS}, " + ", ".join(clipped(c) for c in CODES) + " FROM raw, limits",
        ),
        KEYS,
        CODES,
    ),
)
def _(spark, sf_dir):
    return clean.cap_outliers(raw(spark, sf_dir), "iqr", 0.5)


@query(
    "cap_outliers_iqr_by_place",
    rounded(
        with_(
            {
                **RAW,
                "quarters": "SELECT raw.*, "
                + ", ".join(
                    f"QUANTILE_CONT({c}, 0.25) OVER w AS q1_{c}, QUANTILE_CONT({c}, 0.75) OVER w AS q3_{c}"
                    for c in GAPPY
                )
                + f" FROM raw WINDOW w AS (PARTITION BY {PLACE})",
            },
            f"SELECT {KEYS}, "
            + ", ".join(
                f"CASE WHEN {c} IS NOT NULL THEN LEAST(GREATEST({c}, q1_{c} - 0.5E0*(q3_{c} - q1_{c})), "
                f"q3_{c} + 0.5E0*(q3_{c} - q1_{c})) END AS {c}"
                for c in GAPPY
            )
            + " FROM quarters",
        ),
        KEYS,
        GAPPY,
    ),
)
def _(spark, sf_dir):
    rows = raw(spark, sf_dir).select("latitude", "longitude", "date", *GAPPY)
    return clean.cap_outliers(rows, "iqr", 0.5, scope="place")


@query(
    "cap_outliers_zscore",
    rounded(
        with_(
            {
                **RAW,
                "limits": "SELECT "
                + ", ".join(
                    f"AVG({c}) - 1.5E0*STDDEV_SAMP({c}) AS lo_{c}, "
                    f"AVG({c}) + 1.5E0*STDDEV_SAMP({c}) AS hi_{c}"
                    for c in CODES
                )
                + " FROM raw",
            },
            f"SELECT {KEYS}, " + ", ".join(clipped(c) for c in CODES) + " FROM raw, limits",
        ),
        KEYS,
        CODES,
    ),
)
def _(spark, sf_dir):
    return clean.cap_outliers(raw(spark, sf_dir), "zscore", 1.5)


@query("cap_outliers_physical", rounded(with_(RAW, "SELECT * FROM raw"), KEYS, CODES))
def _(spark, sf_dir):
    """This method caps nothing; the physical limits are a step of their own."""
    return clean.cap_outliers(raw(spark, sf_dir), "physical")


@query(
    "capped_counts",
    with_(
        {**RAW, "limits": iqr_limits(CODES, "raw", 0.5)},
        f'SELECT "column", {big("capped")} FROM ('
        + long_union(
            CODES,
            lambda c: f"SELECT '{c}' AS \"column\", "
            f"COUNT(CASE WHEN {c} < lo_{c} OR {c} > hi_{c} THEN 1 END) AS capped FROM raw, limits",
        )
        + ") c",
    ),
)
def _(spark, sf_dir):
    return clean.capped_counts(raw(spark, sf_dir), "iqr", 0.5)


PHYSICAL = {c: v for c, v in CLIP_RANGES.items() if c in DAILY_COLUMNS}


def physical_sql(source: str, columns) -> str:
    return ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN LEAST(GREATEST({c}, {PHYSICAL[c][0]}E0), {PHYSICAL[c][1]}E0) END AS {c}"
        if c in PHYSICAL
        else c
        for c in columns
    )


@query(
    "clip_physical",
    rounded(
        with_(NORMALIZED_CTES, f"SELECT {KEYS}, {physical_sql('norm', DAILY_COLUMNS)} FROM norm"),
        KEYS,
        DAILY_COLUMNS,
    ),
)
def _(spark, sf_dir):
    return clean.clip_physical(normalized(spark, sf_dir))


@query(
    "clipped_counts",
    with_(
        NORMALIZED_CTES,
        f'SELECT "column", {big("clipped")} FROM ('
        + long_union(
            PHYSICAL,
            lambda c: f"SELECT '{c}' AS \"column\", {outside(c, *PHYSICAL[c])} AS clipped FROM norm",
        )
        + ") c",
    ),
)
def _(spark, sf_dir):
    return clean.clipped_counts(normalized(spark, sf_dir))


@query(
    "clean_summary",
    with_(
        RAW,
        "SELECT "
        + ", ".join(
            [
                big("COUNT(*)", "rows"),
                big("18", "columns"),
                big("17", "numeric_columns"),
                big(" + ".join(f"COUNT(*) - COUNT({c})" for c in CODES), "null_values"),
                r(
                    "ROUND((" + " + ".join(f"COUNT(*) - COUNT({c})" for c in CODES)
                    + ")*100.0E0/(18*COUNT(*)), 2)",
                    "null_pct",
                ),
                big("COUNT(DISTINCT (latitude, longitude))", "places"),
            ]
        ).replace(" AS rows", ' AS "rows"').replace(" AS columns", ' AS "columns"')
        + " FROM raw",
    ),
)
def _(spark, sf_dir):
    return clean.summary(raw(spark, sf_dir))


# The whole cleaning of normalized rows: the sparse column goes, the gappy ones
# are filled, quartile caps (factor 3) and physical limits follow.
CLEAN_COLUMNS = [c for c in DAILY_COLUMNS if c != "nasa_uv_index"]
CLEAN_GAPPY = [
    "nasa_temperature_2m",
    "nasa_precipitation",
    "temperature_2m_mean",
    "precipitation_sum",
    "temperature_2m_max",
    "temperature_2m_min",
]
CLEAN_SOLID = [c for c in CLEAN_COLUMNS if c not in CLEAN_GAPPY]
CLEAN_CTES = {
    **NORMALIZED_CTES,
    "lined": interpolate_sql("norm", CLEAN_GAPPY, CLEAN_SOLID),
    "monthly_fill": f"SELECT {KEYS}, "
    + ", ".join(CLEAN_SOLID)
    + ", "
    + ", ".join(
        f"COALESCE({c}, QUANTILE_CONT({c}, 0.5) OVER (PARTITION BY {PLACE}, EXTRACT(MONTH FROM date))) AS {c}"
        for c in CLEAN_GAPPY
    )
    + " FROM lined",
    "global_fill": f"SELECT {KEYS}, "
    + ", ".join(CLEAN_SOLID)
    + ", "
    + ", ".join(
        f"COALESCE({c}, (SELECT QUANTILE_CONT({c}, 0.5) FROM monthly_fill)) AS {c}"
        for c in CLEAN_GAPPY
    )
    + " FROM monthly_fill",
    "limits": iqr_limits(CLEAN_COLUMNS, "global_fill", 3.0),
    "capped": f"SELECT {KEYS}, "
    + ", ".join(clipped(c) for c in CLEAN_COLUMNS)
    + " FROM global_fill, limits",
    "cleaned": f"SELECT {KEYS}, {physical_sql('capped', CLEAN_COLUMNS)} FROM capped",
}


def cleaned(spark, sf_dir):
    return flows.cleaned(raw(spark, sf_dir))


@query(
    "clean_report",
    with_(
        {
            **NORMALIZED_CTES,
            "steps": "SELECT 'removed_rows' AS step, 'rows' AS subject, "
            f"COUNT(*) - COUNT(DISTINCT ({KEYS})) AS n FROM norm UNION ALL "
            "SELECT 'removed_column', 'nasa_uv_index', COUNT(*) - COUNT(nasa_uv_index) FROM norm UNION ALL "
            + " UNION ALL ".join(
                f"SELECT 'filled', '{c}', COUNT(*) - COUNT({c}) FROM norm" for c in CLEAN_GAPPY
            ),
        },
        f"SELECT step, subject, {big('n')} FROM steps",
    ),
)
def _(spark, sf_dir):
    return clean.report(normalized(spark, sf_dir))


@query("clean", rounded(with_(CLEAN_CTES, "SELECT * FROM cleaned"), KEYS, CLEAN_COLUMNS))
def _(spark, sf_dir):
    return cleaned(spark, sf_dir)


# ------------------------------------------------------------------ features

NASA_FEATURES = {
    "temp_range_daily": "temperature_2m_max - temperature_2m_min",
    "humidity_range": "relative_humidity_2m_max - relative_humidity_2m_min",
    "cloud_stratification": "cloud_cover_high_mean - cloud_cover_low_mean",
    **{
        f"wind_speed_{h}m_{s}": f"wind_speed_10m_{s}*POWER({h}/10.0E0, 0.14E0)"
        for h in (80, 120, 180)
        for s in ("mean", "max")
    },
    "wind_shear_coefficient": "CASE WHEN wind_speed_10m_mean > 0 THEN "
    "LN(POWER(12.0E0, 0.14E0))/LN(12.0E0) ELSE 0.14E0 END",
    **{
        f"wind_power_density_{h}m": "0.5E0*1.225E0*POWER(wind_speed_10m_mean*"
        f"POWER({h}/10.0E0, 0.14E0)/3.6E0, 3)"
        for h in (80, 120, 180)
    },
    "solar_utilization_ratio": "CASE WHEN nasa_solar_irradiance_clearsky > 0 THEN "
    "nasa_solar_irradiance_allsky/nasa_solar_irradiance_clearsky ELSE 0.0E0 END",
    "solar_wind_complementarity": "-(((shortwave_radiation_sum - z.ms)/(z.ss + 1E-8))*"
    "((wind_speed_10m_mean - z.mw)/(z.sw + 1E-8)))",
    "growing_degree_days": "CASE WHEN temperature_2m_mean IS NOT NULL THEN "
    "GREATEST(0.0E0, temperature_2m_mean - 10) END",
    "soil_temp_proxy": "nasa_earth_skin_temperature",
    "soil_air_temp_diff": "nasa_earth_skin_temperature - temperature_2m_mean",
}
NASA_FLAGS = {
    "frost_risk": "CASE WHEN temperature_2m_min < 0 THEN 1 ELSE 0 END",
    "heat_stress": "CASE WHEN temperature_2m_max > 40 THEN 1 ELSE 0 END",
    "heavy_rain_flag": "CASE WHEN precipitation_sum > 50 THEN 1 ELSE 0 END",
    "extreme_rain_flag": "CASE WHEN precipitation_sum > 100 THEN 1 ELSE 0 END",
}
Z_SQL = (
    "SELECT AVG(shortwave_radiation_sum) AS ms, STDDEV_SAMP(shortwave_radiation_sum) AS ss, "
    "AVG(wind_speed_10m_mean) AS mw, STDDEV_SAMP(wind_speed_10m_mean) AS sw FROM {0}"
)


def featured_sql(source: str, columns: str) -> str:
    wanted = ", ".join(f"{e} AS {c}" for c, e in {**NASA_FEATURES, **NASA_FLAGS}.items())
    return f"SELECT {columns}, {wanted} FROM {source}, ({Z_SQL.format(source)}) z"


FEATURE_GROUPS = {
    "core_features": (features.core_features, list(NASA_FEATURES)[:3], []),
    "wind_features": (features.wind_features, list(NASA_FEATURES)[3:10], []),
    "agriculture_features": (
        features.agriculture_features,
        ["growing_degree_days", "soil_temp_proxy", "soil_air_temp_diff"],
        ["frost_risk", "heat_stress"],
    ),
    "hazard_features": (features.hazard_features, [], ["heavy_rain_flag", "extreme_rain_flag"]),
    "energy_features": (
        lambda df: features.energy_features(features.wind_features(df)),
        [
            *[f"wind_power_density_{h}m" for h in (80, 120, 180)],
            "solar_utilization_ratio",
            "solar_wind_complementarity",
        ],
        [],
    ),
}
for _name, (_add, _doubles, _flags) in FEATURE_GROUPS.items():

    def _build(spark, sf_dir, add=_add, columns=(*_doubles, *_flags)):
        return add(normalized(spark, sf_dir)).select("latitude", "longitude", "date", *columns)

    query(
        _name,
        rounded(with_(NORMALIZED_CTES, featured_sql("norm", KEYS)), KEYS, _doubles, _flags),
    )(_build)


@query(
    "complementarity_by_place",
    rounded(
        with_(
            NORMALIZED_CTES,
            f"SELECT {KEYS}, -(((shortwave_radiation_sum - AVG(shortwave_radiation_sum) OVER w)"
            "/(STDDEV_SAMP(shortwave_radiation_sum) OVER w + 1E-8))*"
            "((wind_speed_10m_mean - AVG(wind_speed_10m_mean) OVER w)"
            "/(STDDEV_SAMP(wind_speed_10m_mean) OVER w + 1E-8))) AS solar_wind_complementarity "
            f"FROM norm WINDOW w AS (PARTITION BY {PLACE})",
        ),
        KEYS,
        ["solar_wind_complementarity"],
    ),
)
def _(spark, sf_dir):
    out = features.complementarity(normalized(spark, sf_dir), scope="place")
    return out.select("latitude", "longitude", "date", "solar_wind_complementarity")


# --------------------------------------------------------------- hourly rows

DUCK = {
    "mean": "AVG({0})",
    "max": "MAX({0})",
    "min": "MIN({0})",
    "std": "STDDEV_SAMP({0})",
    "sum": "COALESCE(SUM({0}), 0)",
}
HOURLY_STATS = {
    f"{p}_{s}": DUCK[s].format(p) for p, stats in HOURLY_RULES.items() for s in stats if s != "mode"
}
HOUR_TESTS = {
    "frost_hours": "temperature_2m < 0",
    "hot_hours": "temperature_2m > 35",
    "comfortable_hours": "temperature_2m >= 18 AND temperature_2m <= 28",
    "precipitation_hours": "precipitation > 0",
    "dry_hours": "precipitation = 0",
    "calm_hours": "wind_speed_10m < 5",
    "strong_wind_hours": "wind_speed_10m > 40",
    "high_humidity_hours": "relative_humidity_2m > 90",
    "low_cloud_hours": "cloud_cover < 20",
    "overcast_hours": "cloud_cover > 80",
}
DAY = "CAST(hour AS DATE)"
HOURLY_CTES = {
    "hourly": P.HOURLY_FULL,
    "modes": f"SELECT {PLACE}, date, weather_code AS weather_code_mode FROM (SELECT {PLACE}, "
    f"{DAY} AS date, weather_code, COUNT(*) AS n FROM hourly GROUP BY {PLACE}, {DAY}, weather_code) c "
    f"QUALIFY ROW_NUMBER() OVER (PARTITION BY {KEYS} ORDER BY n DESC, weather_code) = 1",
    "stats": f"SELECT {PLACE}, {DAY} AS date, "
    + ", ".join(f"{e} AS {c}" for c, e in HOURLY_STATS.items())
    + ", "
    + ", ".join(f"COUNT(CASE WHEN {t} THEN 1 END) AS {c}" for c, t in HOUR_TESTS.items())
    + f" FROM hourly GROUP BY {PLACE}, {DAY}",
    "daily": f"SELECT stats.*, weather_code_mode FROM stats JOIN modes USING ({KEYS})",
}


@query(
    "hourly_to_daily",
    rounded(
        with_(HOURLY_CTES, "SELECT * FROM daily"),
        KEYS,
        HOURLY_STATS,
        [*HOUR_TESTS, "weather_code_mode"],
    ),
)
def _(spark, sf_dir):
    return rollup.hourly_to_daily(hourly(spark, sf_dir))


HOURLY_FEATURES = {
    "apparent_temp_range": "apparent_temperature_max - apparent_temperature_min",
    "pressure_range": "pressure_msl_max - pressure_msl_min",
    "cloud_stratification": "cloud_cover_high_mean - cloud_cover_low_mean",
    "sunshine_fraction": "low_cloud_hours/24.0E0",
    "precipitation_intensity": "CASE WHEN precipitation_hours > 0 THEN "
    "precipitation_sum/precipitation_hours ELSE 0.0E0 END",
    "aridity_index": "CASE WHEN et0_fao_evapotranspiration_sum > 0 THEN "
    "precipitation_sum/et0_fao_evapotranspiration_sum END",
    "thermal_stress_index": "apparent_temperature_mean - temperature_2m_mean",
    "outdoor_comfort_score": "(comfortable_hours + dry_hours + calm_hours)/72.0E0",
    "heat_island_potential": "(hot_hours + calm_hours + low_cloud_hours)/72.0E0",
}
HOURLY_FLAGS = {
    "extreme_wind_flag": "CASE WHEN wind_gusts_10m_max > 60 THEN 1 ELSE 0 END",
    "storm_wind_flag": "CASE WHEN wind_gusts_10m_max > 90 THEN 1 ELSE 0 END",
    "pressure_instability": "CASE WHEN pressure_msl_std > 5 THEN 1 ELSE 0 END",
    "flood_risk_indicator": "CASE WHEN precipitation_sum > 50 THEN precipitation_hours ELSE 0 END",
}


@query(
    "hourly_features",
    rounded(
        with_(
            HOURLY_CTES,
            f"SELECT {KEYS}, "
            + ", ".join(f"{e} AS {c}" for c, e in {**HOURLY_FEATURES, **HOURLY_FLAGS}.items())
            + " FROM daily",
        ),
        KEYS,
        HOURLY_FEATURES,
        HOURLY_FLAGS,
    ),
)
def _(spark, sf_dir):
    out = features.add_features(rollup.hourly_to_daily(hourly(spark, sf_dir)))
    return out.select("latitude", "longitude", "date", *HOURLY_FEATURES, *HOURLY_FLAGS)


@query(
    "mean_from_extremes",
    rounded(
        with_(
            HOURLY_CTES,
            f"SELECT {KEYS}, (temperature_2m_max + temperature_2m_min)/2 AS temperature_2m_mean "
            "FROM daily",
        ),
        KEYS,
        ["temperature_2m_mean"],
    ),
)
def _(spark, sf_dir):
    daily = rollup.hourly_to_daily(hourly(spark, sf_dir)).drop("temperature_2m_mean")
    return features.core_features(daily).select(
        "latitude", "longitude", "date", "temperature_2m_mean"
    )
