"""Scores, tags and advice per cluster for four sectors. Noise is left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclime.functions.columns import truthy_or, unit, with_one_row
from gridclime.functions.quantiles import quantiles

RANK_QUANTILES = (0.1, 0.9)


def _means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Size and rounded mean of each column per cluster; absent columns are NULL."""

    def mean(c: str) -> Column:
        value = F.bround(F.avg(c), 3) if c in df.columns else F.lit(None).cast("double")
        return value.alias(f"{c}_mean")

    return (
        df.filter("cluster >= 0")
        .groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("points"), *[mean(c) for c in columns])
    )


def _with_ranges(means: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return with_one_row(means, quantiles(df, present, RANK_QUANTILES), "_q")


def scaled_rank(value: Column, low: Column, high: Column) -> Column:
    """Position of a value between two quantiles, in [0, 1]; 0.5 if flat or missing."""
    flat = F.abs(high - low) <= 1e-8 + 1e-5 * F.abs(low)
    score = F.when(flat, F.lit(0.5)).otherwise((value - low) / F.when(~flat, high - low))
    return F.coalesce(F.bround(unit(score), 3), F.lit(0.5))


def _rank(df: DataFrame, column: str) -> Column:
    if column not in df.columns:
        return F.lit(0.5)
    q = F.col(f"_q.{column}")
    return scaled_rank(F.col(f"{column}_mean"), q[0], q[1])


def _m(column: str) -> Column:
    return F.col(f"{column}_mean")


def _closeness(value: Column, best: float, reach: float) -> Column:
    return 1 - F.least(F.abs(value - best) / reach, F.lit(1.0))


def _at_least_zero(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def _tags(tests: Sequence[tuple[str, Column]], otherwise: str) -> Column:
    text = F.concat_ws(", ", *[F.when(test, F.lit(tag)) for tag, test in tests])
    return F.when(text == "", F.lit(otherwise)).otherwise(text)


def _first(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    text = F.when(F.lit(False), F.lit(None).cast("string"))
    for test, value in rules:
        text = text.when(test, F.lit(value))
    return text.otherwise(F.lit(otherwise))


def agriculture(df: DataFrame) -> DataFrame:
    """Suitability for crops, best first."""
    rain, solar = "precipitation_sum", "shortwave_radiation_sum"
    columns = (
        "temperature_2m_mean",
        "growing_degree_days",
        rain,
        "relative_humidity_2m_mean",
        solar,
        "frost_risk",
        "heat_stress",
    )

    def stability(column: str) -> Column:
        if column not in df.columns:
            return F.lit(None).cast("double")
        return F.bround(1 / (1 + _at_least_zero(F.avg(column))), 3)

    steady = (
        df.filter("cluster >= 0")
        .groupBy("cluster")
        .agg(
            stability("temperature_2m_mean_interannual_std").alias("temperature_stability_mean"),
            stability("precipitation_sum_interannual_std").alias("rainfall_reliability_mean"),
        )
    )
    rows = _with_ranges(_means(df, columns).join(steady, "cluster"), df, [rain, solar])
    frost, heat, r, h = _m("frost_risk"), _m("heat_stress"), _m(rain), _m("relative_humidity_2m_mean")
    half = F.lit(0.5)
    score = (
        0.22 * _closeness(truthy_or(_m("temperature_2m_mean"), 25), 24, 14)
        + 0.22 * _rank(df, rain)
        + 0.14 * _closeness(truthy_or(h, 60), 60, 35)
        + 0.10 * _rank(df, solar)
        + 0.14 * F.coalesce(F.col("temperature_stability_mean"), half)
        + 0.18 * F.coalesce(F.col("rainfall_reliability_mean"), half)
        - 0.10 * F.coalesce(frost, F.lit(0.0))
        - 0.10 * F.coalesce(heat, F.lit(0.0))
    )
    return (
        rows.withColumn("agriculture_suitability_score", F.bround(score, 3))
        .withColumn(
            "agriculture_summary",
            _tags(
                [
                    ("frost-exposed", frost > 0.2),
                    ("heat-stressed", heat > 0.2),
                    ("water-limited", r < 1.2),
                    ("rain-supported", r > 2.5),
                    ("humid-growing-zone", h > 75),
                ],
                "balanced-growing-conditions",
            ),
        )
        .withColumn(
            "agriculture_recommendation",
            _first(
                [
                    (frost > 0.2, "Prefer cold-tolerant crops and short growing windows."),
                    (heat > 0.2, "Prioritize heat-resilient varieties and irrigation support."),
                    (r < 1.2, "Suitable for drought-tolerant cropping with water management."),
                    (r > 2.5, "Good fit for rain-fed agriculture with drainage planning."),
                ],
                "Balanced conditions for diversified cropping and stable seasonal planning.",
            ),
        )
        .drop("_q")
        .orderBy(F.desc("agriculture_suitability_score"), "cluster")
    )


def energy(df: DataFrame) -> DataFrame:
    """Potential for solar and wind power, best first."""
    solar, wind, use = "shortwave_radiation_sum", "wind_power_density_120m", "solar_utilization_ratio"
    columns = (
        solar,
        "wind_speed_120m_mean",
        wind,
        use,
        "solar_wind_complementarity",
        "cloud_cover_mean",
    )
    rows = _with_ranges(_means(df, columns), df, [solar, wind, use])
    s, w = F.coalesce(_m(solar), F.lit(0.0)), F.coalesce(_m(wind), F.lit(0.0))
    pairing = F.coalesce(_m("solar_wind_complementarity"), F.lit(0.0))
    score = (
        0.30 * _rank(df, solar)
        + 0.35 * _rank(df, wind)
        + 0.20 * _rank(df, use)
        + 0.15 * unit((pairing + 1) / 2)
    )
    mix = _first(
        [
            ((s >= 19) & (w >= 1.8), "Hybrid Solar-Wind"),
            (s >= 18.5, "Solar-Led"),
            (w >= 1.8, "Wind-Led"),
        ],
        "Balanced Renewable",
    )
    chosen = F.col("resource_mix")
    return (
        rows.withColumn("energy_potential_score", F.bround(score, 3))
        .withColumn("resource_mix", mix)
        .withColumn(
            "energy_summary",
            _tags(
                [
                    ("solar-favored", _m(solar) > 19),
                    ("wind-favored", _m(wind) > 1.8),
                    ("hybrid-friendly", _m("solar_wind_complementarity") > -0.2),
                ],
                "moderate-renewable-potential",
            ),
        )
        .withColumn(
            "energy_recommendation",
            _first(
                [
                    (
                        chosen == "Hybrid Solar-Wind",
                        "Strong candidate for hybrid renewable parks with storage integration.",
                    ),
                    (
                        chosen == "Solar-Led",
                        "Best suited for utility-scale solar with cloud-aware generation planning.",
                    ),
                    (
                        chosen == "Wind-Led",
                        "Best suited for elevated wind development and transmission planning.",
                    ),
                ],
                "Moderate multi-source renewable potential with balanced deployment options.",
            ),
        )
        .drop("_q")
        .orderBy(F.desc("energy_potential_score"), "cluster")
    )


# Hazards in the order that decides between equal strengths.
HAZARDS = ("Heavy Rain / Flooding", "High Wind Exposure", "Dry Spell / Drought Stress")
HAZARD_ADVICE = (
    "Prioritize drainage, runoff management, and flood-resilient infrastructure.",
    "Strengthen wind-resilient design standards and network reliability planning.",
    "Prioritize water security, reservoir planning, and drought monitoring.",
)


def disaster(df: DataFrame) -> DataFrame:
    """Exposure to hazards, highest first."""
    columns = (
        "heavy_rain_flag",
        "extreme_rain_flag",
        "precipitation_sum",
        "precipitation_sum_interannual_std",
        "wind_speed_120m_mean",
        "wind_power_density_120m",
        "cloud_cover_mean_interannual_std",
        "relative_humidity_2m_mean",
        "solar_utilization_ratio",
    )
    return disaster_scores(_means(df, columns))


def disaster_scores(means: DataFrame) -> DataFrame:
    """Hazard scores of a table of cluster means."""
    zero = lambda c: F.coalesce(_m(c), F.lit(0.0))
    r, d = zero("precipitation_sum"), zero("precipitation_sum_interannual_std")
    w, c = zero("wind_power_density_120m"), zero("cloud_cover_mean_interannual_std")
    h, u = zero("relative_humidity_2m_mean"), zero("solar_utilization_ratio")
    capped = lambda value: F.least(value, F.lit(1.0))
    drought = capped(_at_least_zero(2 * (u - 0.5)) + _at_least_zero((1.5 - r) / 1.5))
    score = (
        0.24 * capped(r / 3)
        + 0.18 * capped(d / 150)
        + 0.18 * capped(w / 3)
        + 0.14 * capped(c / 10)
        + 0.10 * capped(h / 100)
        + 0.16 * drought
    )
    rain = r + d / 100
    wind = w + zero("wind_speed_120m_mean") / 10
    dry = _at_least_zero(u - 0.5) + _at_least_zero(1.5 - r)
    strongest = F.greatest(rain, wind, dry)
    hazard = _first([(rain == strongest, HAZARDS[0]), (wind == strongest, HAZARDS[1])], HAZARDS[2])
    chosen = F.col("dominant_hazard")
    return (
        means.withColumn("disaster_risk_score", F.bround(score, 3))
        .withColumn("dominant_hazard", hazard)
        .withColumn(
            "disaster_summary",
            _tags(
                [
                    ("flood-prone", _m("precipitation_sum") > 2.5),
                    ("storm-exposed", _m("wind_power_density_120m") > 1.8),
                    ("dry-spell-sensitive", _m("solar_utilization_ratio") > 0.55),
                ],
                "lower-observed-extreme-risk",
            ),
        )
        .withColumn(
            "risk_recommendation",
            _first(
                [(chosen == h, text) for h, text in zip(HAZARDS[:2], HAZARD_ADVICE[:2])],
                HAZARD_ADVICE[2],
            ),
        )
        .orderBy(F.desc("disaster_risk_score"), "cluster")
    )


def urban(df: DataFrame) -> DataFrame:
    """Comfort of towns, best first."""
    columns = (
        "temperature_2m_mean",
        "relative_humidity_2m_mean",
        "wind_speed_10m_mean",
        "cloud_cover_mean",
        "shortwave_radiation_sum",
        "temperature_2m_mean_interannual_std",
    )
    return urban_scores(_means(df, columns))


def urban_scores(means: DataFrame) -> DataFrame:
    """Comfort scores of a table of cluster means."""
    t = truthy_or(_m("temperature_2m_mean"), 25)
    h = truthy_or(_m("relative_humidity_2m_mean"), 60)
    v = truthy_or(_m("wind_speed_10m_mean"), 3)
    s = truthy_or(_m("shortwave_radiation_sum"), 18)
    c = truthy_or(_m("cloud_cover_mean"), 50)
    stress = _at_least_zero((t - 24) / 4.5) + _at_least_zero((h - 65) / 20)
    comfort = 0.45 * _closeness(t, 24, 12) + 0.35 * _closeness(h, 58, 35) + 0.20 * _closeness(v, 3, 4)
    island = (
        _at_least_zero((t - 25) / 8)
        + _at_least_zero((s - 18) / 5)
        + _at_least_zero((55 - c) / 40)
        + _at_least_zero((3 - v) / 3)
    ) / 4
    rows = (
        means.withColumn("thermal_stress_index_mean", F.bround(stress, 3))
        .withColumn("outdoor_comfort_score_mean", F.bround(comfort, 3))
        .withColumn("heat_island_potential_mean", F.bround(unit(island), 3))
    )
    stressed, outdoor = F.col("thermal_stress_index_mean"), F.col("outdoor_comfort_score_mean")
    heated = F.col("heat_island_potential_mean")
    damp = F.when(_m("relative_humidity_2m_mean") > 75, F.lit(0.5)).otherwise(F.lit(0.0))
    score = 4 * outdoor - _at_least_zero(stressed) - 2 * heated - damp
    return (
        rows.withColumn("urban_comfort_score", F.bround(score, 3))
        .withColumn(
            "urban_summary",
            _tags(
                [
                    ("cooling-infrastructure-priority", heated > 0.5),
                    ("outdoor-friendly", outdoor > 0.6),
                    ("thermal-discomfort-prone", stressed > 2),
                ],
                "moderate-urban-comfort",
            ),
        )
        .withColumn(
            "urban_recommendation",
            _first(
                [
                    (
                        heated > 0.5,
                        "Prioritize shade, reflective materials, and urban cooling infrastructure.",
                    ),
                    (
                        outdoor > 0.65,
                        "Suitable for public-space activation and walkable urban design.",
                    ),
                    (
                        stressed > 1.2,
                        "Focus on cooling corridors, ventilation, and heat-health planning.",
                    ),
                ],
                "Moderate comfort profile; use mixed passive cooling and open-space strategies.",
            ),
        )
        .orderBy(F.desc("urban_comfort_score"), "cluster")
    )


SCORES = {
    "agriculture": "agriculture_suitability_score",
    "energy": "energy_potential_score",
    "disaster": "disaster_risk_score",
    "urban": "urban_comfort_score",
}
SECTORS = {"agriculture": agriculture, "energy": energy, "disaster": disaster, "urban": urban}


def top_regions(df: DataFrame, labels: DataFrame) -> DataFrame:
    """(sector, cluster, cluster_label, score): the leading cluster of every sector."""
    rows = None
    for sector, column in SCORES.items():
        best = F.max(F.struct(F.col(column).alias("score"), (-F.col("cluster")).alias("c")))
        one = SECTORS[sector](df).agg(best.alias("b")).select(
            F.lit(sector).alias("sector"), (-F.col("b.c")).alias("cluster"), F.col("b.score")
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows.join(labels.select("cluster", "cluster_label"), "cluster", "left")
