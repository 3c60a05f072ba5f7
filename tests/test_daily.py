import math
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridclime.functions import lineage
from gridclime.operators import clean, features, normalize, rollup, validate
from gridclime.plans import flows

START = date(2020, 1, 1)


def series(spark, values, lat=10.0, lon=70.0):
    rows = [(lat, lon, START + timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "latitude double, longitude double, date date, v double")


def filled(df):
    return [r["v"] for r in df.orderBy("date").collect()]


@pytest.mark.parametrize("seed", range(4))
def test_interpolate_like_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=120).round(3)
    for _ in range(6):
        at = int(rng.integers(0, 110))
        values[at : at + int(rng.integers(1, 25))] = np.nan
    want = pd.Series(values).interpolate(method="linear", limit=7, limit_direction="both")
    data = [None if math.isnan(v) else float(v) for v in values]
    got = filled(clean.interpolate(series(spark, data), ["v"]))
    assert [math.nan if v is None else v for v in got] == pytest.approx(list(want), nan_ok=True)


def test_interpolate_ends_and_empty(spark):
    got = filled(clean.interpolate(series(spark, [None] * 9 + [1.0] + [None] * 9), ["v"]))
    assert got == [None] * 2 + [1.0] * 15 + [None] * 2
    assert filled(clean.interpolate(series(spark, [None, None]), ["v"])) == [None, None]


def test_duplicates_keep_first(spark):
    rows = [(1.0, 2.0, START, 5, 9.0), (1.0, 2.0, START, 4, 8.0), (1.0, 3.0, START, 1, 7.0)]
    df = spark.createDataFrame(
        rows, "latitude double, longitude double, date date, n int, v double"
    )
    got = clean.drop_duplicates(df, ["n"]).orderBy("longitude").collect()
    assert [r["v"] for r in got] == [8.0, 7.0]
    # Many copies of one key are cut down before the shuffle.
    plan = clean.drop_duplicates(df, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    # Without an order the choice depends on the content only.
    one = clean.drop_duplicates(df).orderBy("longitude").collect()
    two = clean.drop_duplicates(df.orderBy(F.desc("n"))).orderBy("longitude").collect()
    assert one == two


def test_equal_quartiles_flatten(spark):
    df = series(spark, [1.0] * 20 + [50.0])
    assert set(filled(clean.cap_outliers(df))) == {1.0}
    assert max(filled(clean.cap_outliers(df, "physical"))) == 50.0


def test_clip_keeps_null(spark):
    df = series(spark, [None, -5.0, 700.0]).withColumnRenamed("v", "precipitation_sum")
    got = [r[3] for r in clean.clip_physical(df).orderBy("date").collect()]
    assert got == [None, 0.0, 500.0]


def test_place_scope_is_independent(spark):
    """A place's cleaned rows do not change when other places join the table."""
    one = series(spark, [1.0, None, 3.0, 4.0, 90.0, 5.0, 2.0, 3.0])
    more = one.unionByName(series(spark, [500.0, 900.0, None, 700.0], lat=30.0))
    alone = filled(clean.clean(one, factor=0.5, scope="place"))
    together = filled(clean.clean(more, factor=0.5, scope="place").filter("latitude = 10"))
    assert alone == together


def test_copies_can_be_cleaned_as_raw_columns(spark):
    """Cleaning raw columns and copying equals copying and cleaning."""
    rng = np.random.default_rng(5)
    rows = [
        (10.0 + p, 70.0, START + timedelta(days=i),
         None if rng.random() < 0.2 else float(rng.normal(20, 15)), float(rng.normal(90, 20)))
        for p in range(3) for i in range(60)
    ]
    df = spark.createDataFrame(
        rows, "latitude double, longitude double, date date, T2M double, RH2M double"
    )
    keys = ["latitude", "longitude", "date"]
    late = flows.daily_features(df)
    early = features.add_features(clean.clean(normalize.normalize(df)))
    assert sorted(late.columns) == sorted(early.columns)
    a = late.orderBy(keys).toPandas()[sorted(late.columns)]
    b = early.orderBy(keys).toPandas()[sorted(late.columns)]
    pd.testing.assert_frame_equal(a, b)


def test_published_figures(spark):
    df = spark.createDataFrame(
        [(4.95, 12.0, 20.96)],
        "wind_speed_10m_mean double, nasa_solar_irradiance_allsky double, "
        "nasa_solar_irradiance_clearsky double",
    )
    row = features.energy_features(features.wind_features(df)).first()
    assert row["wind_speed_80m_mean"] == pytest.approx(6.622741396191255, rel=1e-12)
    assert row["wind_power_density_80m"] == pytest.approx(3.8133966619405233, rel=1e-12)
    assert row["solar_utilization_ratio"] == pytest.approx(0.5725190839694656, rel=1e-12)


def test_features_of_one_row(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0)], "shortwave_radiation_sum double, wind_speed_10m_mean double"
    )
    row = features.add_features(df).first()
    assert row["solar_wind_complementarity"] is None


def test_features_are_null_safe(spark):
    df = spark.createDataFrame(
        [(None, None, None)],
        "temperature_2m_mean double, temperature_2m_min double, precipitation_sum double",
    )
    row = features.add_features(df).first()
    assert row["growing_degree_days"] is None
    assert (row["frost_risk"], row["heavy_rain_flag"]) == (0, 0)


def test_season_year(spark):
    df = series(spark, [1.0]).drop("date").withColumn("date", F.lit(date(2020, 12, 31)))
    row = rollup.to_seasonal(df).first()
    assert (row["season"], row["season_year"]) == ("Winter", 2021)


def test_empty_sums_are_zero(spark):
    df = series(spark, [None, None]).withColumnRenamed("v", "precipitation_sum")
    assert rollup.to_monthly(df).first()["precipitation_sum"] == 0


def test_normals_of_wettest_month(spark):
    values = [1.0] * 31 + [4.0] * 29 + [4.0] * 31  # February and March tie on the mean day
    df = series(spark, values).withColumnRenamed("v", "precipitation_sum")
    row = rollup.normals(df).first()
    assert row["wettest_month"] == 3.0  # March has two more days
    assert row["peak_month_rainfall_share"] == pytest.approx(124 / (31 + 116 + 124))


def test_normals_shuffle_narrow_rows_once(spark):
    place = ["latitude", "longitude"]
    days = "explode(sequence(date'2020-01-01', date'2021-12-31', interval 1 day)) AS date"
    df = spark.range(3).selectExpr("8.0 + id AS latitude", "70.0 + id AS longitude", days)
    df = df.withColumns({"precipitation_sum": F.day("date") / 7, "temperature_2m_mean": F.dayofyear("date") * 0.1})
    wide = features.add_features(lineage.together(df, place))
    parts = rollup.place_parts(rollup.month_parts(wide))
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert parts.select(F.size("months")).distinct().collect() == [(24,)]
    whole = rollup.place_means(rollup.month_parts(wide)).orderBy(*place).toPandas()
    pd.testing.assert_frame_equal(parts.drop("months").orderBy(*place).toPandas()[list(whole)], whole)


def test_mode_takes_the_smallest(spark):
    df = series(spark, [3.0, 1.0, 3.0, 1.0]).withColumnRenamed("v", "weather_code_mode")
    assert rollup.to_monthly(df).first()["weather_code_mode"] == 1.0


def test_report_flags_issues(spark):
    df = series(spark, [None, 1.0, 2.0]).withColumnRenamed("v", "precipitation_sum")
    got = {(r["check"], r["subject"]): r for r in validate.report(df, 10).collect()}
    missing = got["missing_values", "precipitation_sum"]
    assert missing["value"] == 33.33 and missing["is_issue"]
    assert got["coverage", "coverage_pct"]["value"] == 10.0
