"""A place's days: the steps in one task, against the expressions they stand for."""

import re
from datetime import date, timedelta

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridclime.functions import lineage
from gridclime.operators import assign, clean, rollup
from gridclime.plans import flows

PLACE = ["latitude", "longitude"]


def days(spark, places=3, n=400, codes=("T2M", "PRECTOTCORR", "WS10M", "ALLSKY_SFC_SW_DWN")):
    rng = np.random.default_rng(7)
    rows = [
        (8.0 + p, 70.0 - p, None if i == 5 else date(2020, 1, 1) + timedelta(days=i + i // 40),
         *[None if rng.random() < 0.1 or (p == 1 and j == 1) else float(rng.normal(9, 30)) for j in range(len(codes))])
        for p in range(places) for i in range(n)
    ]
    return spark.createDataFrame(rows, "latitude double, longitude double, date date, " + ", ".join(f"{c} double" for c in codes))


def test_place_quantiles_are_those_of_percentile(spark):
    df = days(spark).withColumn("WS10M", F.when(F.col("T2M") > 60, F.lit(float("nan"))).otherwise(F.col("WS10M")))
    codes, whole = df.columns[3:], Window.partitionBy(*PLACE)
    first, third = ({c: F.percentile(c, p).over(whole) for c in codes} for p in (0.25, 0.75))
    spread = {c: 0.5 * (third[c] - first[c]) for c in codes}
    capped = {c: F.when(F.col(c).isNotNull(), F.least(F.greatest(c, first[c] - spread[c]), third[c] + spread[c])) for c in codes}
    month = Window.partitionBy(*PLACE, F.month("date"))
    for got, want in (
        (clean.cap_outliers(df, factor=0.5, scope="place"), capped),
        (clean.fill_median(df, codes, "place"), {c: F.coalesce(c, F.percentile(c, 0.5).over(whole)) for c in codes}),
        (clean.fill_month_median(df, codes), {c: F.coalesce(c, F.percentile(c, 0.5).over(month)) for c in codes}),
    ):
        a, b = ([tuple(map(str, r)) for r in x.collect()] for x in (got, df.withColumns(want)))
        assert sorted(a) == sorted(b)
        # One hash map of values per place and column is what made caps slow.
        assert "percentile" not in got._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_place_are_shuffled_narrow_only(spark):
    """After the copies and features are added, no row moves or is sorted again."""
    daily = flows._featured(days(spark), "place", ())
    place = (lineage.SPOT, *PLACE)
    plan = rollup.place_parts(rollup.month_parts(daily, place), place)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert len(re.findall(r"Sort \[", plan)) == 2


def test_new_places_are_computed_once(spark, monkeypatch):
    """Texts and examples read the stored new places, however costly those are to make."""
    seen = []
    monkeypatch.setattr(assign, "materialize", lambda df: seen.append(df.columns) or lineage.materialize(df))
    training = days(spark, 4, 1).select(*PLACE, F.col("T2M").alias("temperature_2m_mean"), F.lit(0).alias("cluster"))
    new = training.select(*PLACE, "cluster", F.lit(None).cast("int").alias("alternative"), F.lit(1.0).alias("confidence"),
                          F.array(F.lit(0.0)).alias("x"), F.xxhash64(*PLACE).alias("query_id"))
    got = assign.describe_assignments(new, training, ["temperature_2m_mean"])
    assert len(seen) == 1
    assert [r["n"] for r in got.select(F.size("nearest_examples").alias("n")).collect()] == [3] * 4
