import numpy as np
import pytest
from pyspark.sql import functions as F

from gridclime.functions.quantiles import quantiles
from gridclime.operators import clean, explore, normalize
from gridclime.plans import flows

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def frame(spark, n):
    """A third of the rows hold one value; one column has NULLs."""
    return spark.range(n).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.rand(1) * 100).alias("a"),
        F.when(F.col("id") % 5 != 0, F.randn(2)).alias("b"),
    ).persist()


# A small accuracy makes the sketch bracket a few values only.
@pytest.mark.parametrize("n,accuracy", [(1, 10_000), (10, 10_000), (3001, 10_000), (20_000, 500)])
def test_equal_to_percentile(spark, n, accuracy):
    df = frame(spark, n)
    got = quantiles(df, ["a", "b"], PROBS, accuracy=accuracy).first()
    want = df.agg(*[F.percentile(c, PROBS).alias(c) for c in ("a", "b")]).first()
    for c in ("a", "b"):
        if want[c] is None:
            assert got[c] == [None] * len(PROBS)
        else:
            assert got[c] == pytest.approx(want[c])


def test_by_group(spark):
    df = frame(spark, 9000)
    got = {r["g"]: r for r in quantiles(df, ["a", "b"], PROBS, by=["g"], accuracy=300).collect()}
    want = df.groupBy("g").agg(*[F.percentile(c, PROBS).alias(c) for c in ("a", "b")]).collect()
    assert len(got) == len(want) == 3
    for row in want:
        for c in ("a", "b"):
            assert got[row["g"]][c] == pytest.approx(row[c])


def test_no_rows(spark):
    df = frame(spark, 10).filter("false")
    assert quantiles(df, ["a"], [0.5]).first()["a"] == [None]


def test_interpolates(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 10)], "v double")
    assert quantiles(df, ["v"], [0.5]).first()["v"] == [2.5]
    assert quantiles(df, ["v"], [0.33]).first()["v"][0] == pytest.approx(
        np.quantile([1, 2, 3, 10], 0.33)
    )


def counted_reads(spark, n: int):
    """A table of n rows, and a counter of the rows that were read from it."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(n).selectExpr("CAST(id AS DOUBLE) AS v", "CAST(id % 7 AS DOUBLE) AS w")
    return rows.mapInArrow(seen, "v double, w double"), read


def test_a_table_is_read_twice(spark):
    rows, read = counted_reads(spark, 30_000)
    assert quantiles(rows, ["v", "w"], [0.5]).first()["v"] == [14999.5]
    assert read.value == 2 * 30_000


def test_a_description_reads_its_input_once(spark):
    rows, read = counted_reads(spark, 30_000)
    found = {r["column"]: r for r in explore.describe(rows, ["v", "w"]).collect()}
    assert read.value == 30_000
    assert found["v"]["median"] == 14999.5 and found["v"]["count"] == 30_000
    assert found["w"]["min"] == 0 and found["w"]["max"] == 6


def test_stages_compared_as_cleaned_after_normalizing(spark):
    """Raw columns cleaned once and copied are the copies cleaned."""
    days = spark.range(600).selectExpr(
        "CAST(id % 3 AS DOUBLE) AS latitude",
        "0.0D AS longitude",
        "DATE_ADD(DATE'2020-01-01', CAST(id / 3 AS INT)) AS date",
        "CASE WHEN id % 11 > 0 THEN CAST(id * 7919 % 101 AS DOUBLE) END AS T2M",
        "CAST(id * 31 % 400 AS DOUBLE) + 500 AS PS",
    )
    key = ["latitude", "longitude", "date"]
    one = flows.cleaned(days).orderBy(key)
    two = clean.clean(normalize.normalize(days)).select(one.columns).orderBy(key)
    assert one.collect() == two.collect()
