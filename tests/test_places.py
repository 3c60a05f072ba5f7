import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridclime.functions.columns import great_circle_km
from gridclime.sources import grid, payloads, tables


def test_grid_shape(spark):
    df = grid.grid(spark, "india")
    rows = df.orderBy("point_id").collect()
    assert len(rows) == 59 * 60
    assert tuple(rows[0]) == ("PT_00000", 8.0, 68.0)
    assert tuple(rows[61]) == ("PT_00061", 8.5, 68.5)


def test_renumber_in_blocks(spark):
    df = grid.grid(spark, "india").filter("latitude * 2 % 3 = 0")
    got = [r["point_id"] for r in grid.renumber(df, block=100).orderBy("point_id").collect()]
    assert got == [f"PT_{i:05d}" for i in range(len(got))]
    old = df.orderBy("point_id").select("latitude", "longitude").collect()
    new = grid.renumber(df, block=100).orderBy("point_id").select("latitude", "longitude").collect()
    assert old == new


def test_inside_a_square(spark):
    edges = grid.ring_edges(spark, [(69.9, 9.9), (71.1, 9.9), (71.1, 11.1), (69.9, 11.1)])
    got = grid.inside(grid.grid(spark, (9.0, 12.0, 69.0, 72.0, 0.5)), edges)
    spots = {(r["latitude"], r["longitude"]) for r in got.collect()}
    assert spots == {(a, o) for a in (10.0, 10.5, 11.0) for o in (70.0, 70.5, 71.0)}


def test_samples(spark):
    df = grid.grid(spark, "india")
    assert grid.sample_stratified(df, 4000).count() == 3540
    got = grid.sample_stratified(df, 50)
    assert got.count() == 50 and got.columns == df.columns
    pdf = df.orderBy("point_id").toPandas()
    cells = [pd.qcut(pdf[c], 7, duplicates="drop") for c in ("latitude", "longitude")]
    pdf["tier"] = pdf.groupby(cells, observed=True).cumcount()
    want = pdf.sort_values(["tier", "latitude", "longitude"]).head(50)
    assert {r["point_id"] for r in got.collect()} == set(want["point_id"])
    head = [r["point_id"] for r in grid.sample_head(df, 3).collect()]
    assert head == ["PT_00000", "PT_00001", "PT_00002"]


def test_distance(spark):
    km = great_circle_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))
    assert spark.range(1).select(km).first()[0] == pytest.approx(6371 * np.pi / 2)


def test_payloads(spark):
    good = (
        '{"properties":{"parameter":{"T2M":{"20000101":1.5,"20000102":-999},'
        '"WS10M":{"20000102":4.0,"20000103":5.0}}}}'
    )
    rows = [(1.0, 2.0, good), (1.0, 3.0, "oops"), (1.0, 4.0, '{"properties":{"parameter":{}}}')]
    df = spark.createDataFrame(rows, "latitude double, longitude double, payload string")
    got = payloads.parse_payloads(df, codes=["T2M", "WS10M"]).orderBy("date").collect()
    assert [(r["T2M"], r["WS10M"]) for r in got] == [(1.5, None), (None, 4.0)]
    assert {r["longitude"] for r in payloads.failed_payloads(df).collect()} == {3.0, 4.0}


def test_place_files_by_equal_id(spark, tmp_path):
    for pid, v in (("PT_00001", 1.0), ("PT_000012", 2.0)):
        (tmp_path / f"nasa_power_{pid}_8.0_68.5.csv").write_text(f"v\n{v}\n")
    ids = spark.createDataFrame([("PT_00001",)], "point_id string")
    got = payloads.combine_files(spark, str(tmp_path), "v double", ids)
    assert [r["v"] for r in got.collect()] == [1.0]
    listed = payloads.place_files(payloads.list_files(spark, str(tmp_path)))
    assert {(r["point_id"], r["latitude"], r["longitude"]) for r in listed.collect()} == {
        ("PT_00001", 8.0, 68.5),
        ("PT_000012", 8.0, 68.5),
    }


def test_tables_and_metadata(spark, tmp_path):
    df = spark.range(5).selectExpr("id", "id * 2.5D AS v")
    for kind in ("parquet", "csv"):
        path = str(tmp_path / kind)
        tables.write_table(df, path, kind)
        back = tables.read_table(spark, path, kind, "id long, v double")
        assert sorted(back.collect()) == sorted(df.collect())
    tables.write_metadata(spark, {"name": "x", "features": ["a", "b"]}, str(tmp_path / "meta"))
    assert tables.read_metadata(spark, str(tmp_path / "meta"))["features"] == ["a", "b"]
