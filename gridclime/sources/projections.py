"""Weather-shaped views of the driver tables, as SQL both Spark and DuckDB run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# 3,540 places half a degree apart; each further round lies north of the one before and never reaches the next step.
_LAT = "8.0E0 + 0.5E0*({0} % 59) + 0.49E0*FLOOR({0}/3540)/(FLOOR({0}/3540) + 1)"
_LON = "68.0E0 + 0.5E0*(({0}*7) % 60)"

# One place per supplier, one row per ship date.
NASA_RAW = f"""
SELECT {_LAT.format("pid")} AS latitude, {_LON.format("pid")} AS longitude, date,
  solar AS ALLSKY_SFC_SW_DWN, solar + 4.0E0 AS CLRSKY_SFC_SW_DWN, solar/(solar + 10.0E0) AS ALLSKY_KT,
  30.0E0 + 50.0E0*disc AS ALLSKY_SFC_LW_DWN,
  CASE WHEN pid % 2 = 0 OR pid % 5 = 0 THEN NULL ELSE 20.0E0*disc END AS ALLSKY_SFC_UV_INDEX,
  CASE WHEN (pid + doy) % 11 = 0 THEN NULL ELSE q - 5.0E0 END AS T2M, q - 12.0E0 AS T2MDEW, q - 4.0E0 AS TS,
  1000.0E0*disc AS RH2M, 200.0E0*disc AS QV2M,
  CASE WHEN (pid*3 + doy) % 13 = 0 THEN NULL WHEN (pid*5 + doy) % 3 = 0 THEN 0.0E0 ELSE ep/800.0E0 END AS PRECTOTCORR,
  CAST(100.0E0*tax AS DOUBLE) AS WS10M, CAST((pid*37 + doy*11) % 360 AS DOUBLE) AS WD10M,
  101.0E0 - 2.0E0*disc AS PS, CAST((pid*13 + doy*7) % 101 AS DOUBLE) AS CLOUD_AMT
FROM (SELECT l_suppkey AS pid, CAST(l_shipdate AS DATE) AS date, CAST(EXTRACT(DOY FROM l_shipdate) AS BIGINT) AS doy,
        AVG(l_quantity) AS q, AVG(l_extendedprice) AS ep, AVG(l_discount) AS disc, AVG(l_tax) AS tax,
        AVG(l_extendedprice)/2000.0E0 AS solar
      FROM lineitem
      GROUP BY l_suppkey, CAST(l_shipdate AS DATE), CAST(EXTRACT(DOY FROM l_shipdate) AS BIGINT)) d
"""

# One place per user, one row per hour with an event.
HOURLY = f"""
SELECT {_LAT.format("user_id")} AS latitude, {_LON.format("user_id")} AS longitude,
  DATE_TRUNC('hour', ts) AS hour,
  AVG(value)/2.0E0 - 5.0E0 AS temperature_2m,
  MAX(CASE WHEN event_type = 'error' THEN value/50.0E0 ELSE 0.0E0 END) AS precipitation,
  MIN(value)/4.0E0 AS wind_speed_10m,
  CAST(MAX(event_id) % 101 AS DOUBLE) AS relative_humidity_2m,
  CAST(MIN(event_id) % 101 AS DOUBLE) AS cloud_cover,
  CAST(MAX(event_id) % 5 AS BIGINT) AS weather_code
FROM events
GROUP BY {_LAT.format("user_id")}, {_LON.format("user_id")}, DATE_TRUNC('hour', ts)
"""

# All hourly parameters, derived from those above.
HOURLY_FULL = f"""
SELECT h.*, temperature_2m + relative_humidity_2m/10.0E0 - 4.0E0 AS apparent_temperature,
  temperature_2m - (100.0E0 - relative_humidity_2m)/5.0E0 AS dewpoint_2m,
  (100.0E0 - relative_humidity_2m)/40.0E0 AS vapour_pressure_deficit,
  0.75E0*precipitation AS rain, 0.25E0*precipitation AS showers,
  CASE WHEN temperature_2m < 0 THEN precipitation ELSE 0.0E0 END AS snowfall,
  CASE WHEN temperature_2m < 0 THEN precipitation/10.0E0 END AS snow_depth,
  1000.0E0 + relative_humidity_2m/4.0E0 AS pressure_msl,
  990.0E0 + relative_humidity_2m/4.0E0 AS surface_pressure,
  cloud_cover/2.0E0 AS cloud_cover_low, cloud_cover/4.0E0 AS cloud_cover_mid,
  100.0E0 - cloud_cover AS cloud_cover_high,
  3.0E0*relative_humidity_2m AS wind_direction_10m, 2.5E0*wind_speed_10m AS wind_gusts_10m,
  2.0E0*(101.0E0 - cloud_cover) AS shortwave_radiation,
  CASE WHEN cloud_cover > 50 THEN 0.0E0 ELSE relative_humidity_2m/64.0E0 END AS et0_fao_evapotranspiration
FROM ({HOURLY}) h
"""

# A second daily source, of another kind: orders by customer and day. Most of its places and days are its own.
SECOND_SOURCE = f"""
SELECT {_LAT.format("o_custkey")} + 0.02E0 AS latitude, {_LON.format("o_custkey")} + 0.02E0 AS longitude,
  CAST(o_orderdate AS DATE) AS date, AVG(CAST(o_totalprice AS DOUBLE))/20000.0E0 AS temperature_2m_mean,
  CAST(MAX(o_orderkey) % 29 AS DOUBLE)*1.5E0 AS precipitation_sum, CAST(MAX(o_orderkey) % 17 AS DOUBLE)/2.0E0 AS wind_speed_10m_mean
FROM orders
GROUP BY o_custkey, CAST(o_orderdate AS DATE)
"""

# Every line item as an observation, so (place, date) repeats.
OBSERVATIONS = f"""
SELECT {_LAT.format("l_suppkey")} AS latitude, {_LON.format("l_suppkey")} AS longitude,
  CAST(l_shipdate AS DATE) AS date, l_orderkey AS source_file, CAST(l_linenumber AS BIGINT) AS source_row,
  l_quantity - 5.0E0 AS T2M, 100.0E0*l_tax AS WS10M
FROM lineitem
"""

# A label per place, -1 (noise) to 7.
PLACE_LABELS = f"""
SELECT {_LAT.format("s_suppkey")} AS latitude, {_LON.format("s_suppkey")} AS longitude,
  CAST(s_suppkey % 9 - 1 AS INT) AS cluster
FROM supplier
"""

# Boundary corners as (longitude, latitude); closed by the last edge.
BOUNDARY = ((70.13, 9.27), (90.31, 9.27), (96.17, 28.41), (78.23, 36.19), (70.13, 26.37))


def register(spark: SparkSession, sf_dir: str) -> None:
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(sql)
