"""Raw JSON payloads and per-place files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclime.functions.columns import known
from gridclime.registry import PLACE, RAW_CODES

PAYLOAD_SCHEMA = "properties struct<parameter: map<string, map<string, double>>>"
FILE_PATTERN = r"nasa_power_(PT_\d+)_(-?[0-9.]+)_(-?[0-9.]+)\.csv(/|$)"


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: path, payload."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.col("value").alias("payload")
    )


def _parameters(payloads: DataFrame) -> DataFrame:
    parsed = F.from_json("payload", PAYLOAD_SCHEMA)
    return payloads.withColumn("_parameters", parsed["properties"]["parameter"])


def parse_payloads(
    payloads: DataFrame, key: Sequence[str] = PLACE, codes: Sequence[str] = tuple(RAW_CODES)
) -> DataFrame:
    """Daily rows of payloads: the key, date, and one column per parameter code.

    The first parameter of a payload decides its timestamps. Missing values and
    the sentinel become NULL. The series of a payload are aligned inside its
    row, so nothing is shuffled; two payloads of one place give rows of their
    own, which ``drop_duplicates`` reduces. A series that has the timestamps of
    the first one is taken as it is, another is looked up by timestamp.
    """
    stamps = F.map_keys(F.get(F.map_values("_parameters"), F.lit(0)))

    def aligned(code: str) -> Column:
        series = F.col(f"_s_{code}")
        looked_up = F.transform("_stamps", lambda s: F.try_element_at(series, s))
        return F.when(F.map_keys(series) == F.col("_stamps"), F.map_values(series)).otherwise(
            looked_up
        )

    wide = _parameters(payloads).select(
        *key,
        stamps.alias("_stamps"),
        *[F.try_element_at("_parameters", F.lit(code)).alias(f"_s_{code}") for code in codes],
    )
    cells = F.arrays_zip("_stamps", *[aligned(code).alias(code) for code in codes])
    return (
        wide.select(*key, F.explode(cells).alias("_cell"))
        .select(
            *key,
            F.to_date(F.substring("_cell._stamps", 1, 8), "yyyyMMdd").alias("date"),
            *[known(F.col(f"_cell.{code}")).alias(code) for code in codes],
        )
    )


def failed_payloads(payloads: DataFrame) -> DataFrame:
    """Rows whose payload does not parse or holds no parameter."""
    parameters = F.col("_parameters")
    bad = parameters.isNull() | (F.size(parameters) == 0)
    return _parameters(payloads).filter(bad).drop("_parameters")


def place_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """Place id and coordinates encoded in file names."""
    part = lambda i: F.regexp_extract(path, FILE_PATTERN, i)
    return paths.filter(F.col(path).rlike(FILE_PATTERN)).select(
        F.col(path),
        part(1).alias("point_id"),
        part(2).cast("double").alias("latitude"),
        part(3).cast("double").alias("longitude"),
    )


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths below a folder; contents are not read."""
    return spark.read.format("binaryFile").load(folder).select("path")


def combine_files(
    spark: SparkSession, folder: str, schema: str, point_ids: DataFrame | None = None
) -> DataFrame:
    """All per-place CSV files as one table, or those of given place ids."""
    rows = spark.read.schema(schema).csv(f"{folder}/nasa_power_PT_*.csv", header=True)
    if point_ids is None:
        return rows
    tagged = rows.withColumn("point_id", F.regexp_extract(F.input_file_name(), FILE_PATTERN, 1))
    return tagged.join(point_ids.select("point_id"), "point_id", "left_semi").select(*rows.columns)


def pending_places(requested: DataFrame, completed: DataFrame) -> DataFrame:
    """Requested places without a completed one at the same coordinates (4 digits)."""
    spot = [F.bround(c, 4).alias(f"_{c}") for c in PLACE]
    done = completed.select(*spot).distinct()
    return (
        requested.select("*", *spot)
        .join(done, [f"_{c}" for c in PLACE], "left_anti")
        .select(*requested.columns)
    )
