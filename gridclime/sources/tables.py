"""Tables, metadata and models at rest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame, path: str, format: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Overwrite a table; Parquet by default, CSV with a header as an option.

    Rows are first grouped by the partition columns, so that each value gets a
    few files instead of one per task; a rebalance splits the large values.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if format == "csv":
        writer = writer.option("header", True)
    writer.format(format).save(path)


def read_table(
    spark: SparkSession, path: str, format: str = "parquet", schema: str | None = None
) -> DataFrame:
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.option("header", True)
    if schema:
        reader = reader.schema(schema)
    return reader.load(path)


def write_daily(df: DataFrame, path: str) -> None:
    """Daily rows partitioned by year, so date filters prune folders."""
    write_table(df.withColumn("year", F.year("date")), path, partition_by=["year"])


def write_metadata(spark: SparkSession, values: Mapping[str, object], path: str) -> None:
    """One JSON record."""
    spark.createDataFrame([dict(values)]).write.mode("overwrite").json(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    return spark.read.json(path).first().asDict(recursive=True)


def save_model(model, path: str) -> None:
    """Store an MLlib model or pipeline."""
    stage = model if isinstance(model, PipelineModel) else PipelineModel([model])
    stage.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def preview(df: DataFrame, key: Sequence[str], n: int = 10) -> DataFrame:
    """The first rows by key."""
    return df.orderBy(*key).limit(n)
