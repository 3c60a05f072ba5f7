"""Stage tables in shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; local sessions may lack it."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="gridclime-")
        context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet to the stage folder and read them from there.

    Later plans start at the files: they prune columns, and a lost executor
    costs no recomputation of earlier stages.
    """
    path = f"{stage_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: One text per place. Spark rewrites floating-point keys of windows and groups, so that rows already together by two
#: numbers are shuffled and sorted again; by a text they stay.
SPOT = "_spot"


def with_spot(df: DataFrame, place: Sequence[str]) -> DataFrame:
    """Rows with ``SPOT``, equal where all of ``place`` is equal (zeros of either sign are)."""
    texts = [F.coalesce((F.col(c) + F.lit(0.0)).cast("string"), F.lit("-")) for c in place]
    return df.withColumn(SPOT, F.concat_ws("/", *texts))


def together(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of equal keys in one partition, for steps that add many columns before they group by the keys and more.

    Narrow rows are shuffled once here; no later group or window by these keys
    shuffles the wide ones.
    """
    return df.repartition(*keys)
