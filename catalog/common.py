"""Shared parts of the named queries: inputs, rounding, SQL building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclime.operators import normalize
from gridclime.registry import ALIASES, RAW_CODES, SET_FROM_MEAN
from gridclime.sources import projections as P

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

# Both sides round doubles after this offset: plain rounding differs on ties.
OFFSET = 0.00000031


def query(name: str, sql: str | None = None):
    """Register a query; doubles are rounded, integers are bigint, dates are text."""

    def register(build):
        QUERIES[name] = lambda spark, sf_dir: tidy(build(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def tidy(df: DataFrame) -> DataFrame:
    def column(field):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return (F.round(c + OFFSET, 4) + 0.0).alias(field.name)
        if isinstance(field.dataType, T.IntegralType):
            return c.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return c.cast("string").alias(field.name)
        return c

    return df.select(*[column(f) for f in df.schema.fields])


def r(expression: str, name: str | None = None) -> str:
    """SQL for a rounded double."""
    return f"ROUND({expression} + 0.00000031E0, 4) + 0.0E0 AS {name or expression}"


def big(expression: str, name: str | None = None) -> str:
    return f"CAST({expression} AS BIGINT) AS {name or expression}"


def rounded(sql: str, keys: str, doubles, bigs=()) -> str:
    """Final projection of a query over an inner one."""
    names = [k.strip() for k in keys.split(",")] if keys else []
    columns = [day(k) if k in DATES else k for k in names]
    columns += [r(c) for c in doubles] + [big(c) for c in bigs]
    return f"SELECT {', '.join(columns)} FROM ({sql}) answer"


DATES = ("date", "start")


def day(expression: str, name: str | None = None) -> str:
    """SQL for a date as text, as on the Spark side."""
    return f"CAST({expression} AS VARCHAR) AS {name or expression}"


def with_(ctes: dict[str, str], final: str) -> str:
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in ctes.items()) + " " + final


# ------------------------------------------------------------------ inputs


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.view(spark, sf_dir, P.NASA_RAW)


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalize(raw(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.view(spark, sf_dir, P.HOURLY_FULL)


KEYS = "latitude, longitude, date"
RAW_NAMES = list(RAW_CODES.values())
ALIAS_NAMES = list(ALIASES)
MEAN_TARGETS = {t: mean for mean, targets in SET_FROM_MEAN.items() for t in targets}
DAILY_COLUMNS = [*RAW_NAMES, *ALIAS_NAMES, *MEAN_TARGETS]

RENAMED_SQL = (
    f"SELECT {KEYS}, " + ", ".join(f"{k} AS {v}" for k, v in RAW_CODES.items()) + " FROM raw"
)
NORMALIZED_CTES = {
    "raw": P.NASA_RAW,
    "renamed": RENAMED_SQL,
    "norm": "SELECT renamed.*, "
    + ", ".join(f"{source} AS {alias}" for alias, source in ALIASES.items())
    + ", "
    + ", ".join(f"{ALIASES[mean]} AS {target}" for target, mean in MEAN_TARGETS.items())
    + " FROM renamed",
}
