"""Checks on daily tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclime.functions.lineage import materialize
from gridclime.registry import PLACE, VALID_RANGES

MISSING_ISSUE_PCT = 10
GAP_ISSUE_DAYS = 30
RANGE_ISSUE_PCT = 1


def _long_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """(column, n, total) of rows meeting a condition per column, in one pass."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(cond).alias(name) for name, cond in conditions.items()],
    )
    return wide.unpivot(["_total"], list(conditions), "column", "n").withColumnRenamed(
        "_total", "total"
    )


def _percent(part: str, whole: str, digits: int) -> Column:
    return F.bround(F.col(part) / F.when(F.col(whole) > 0, F.col(whole)) * 100, digits)


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with NULLs: count and percent (2 digits)."""
    counts = _long_counts(df, {c: F.col(c).isNull() for c in df.columns})
    return counts.filter("n > 0").select(
        "column", F.col("n").alias("missing_count"), _percent("n", "total", 2).alias("missing_pct")
    )


def date_gaps(df: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """Places with days missing between their first and last date."""
    days = F.datediff(F.max("date"), F.min("date")) + 1
    return (
        df.select(*place, "date")
        .distinct()
        .groupBy(*place)
        .agg((days - F.count("date")).cast("bigint").alias("missing_dates"))
        .filter("missing_dates > 0")
    )


def missing_dates(df: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """The missing days themselves: place, date."""
    present = df.select(*place, "date").distinct()
    spans = present.groupBy(*place).agg(F.sequence(F.min("date"), F.max("date")).alias("_days"))
    return spans.select(*place, F.explode("_days").alias("date")).join(
        present, [*place, "date"], "left_anti"
    )


def out_of_range(df: DataFrame, ranges: Mapping[str, tuple] = VALID_RANGES) -> DataFrame:
    """Columns with values outside their limits: count and percent of all rows."""
    present = {c: r for c, r in ranges.items() if c in df.columns}
    counts = _long_counts(
        df, {c: (F.col(c) < low) | (F.col(c) > high) for c, (low, high) in present.items()}
    )
    return counts.filter("n > 0").select(
        "column",
        F.col("n").alias("outside_count"),
        (F.col("n") / F.when(F.col("total") > 0, F.col("total")) * 100).alias("outside_pct"),
    )


def coverage(
    df: DataFrame, expected_places: int | None = None, place: Sequence[str] = PLACE
) -> DataFrame:
    """Places, rows per place, and the share of the expected places."""
    per_place = df.groupBy(*place).agg(F.count(F.lit(1)).alias("n"))
    return _coverage(per_place, expected_places)


def _coverage(per_place: DataFrame, expected_places: int | None) -> DataFrame:
    columns = [
        F.count(F.lit(1)).alias("total_places"),
        F.min("n").alias("min_records"),
        F.max("n").alias("max_records"),
        F.bround(F.avg("n"), 1).alias("mean_records"),
    ]
    if expected_places:
        share = F.bround(F.count(F.lit(1)) / expected_places * 100, 1)
        columns += [
            F.lit(expected_places).cast("bigint").alias("expected_places"),
            share.alias("coverage_pct"),
        ]
    return per_place.agg(*columns)


def report(
    df: DataFrame, expected_places: int | None = None, place: Sequence[str] = PLACE
) -> DataFrame:
    """All checks as one long table: check, subject, value, is_issue.

    The input is read twice: once for the counts per column, once for the rows
    and days per place, which are stored.
    """
    ranges = {c: r for c, r in VALID_RANGES.items() if c in df.columns}
    outside = lambda c: (F.col(c) < ranges[c][0]) | (F.col(c) > ranges[c][1])
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing {c}") for c in df.columns],
        *[F.count_if(outside(c)).alias(f"outside {c}") for c in ranges],
    )

    def cell(check: str, c: str, n: Column, value: Column, issue: Column) -> Column:
        entry = F.struct(
            F.lit(check).alias("check"),
            F.lit(c).alias("subject"),
            value.alias("value"),
            issue.alias("is_issue"),
        )
        return F.when(n > 0, entry)

    cells = []
    for c in df.columns:
        n = F.col(f"`missing {c}`")
        pct = F.bround(n / F.col("_total") * 100, 2)
        cells.append(cell("missing_values", c, n, pct, pct > MISSING_ISSUE_PCT))
    for c in ranges:
        n = F.col(f"`outside {c}`")
        pct = n / F.col("_total") * 100
        cells.append(cell("value_ranges", c, n, n.cast("double"), pct > RANGE_ISSUE_PCT))
    columns = counts.select(F.inline(F.array_compact(F.array(*cells))))

    days = F.datediff(F.max("date"), F.min("date")) + 1
    per_place = materialize(
        df.groupBy(*place).agg(
            F.count(F.lit(1)).alias("n"),
            (days - F.count_distinct("date")).cast("bigint").alias("gaps"),
        )
    )
    spot = F.concat_ws(",", *[F.col(c).cast("string") for c in place])
    gaps = per_place.filter("gaps > 0").select(
        F.lit("date_continuity").alias("check"),
        spot.alias("subject"),
        F.col("gaps").cast("double").alias("value"),
        (F.col("gaps") > GAP_ISSUE_DAYS).alias("is_issue"),
    )
    covered = _coverage(per_place, expected_places)
    places = (
        covered.select(*[F.col(c).cast("double").alias(c) for c in covered.columns])
        .unpivot([], covered.columns, "subject", "value")
        .select(
            F.lit("coverage").alias("check"), "subject", "value", F.lit(False).alias("is_issue")
        )
    )
    return reduce(DataFrame.unionByName, [columns, gaps, places])
