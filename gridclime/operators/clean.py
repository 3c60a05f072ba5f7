"""Cleaning of daily tables: duplicates, gaps, outliers, physical limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclime.functions import days
from gridclime.functions.columns import clip, numeric_columns
from gridclime.functions.lineage import materialize
from gridclime.functions.quantiles import quantiles
from gridclime.registry import CLIP_RANGES, DAILY_KEY, PLACE, UNCAPPED_COLUMNS

MAX_GAP = 7
IQR_FACTOR = 3.0
NULL_THRESHOLD = 0.5


def drop_duplicates(
    df: DataFrame, order_by: Sequence[str] = (), key: Sequence[str] = DAILY_KEY
) -> DataFrame:
    """Keep the first row of every key by ``order_by`` (a hash of the row if not given).

    Spark limits each group to its first row before the shuffle as well, so a
    heavily repeated key does not arrive whole in one task.
    """
    rest = [c for c in df.columns if c not in key]
    order = [F.asc_nulls_last(c) for c in order_by] or [F.xxhash64(*rest)] if rest else [*key]
    first = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def null_counts(df: DataFrame) -> DataFrame:
    """One row: total rows and NULLs per column."""
    return df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )


def null_shares(df: DataFrame) -> DataFrame:
    """(column, null_share), one row each."""
    counts = null_counts(df).unpivot(["_total"], df.columns, "column", "_nulls")
    return counts.select(
        "column", (F.col("_nulls") / F.when(F.col("_total") > 0, F.col("_total"))).alias("null_share")
    )


def drop_sparse_columns(
    df: DataFrame,
    threshold: float = NULL_THRESHOLD,
    scope: str = "table",
    key: Sequence[str] = DAILY_KEY,
    place: Sequence[str] = PLACE,
) -> DataFrame:
    """Drop columns with a larger NULL share, never the key.

    With ``scope='place'`` the column is emptied for the places concerned.
    """
    candidates = [c for c in df.columns if c not in key]
    if scope == "place":
        whole = Window.partitionBy(*place)
        share = lambda c: F.avg(F.col(c).isNull().cast("int")).over(whole)
        return df.withColumns({c: F.when(share(c) <= threshold, F.col(c)) for c in candidates})
    nulls = null_counts(df).first()
    return df.drop(*[c for c in candidates if nulls[c] > threshold * nulls["_total"]])


def interpolate(
    df: DataFrame, columns: Sequence[str], limit: int = MAX_GAP, place: Sequence[str] = PLACE
) -> DataFrame:
    """Linear by row position within a place, at most ``limit`` rows from either side.

    Ends are extended flat. Days are unique per place here, so a place is as long
    as the calendar, however large the table.
    """
    return days.by_place(df, columns, [days.lines(limit)], place)


def fill_month_median(
    df: DataFrame, columns: Sequence[str], place: Sequence[str] = PLACE
) -> DataFrame:
    """NULLs become the median of the place and calendar month."""
    return days.by_place(df, columns, [days.medians(by_month=True)], place)


def fill_median(
    df: DataFrame, columns: Sequence[str], scope: str = "table", place: Sequence[str] = PLACE
) -> DataFrame:
    """Remaining NULLs become the column's median over the table, or over the place."""
    if not columns:
        return df
    if scope == "place":
        return days.by_place(df, columns, [days.medians()], place)
    medians = quantiles(df, columns, [0.5]).first()
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c][0])) for c in columns})


def cap_columns(df: DataFrame) -> list[str]:
    return numeric_columns(df, exclude=UNCAPPED_COLUMNS)


Limits = dict[str, tuple[Column, Column]]


def _limits(first: Column, second: Column, method: str, factor: float) -> tuple[Column, Column]:
    """(lo, hi) from quartiles, or from mean and deviation; NULL where nothing is capped."""
    if method == "iqr":
        spread = factor * (second - first)
        return first - spread, second + spread
    spread = F.when(second > 0, factor * second)
    return first - spread, first + spread


def _with_limits(
    df: DataFrame,
    columns: Sequence[str],
    method: str,
    factor: float,
    scope: str,
    place: Sequence[str],
) -> tuple[DataFrame, Limits]:
    """Rows and the limits of each column.

    Limits of the whole table are two numbers per column, computed here and put
    into the plan, so later steps do not compute them again.
    """
    pair = lambda c: (F.avg(c), F.stddev_samp(c))
    if scope == "table":
        if method == "iqr":
            row = quantiles(df, columns, [0.25, 0.75]).first()
        else:
            row = df.agg(*[F.array(*pair(c)).alias(c) for c in columns]).first()
        found = {c: [F.lit(v).cast("double") for v in row[c]] for c in columns}
        return df, {c: _limits(*found[c], method, factor) for c in columns}
    whole = Window.partitionBy(*place)
    if method == "iqr":
        quarters = F.array(F.lit(0.25), F.lit(0.75))
        stats = {f"_s_{c}": F.percentile(c, quarters).over(whole) for c in columns}
    else:
        stats = {f"_s_{c}": F.array(*[f.over(whole) for f in pair(c)]) for c in columns}
    out = df.withColumns(stats)
    found = {c: (F.col(f"_s_{c}")[0], F.col(f"_s_{c}")[1]) for c in columns}
    return out, {c: _limits(*found[c], method, factor) for c in columns}


def cap_outliers(
    df: DataFrame,
    method: str = "iqr",
    factor: float = IQR_FACTOR,
    scope: str = "table",
    columns: Sequence[str] | None = None,
    place: Sequence[str] = PLACE,
) -> DataFrame:
    """Clip to quartiles ± factor·IQR, to mean ± factor·std, or not at all (``physical``).

    A column whose quartiles are equal is flattened to that value.
    """
    if method not in ("iqr", "zscore", "physical"):
        raise ValueError(f"unknown outlier method {method!r}")
    columns = cap_columns(df) if columns is None else list(columns)
    if method == "physical" or not columns:
        return df
    if scope == "place" and method == "iqr":
        return days.by_place(df, columns, [days.caps(columns, factor)], place)
    out, limits = _with_limits(df, columns, method, factor, scope, place)
    return out.withColumns({c: clip(F.col(c), *limits[c]) for c in columns}).select(*df.columns)


def capped_counts(
    df: DataFrame, method: str = "iqr", factor: float = IQR_FACTOR, scope: str = "table"
) -> DataFrame:
    """(column, capped): values that ``cap_outliers`` would change."""
    columns = cap_columns(df)
    out, limits = _with_limits(df, columns, method, factor, scope, PLACE)
    beyond = lambda c: (F.col(c) < limits[c][0]) | (F.col(c) > limits[c][1])
    wide = out.agg(*[F.count_if(beyond(c)).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "capped")


def clip_physical(df: DataFrame, ranges: Mapping[str, tuple] = CLIP_RANGES) -> DataFrame:
    return df.withColumns(
        {c: clip(F.col(c), low, high) for c, (low, high) in ranges.items() if c in df.columns}
    )


def clipped_counts(df: DataFrame, ranges: Mapping[str, tuple] = CLIP_RANGES) -> DataFrame:
    """(column, clipped): values that ``clip_physical`` would change."""
    present = {c: r for c, r in ranges.items() if c in df.columns}
    wide = df.agg(
        *[
            F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(c)
            for c, (low, high) in present.items()
        ]
    )
    return wide.unpivot([], list(present), "column", "clipped")


def summary(df: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """One row: rows, columns, numeric columns, NULL cells and their percent, places."""
    width = len(df.columns)
    nulls = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    cells = F.count(F.lit(1)) * width
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(width).cast("bigint").alias("columns"),
        F.lit(len(numeric_columns(df))).cast("bigint").alias("numeric_columns"),
        nulls.cast("bigint").alias("null_values"),
        F.bround(nulls / F.when(cells > 0, cells) * 100, 2).alias("null_pct"),
        F.count_distinct(F.struct(*place)).alias("places"),
    )


def place_fills(limit: int = MAX_GAP) -> list[days.Step]:
    """What ``interpolate``, ``fill_month_median`` and ``fill_median`` of a place do to one place."""
    return [days.lines(limit), days.medians(by_month=True), days.medians()]


def fill_missing(
    df: DataFrame,
    scope: str = "table",
    place: Sequence[str] = PLACE,
    gaps: Sequence[str] | None = None,
) -> DataFrame:
    """All three fills, each only for columns that still hold NULLs.

    ``gaps`` names the columns with NULLs, if they are known already.
    """
    if gaps is None:
        numbers = numeric_columns(df, exclude=place)
        nulls = null_counts(df.select(*numbers)).first()
        gaps = [c for c in numbers if nulls[c] > 0]
    if not gaps:
        return df
    if scope == "place":
        return days.by_place(df, gaps, place_fills(), place)
    filled = materialize(days.by_place(df, gaps, place_fills()[:2], place))
    left = null_counts(filled.select(*gaps)).first()
    return fill_median(filled, [c for c in gaps if left[c] > 0], scope, place)


def clean(
    df: DataFrame,
    method: str = "iqr",
    factor: float = IQR_FACTOR,
    null_threshold: float = NULL_THRESHOLD,
    scope: str = "table",
    order_by: Sequence[str] = (),
    ranges: Mapping[str, tuple] = CLIP_RANGES,
    key: Sequence[str] = DAILY_KEY,
    place: Sequence[str] = PLACE,
) -> DataFrame:
    """Duplicates, sparse columns, gaps, outliers, physical limits, in that order.

    ``scope`` says whether statistics come from the whole table or from each
    place on its own. The rows are stored twice, without duplicates and without
    gaps, because what follows reads them several times; with ``scope='place'``
    gaps and outliers of a place are handled at once, in the task that has it.
    """
    unique = materialize(drop_duplicates(df, order_by, key))
    nulls = null_counts(unique).first()
    dense, gaps = _dense(unique, nulls, null_threshold, scope, key, place)
    if scope == "place" and method == "iqr":
        capping = cap_columns(dense)
        columns = [*gaps, *[c for c in capping if c not in gaps]]
        capped = days.by_place(dense, columns, [*place_fills(), days.caps(capping, factor)], place)
    else:
        filled = fill_missing(dense, scope, place, gaps)
        capped = cap_outliers(filled, method, factor, scope, place=place)
    return clip_physical(capped, ranges)


def _dense(unique, nulls, null_threshold, scope, key, place) -> tuple[DataFrame, list[str]]:
    """Rows without sparse columns, and the columns left that have gaps."""
    values = [c for c in unique.columns if c not in key]
    if scope == "place":
        dense = drop_sparse_columns(unique, null_threshold, scope, key, place)
    else:
        dense = unique.drop(*[c for c in values if nulls[c] > null_threshold * nulls["_total"]])
    return dense, [c for c in numeric_columns(dense, exclude=key) if nulls[c] > 0]


def report(
    df: DataFrame,
    null_threshold: float = NULL_THRESHOLD,
    order_by: Sequence[str] = (),
    key: Sequence[str] = DAILY_KEY,
    place: Sequence[str] = PLACE,
) -> DataFrame:
    """(step, subject, n): what cleaning over the whole table removes and fills.

    ``removed_rows`` counts repeated keys, ``removed_column`` the NULLs of a
    sparse column, ``filled`` the values put into a column's gaps. Values that
    limits change are in ``capped_counts`` and ``clipped_counts``.
    """
    unique = materialize(drop_duplicates(df, order_by, key))
    nulls = null_counts(unique).first()
    dense, gaps = _dense(unique, nulls, null_threshold, "table", key, place)
    filled = fill_missing(dense, "table", place, gaps)
    left = null_counts(filled.select(*gaps)).first() if gaps else {}
    rows = [("removed_rows", "rows", df.count() - nulls["_total"])]
    rows += [("removed_column", c, nulls[c]) for c in unique.columns if c not in dense.columns]
    rows += [("filled", c, nulls[c] - left[c]) for c in gaps]
    return df.sparkSession.createDataFrame(rows, "step string, subject string, n long")
