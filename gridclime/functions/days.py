"""Steps over the days of one place, all columns in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column -> its values in order of date, and which of them are known (not NULL).
Days = dict[str, tuple[np.ndarray, np.ndarray]]
Step = Callable[[Days, np.ndarray], None]


def by_place(df: DataFrame, columns: Sequence[str], steps: Sequence[Step], place: Sequence[str]) -> DataFrame:
    """Rows whose ``columns``, now doubles, went through the steps, one place at a time.

    A step gets the columns of a place in order of date and the calendar month of
    every row (0 without a date), and replaces what it changes. Meant for rows
    that are unique by place and day: a place is as long as the calendar.
    """
    wanted, columns = set(columns), list(columns)
    if not columns:
        return df
    kinds = {f.name: T.DoubleType() if f.name in wanted else f.dataType for f in df.schema.fields}
    rows = df.withColumns({c: F.col(c).cast("double") for c in columns})
    dated = "date" in df.columns
    rows = rows.withColumn("_month", F.coalesce(F.month("date") if dated else F.lit(0), F.lit(0)).cast("int"))

    def work(table: pa.Table) -> pa.Table:
        if dated:
            table = table.take(pc.sort_indices(table["date"], null_placement="at_start"))
        table = table.combine_chunks()
        found = {}
        for c in columns:
            column = table[c]
            values = column.to_numpy()
            known = np.ones(len(values), bool) if not column.null_count else column.is_valid().to_numpy()
            found[c] = values, known
        month = table["_month"].to_numpy()
        with np.errstate(all="ignore"):
            for step in steps:
                step(found, month)
        cells = [pa.array(found[c][0], mask=~found[c][1]) if c in wanted else table[c] for c in kinds]
        return pa.Table.from_arrays(cells, names=list(kinds))

    schema = T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])
    return rows.groupBy(*place).applyInArrow(work, schema)


def ranked(values: np.ndarray, probs: Sequence[float]) -> list[float]:
    """Interpolated as by Spark's ``percentile``, of one value at least; NaN is greater than any number."""
    ordered, found = np.sort(values), []
    for p in probs:
        at = p * (len(ordered) - 1)
        low, high = int(np.floor(at)), int(np.ceil(at))
        x, y = ordered[low], ordered[high]
        found.append(x if low == high or x == y else (high - at) * x + (at - low) * y)
    return found


def _put(found: Days, column: str, at: np.ndarray, values) -> None:
    old, known = found[column]
    new, seen = old.copy(), known.copy()
    new[at], seen[at] = values, True
    found[column] = new, seen


def lines(limit: int) -> Step:
    """Gaps become the line between their ends, at most ``limit`` rows from either; outer ones the nearest value."""

    def step(found: Days, month: np.ndarray) -> None:
        for c, (v, known) in found.items():
            if known.all() or not known.any():
                continue
            n, at = len(v), np.arange(len(v))
            left = np.maximum.accumulate(np.where(known, at, -1))[~known]
            right = np.minimum.accumulate(np.where(known, at, n)[::-1])[::-1][~known]
            at = at[~known]
            before, after = v[np.maximum(left, 0)], v[np.minimum(right, n - 1)]
            near_left = (left >= 0) & (at - left <= limit)
            near_right = (right < n) & (right - at <= limit)
            line = before + (after - before) * (at - left) / (right - left)
            value = np.where((left >= 0) & (right < n), line, np.where(left >= 0, before, after))
            near = near_left | near_right
            _put(found, c, at[near], value[near])

    return step


def medians(by_month: bool = False) -> Step:
    """NULLs become the median of the place, or of its calendar month."""

    def step(found: Days, month: np.ndarray) -> None:
        for c, (v, known) in found.items():
            if known.all() or not known.any():
                continue
            for m in np.unique(month[~known]) if by_month else [None]:
                inside = np.ones(len(v), bool) if m is None else month == m
                if (inside & known).any():
                    _put(found, c, inside & ~known, ranked(v[inside & known], [0.5])[0])

    return step


def caps(columns: Sequence[str], factor: float) -> Step:
    """Known values are limited to the quartiles ± factor·IQR."""

    def step(found: Days, month: np.ndarray) -> None:
        for c in columns:
            v, known = found[c]
            if known.any():
                first, third = ranked(v[known], [0.25, 0.75])
                spread = factor * (third - first)
                # NaN is greater than any number, as it is to greatest and least.
                found[c] = np.fmin(np.maximum(v, first - spread), third + spread), known

    return step
