"""Exact quantiles that never gather a whole column in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridclime.functions.lineage import materialize

#: Parts of equal width that a bracket is ranked in.
PARTS = 256


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """Linearly interpolated quantiles, NULLs ignored, one row per group.

    Each column becomes ``array<double>`` in the order of ``probs``. The values
    equal ``percentile(column, p)``, but that aggregate keeps every distinct
    value of a group in one buffer. Here a sketch first brackets each quantile;
    values below a bracket are only counted, on the map side, values above are
    left out, and those inside, about ``8 / accuracy`` of a group, are ranked in
    ``PARTS`` parts, so that a task sorts a part of a bracket. The bracket of a
    group of up to ``accuracy`` values is all of them.

    Reads ``df`` twice (three times with ``by``): materialize it first if it is costly.
    """
    by, probs = list(by), [float(p) for p in probs]
    if not columns or not probs:
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).select(*by)
    slack = 4.0 / accuracy
    edges = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    names = [f"_v{i}" for i in range(len(columns))]

    values = df.select(*by, *[F.col(c).cast("double").alias(v) for c, v in zip(columns, names)])
    sketch = values.groupBy(*by).agg(
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(names)],
        *[F.percentile_approx(v, edges, accuracy).alias(f"e{i}") for i, v in enumerate(names)],
    )
    # Counts of the whole table are few; they are stored, so that the table is compared with the brackets once.
    counted = _counted_by(values, sketch, by, names, probs, accuracy) if by else materialize(_counted(values, sketch, names, probs, accuracy))

    cell = [*by, "i", "j"]
    parts = counted.groupBy(*cell, "part").agg(F.sum("m").alias("in_part"))
    earlier = Window.partitionBy(*cell).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*cell, "part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("before"))
    prob = F.array(*[F.lit(p) for p in probs])[F.col("j")]
    upto = Window.partitionBy(*cell, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.join(parts, [*cell, "part"]).select(
        *cell, "part", "v", (F.col("before") + F.sum("m").over(upto)).alias("upto"), (prob * (F.col("n") - 1)).alias("at")
    )
    lower, upper = F.col("upto") > F.floor("at"), F.col("upto") > F.ceil("at")
    found = ranked.groupBy(*cell).agg(
        F.min(F.when(lower, F.col("v"))).alias("x"),
        F.min(F.when(upper, F.col("v"))).alias("y"),
        F.min(F.when(lower, F.col("part"))).alias("part"),
        F.max("at").alias("at"),
    )
    # A rank outside its bracket would give a wrong value: stop instead.
    missed = (F.col("part") < 0) | F.col("y").isNull()
    q = F.col("x") + (F.col("y") - F.col("x")) * (F.col("at") - F.floor("at"))
    q = F.when(missed, F.raise_error(F.lit("quantile bracket missed"))).otherwise(q)
    slot = F.col("i") * len(probs) + F.col("j")
    answers = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(slot, q))).alias("m"))
    slots = F.sequence(F.lit(0), F.lit(len(columns) * len(probs) - 1))
    flat = answers.select(*by, F.transform(slots, lambda s: F.try_element_at("m", s)).alias("_flat"))
    return flat.select(
        *by, *[F.slice("_flat", k * len(probs) + 1, len(probs)).alias(c) for k, c in enumerate(columns)]
    )


def _counted(values: DataFrame, sketch: DataFrame, names: list[str], probs: list[float], accuracy: int) -> DataFrame:
    """(i, j, part, v, m, n): how often each value inside a bracket occurs, and as part -1 how many lie below it.

    The brackets, two numbers per column and quantile, pass through the driver.
    Columns are compared with them a batch at a time, and only values inside one
    become rows. NaN is greater than any number and lies in a bracket without end.
    """
    row = sketch.first()
    brackets = []
    for i in range(len(names)):
        n = row[f"n{i}"]
        for j in range(len(probs) if n else 0):
            ends = (-np.inf, np.inf) if n <= accuracy else (row[f"e{i}"][j], row[f"e{i}"][j + len(probs)])
            brackets.append((i, j, n, *ends))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lesser = np.zeros(len(brackets), dtype=np.int64)
        kinds = ("i", np.int32), ("j", np.int32), ("part", np.int32), ("v", np.float64), ("m", np.int64), ("n", np.int64)

        def rows(parts: list[tuple]) -> pa.RecordBatch:
            columns = [np.concatenate([np.atleast_1d(p[k]) for p in parts] or [np.zeros(0)]).astype(kind) for k, (_, kind) in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[name for name, _ in kinds])

        for batch in batches:
            known = [c.drop_null().to_numpy() for c in batch.columns]
            parts = []
            for b, (i, j, n, low, high) in enumerate(brackets):
                v = known[i]
                whole = np.isinf(low) and np.isinf(high)
                found, m = np.unique(v if whole else v[(v >= low) & (v <= high)], return_counts=True)
                lesser[b] += 0 if whole else np.count_nonzero(v < low)
                part = np.zeros(len(found)) if whole or high <= low else np.floor((found - low) / (high - low) * PARTS)
                parts.append((np.full(len(found), i), np.full(len(found), j), part, found, m, np.full(len(found), n)))
            yield rows(parts)
        yield rows([(i, j, -1, -np.inf, m, n) for (i, j, n, _, _), m in zip(brackets, lesser.tolist(), strict=True) if m])

    found = values.mapInArrow(count, "i int, j int, part int, v double, m long, n long")
    return found.groupBy("i", "j", "part", "v").agg(F.sum("m").alias("m"), F.max("n").alias("n"))


def _counted_by(values: DataFrame, sketch: DataFrame, by: list[str], names: list[str], probs: list[float], accuracy: int) -> DataFrame:
    """The same per group, whose brackets are joined to the rows."""
    below, above = F.lit(float("-inf")), F.lit(float("inf"))

    def bracket(i: int):
        few, found = F.col(f"n{i}") <= accuracy, F.col(f"e{i}")
        low = [F.when(few, below).otherwise(found[j]) for j in range(len(probs))]
        high = [F.when(few, above).otherwise(found[j + len(probs)]) for j in range(len(probs))]
        return F.struct(F.col(f"n{i}").alias("n"), F.array(*low).alias("low"), F.array(*high).alias("high"))

    bounds = sketch.select(*by, F.array(*[bracket(i) for i in range(len(names))]).alias("_b"))
    packed = values.select(*by, F.array(*names).alias("_values"))
    bracketed = packed.join(bounds, on=by).select(*by, "_b", F.posexplode("_values").alias("i", "v")).filter("v IS NOT NULL")
    bracketed = bracketed.withColumn("_e", F.col("_b")[F.col("i")]).drop("_b")

    # NaN is greater than any number and lies in a bracket that has no end.
    def placed(j: int):
        low, high = F.col("_e.low")[j], F.col("_e.high")[j]
        inside = (low == below) | F.col("v").between(low, high)
        return F.when(inside, F.col("v")).when(F.col("v") < low, below)

    cells = bracketed.select(*by, "i", "_e", F.posexplode(F.array(*[placed(j) for j in range(len(probs))])).alias("j", "v"))
    low, high = F.col("_e.low")[F.col("j")], F.col("_e.high")[F.col("j")]
    part = (
        F.when((low != below) & (F.col("v") == below), -1)
        .when((low == below) | (high <= low), 0)
        .otherwise(F.floor((F.col("v") - low) / (high - low) * PARTS))
    )
    return cells.filter("v IS NOT NULL").groupBy(*by, "i", "j", part.cast("int").alias("part"), "v").agg(
        F.count(F.lit(1)).alias("m"), F.max("_e.n").alias("n")
    )
