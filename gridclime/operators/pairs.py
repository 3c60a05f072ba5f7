"""Distances between many points, block against block.

Points (``pid``, ``x``, ``w``, group ``g``) are cut into blocks of bounded size by
several coordinates in turn; the cells of the cuts are a table with their
bounding boxes, and block pairs that can matter are found by joins down that
table. A pair of blocks is one small numpy computation that returns aggregates
per point, so pairs of points are never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridclime.functions.lineage import materialize

BLOCK_ROWS = 2048
#: Where every block meets every other, larger blocks are sent less often; tasks meet them a tile at a time.
ALL_ROWS = 16_384
TILE = 1024
#: Up to so many coordinates, distances are summed one by one.
FLAT = 8
#: If more others than this times those wanted are within a row's radius, the nearest are picked before distances are summed.
CROWD = 8
#: Up to ``FLAT`` coordinates, rows of a block meet others in cells of at most so many rows.
CELL = 128
#: And a block meets at most about so many rows at once.
MET_ROWS = 65_536
#: Parts that a cell is cut into at once.
FAN = 16
#: Bounds are widened by this share, so that rounding never hides a point.
SLACK = 1 + 1e-9


@dataclass(frozen=True)
class Blocks:
    """Points with their ``block``, and the cells that lead to the blocks; both stored.

    ``margin`` of a point is its distance to the nearest cut around its block.
    ``cells``: cell, g, parent (NULL for the root of a group), leaf, n, lo, hi, and
    for those that were cut dim and cuts. ``depth`` counts the rounds of cuts.
    """

    points: DataFrame
    cells: DataFrame
    depth: int


def distinct_points(df: DataFrame, x: str = "x", by: Sequence[str] = ()) -> DataFrame:
    """One row per vector (and labels), with its weight in rows and a number of its own; stored.

    Copies of a vector share every distance, so a group of copies of any size
    is one point from here on.
    """
    weighed = df.groupBy(F.col(x).alias("x"), *by).agg(F.count(F.lit(1)).alias("w"))
    return materialize(weighed.withColumn("pid", F.monotonically_increasing_id()))


def _boxes(placed: DataFrame, size: int) -> DataFrame:
    """(cell, g, parent, n, lo, hi) of the points' present cells."""
    ends = lambda f: F.array(*[f(F.col("x")[i]) for i in range(size)]).cast("array<double>")
    return placed.groupBy(F.col("block").alias("cell"), "g", "parent").agg(
        F.count(F.lit(1)).alias("n"), ends(F.min).alias("lo"), ends(F.max).alias("hi")
    )


def _cuts(placed: DataFrame, crowded: DataFrame, block_rows: int) -> DataFrame:
    """Crowded cells with ``dim``, their widest coordinate, and ``cuts`` of it into even parts."""
    wide = F.zip_with("hi", "lo", lambda h, l: h - l)
    crowded = crowded.withColumn("dim", F.array_position(wide, F.array_max(wide)).cast("int") - 1)
    value = F.col("x")[F.col("dim")]
    shares = [i / FAN for i in range(1, FAN)]
    found = (
        placed.join(crowded.select(F.col("cell").alias("block"), "dim"), "block")
        .groupBy("block")
        .agg(F.percentile_approx(value, shares, 1000).alias("q"))
        .withColumnRenamed("block", "cell")
    )
    parts = F.least(F.lit(FAN), F.ceil(F.col("n") / block_rows)).cast("int")
    every = F.transform(F.sequence(F.lit(1), parts - 1), lambda i: F.col("q")[F.ceil(i * FAN / parts).cast("int") - 1])
    low, high = (F.col(c)[F.col("dim")] for c in ("lo", "hi"))
    # A cut at the largest value would cut nothing off; the middle always does.
    kept = F.array_distinct(F.filter(every, lambda c: c < high))
    cuts = F.when(F.size(kept) > 0, kept).otherwise(F.array(low + (high - low) / 2))
    return crowded.join(found, "cell").withColumn("cuts", cuts).drop("q")


def _child(cuts: Column, value: Column) -> Column:
    return F.size(F.filter(cuts, lambda c: c < value))


def blocked(points: DataFrame, block_rows: int = BLOCK_ROWS) -> Blocks:
    """Points (pid, x, w and a group ``g``, one group if there is none) in blocks of at most ``block_rows``."""
    if "g" not in points.columns:
        points = points.withColumn("g", F.lit(0))
    first = points.select(F.size("x").alias("n")).first()
    size = first["n"] if first else 0
    root = F.concat(F.lit("g"), F.coalesce(F.col("g").cast("string"), F.lit("")))
    start = {"block": root, "parent": F.lit(None).cast("string"), "margin": F.lit(float("inf"))}
    live = materialize(points.withColumns(start))
    done, tables, depth = [], [], 0
    while True:
        boxes = materialize(_boxes(live, size))
        # Points of one cell that all lie on one spot cannot be cut; distinct points never do.
        crowded = F.col("n") > block_rows
        if boxes.filter(crowded).isEmpty():
            tables.append(boxes.withColumns({"leaf": F.lit(True), "dim": F.lit(None).cast("int"), "cuts": F.lit(None).cast("array<double>")}))
            done.append(live)
            break
        cut = materialize(_cuts(live, boxes.filter(crowded), block_rows))
        whole = boxes.filter(~crowded)
        tables.append(cut.withColumn("leaf", F.lit(False)).select(*boxes.columns, "leaf", "dim", "cuts"))
        tables.append(whole.withColumns({"leaf": F.lit(True), "dim": F.lit(None).cast("int"), "cuts": F.lit(None).cast("array<double>")}))
        done.append(live.join(whole.select(F.col("cell").alias("block")), "block").select(*live.columns))
        live = materialize(_down(live.join(cut.select(F.col("cell").alias("block"), "dim", "cuts"), "block")).select(*live.columns))
        depth += 1
    return Blocks(_union([d.drop("parent") for d in done]), materialize(_union(tables)), depth)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _down(rows: DataFrame) -> DataFrame:
    """Rows one cut deeper: ``block`` is the child's, ``parent`` the one before."""
    value = F.col("x")[F.col("dim")]
    gaps = F.transform("cuts", lambda c: F.abs(value - c))
    return rows.withColumns(
        {
            "margin": F.least("margin", F.array_min(gaps)),
            "parent": F.col("block"),
            "block": F.concat_ws("/", "block", _child(F.col("cuts"), value)),
        }
    )


def placed_in(points: DataFrame, blocks: Blocks, block_rows: int = BLOCK_ROWS) -> Blocks:
    """Other points, by the cuts of ``blocks``, as leaves of their own; crowded ones are split by number."""
    root = F.concat(F.lit("g"), F.coalesce(F.col("g").cast("string"), F.lit("")))
    first = points.select(F.size("x").alias("n")).first()
    size = first["n"] if first else 0
    rows = points.withColumn("home", root)
    for _ in range(blocks.depth):
        cut = blocks.cells.filter("NOT leaf").select(F.col("cell").alias("home"), "dim", "cuts")
        child = F.concat_ws("/", "home", _child(F.col("cuts"), F.col("x")[F.col("dim")]))
        rows = rows.join(cut, "home", "left").withColumn("home", F.when(F.col("cuts").isNull(), F.col("home")).otherwise(child)).drop("dim", "cuts")
    rows = materialize(rows)
    sizes = rows.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts"))
    split = rows.join(sizes, "home").withColumn("block", F.concat_ws("#", "home", F.pmod(F.xxhash64("pid"), F.col("parts")))).drop("parts")
    split = materialize(split.withColumn("parent", F.lit(None).cast("string")))
    cells = _boxes(split, size).withColumns({"leaf": F.lit(True), "dim": F.lit(None).cast("int"), "cuts": F.lit(None).cast("array<double>")})
    return Blocks(split.drop("parent"), materialize(cells), 0)


def _gap(lo1: str, hi1: str, lo2: str, hi2: str) -> Column:
    """Distance of two boxes."""
    one = F.zip_with(lo1, hi2, lambda l, h: F.greatest(l - h, F.lit(0.0)))
    two = F.zip_with(lo2, hi1, lambda l, h: F.greatest(l - h, F.lit(0.0)))
    return F.sqrt(F.aggregate(F.zip_with(one, two, lambda u, v: F.greatest(u, v)), F.lit(0.0), lambda t, d: t + d * d))


def block_pairs(asked: DataFrame, blocks: Blocks) -> DataFrame:
    """(a, b): blocks b whose box lies within ``radius`` of the box of ``asked`` (a, g, lo, hi, radius); stored.

    The search goes down the cells, one join on the parent for each round of cuts.
    """
    boxes = blocks.cells.select("g", "parent", F.col("cell").alias("b"), "leaf", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    near = _gap("lo", "hi", "lo2", "hi2") <= F.col("radius") * SLACK
    front = asked.join(boxes.filter("parent IS NULL").drop("parent"), "g").filter(near)
    found = []
    for _ in range(blocks.depth):
        front = materialize(front)
        found.append(front.filter("leaf").select("a", "b"))
        above = front.filter("NOT leaf").select("a", "lo", "hi", "radius", F.col("b").alias("parent"))
        front = above.join(boxes.drop("g").filter("parent IS NOT NULL"), "parent").filter(near)
    found.append(front.filter("leaf").select("a", "b"))
    return materialize(_union(found))


def near_pairs(left: Blocks, right: Blocks, radius: float) -> DataFrame:
    """(a, b): right blocks that may hold points within ``radius`` of points of a left block."""
    boxes = left.cells.filter("leaf").select(F.col("cell").alias("a"), "g", "lo", "hi", F.lit(float(radius)).alias("radius"))
    return block_pairs(boxes, right)


def all_pairs(blocks: Blocks) -> DataFrame:
    """(a, b) for every two blocks, each unordered pair once."""
    return near_pairs(blocks, blocks, float("inf")).filter("a <= b")


def over_pairs(
    left: DataFrame, right: DataFrame, pairs: DataFrame, work: Callable, schema: str
) -> DataFrame:
    """Apply ``work(rows, others, same_block)`` to each pair (a, b) of a left and a right ``block``."""
    one = left.withColumnRenamed("block", "a").join(pairs, "a")
    two = right.withColumnRenamed("block", "b").join(pairs, "b")
    return _met(one, two, work, schema)


def _met(one: DataFrame, two: DataFrame, work: Callable, schema: str) -> DataFrame:
    # Both sides may be one table: fresh columns keep them apart.
    two = two.select(*[F.col(c).alias(c) for c in two.columns])
    names = StructType.fromDDL(schema).names

    def run(key, rows: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or others.empty:
            return pd.DataFrame(columns=names)
        return work(rows, others, key[0] == key[1])

    return one.groupBy("a", "b").cogroup(two.groupBy("a", "b")).applyInPandas(run, schema)


def over_reach(asked: DataFrame, boxes: DataFrame, right: Blocks, others: DataFrame, opened: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``over_pairs`` of the points and boxes of ``by_radius`` with ``others``, points in the blocks of ``right``.

    Up to ``FLAT`` coordinates a block meets all points that reach its box in one
    call, or in a few where there may be many; in more, nearly all do.
    """
    first = right.cells.select(F.size("lo").alias("n")).first()
    if first is None or first["n"] > FLAT:
        return over_pairs(asked, others, opened, work, schema)
    gaps = [F.greatest(F.col("lo2")[i] - F.col("x")[i], F.col("x")[i] - F.col("hi2")[i], F.lit(0.0)) for i in range(first["n"])]
    reaches = F.sqrt(reduce(lambda t, g: t + g, [g * g for g in gaps])) <= F.col("radius") * SLACK
    leaves = right.cells.filter("leaf").select(F.col("cell").alias("b"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    met = opened.join(boxes.select("a", "n"), "a").join(leaves, "b")
    calls = met.groupBy("b").agg(F.ceil(F.sum("n") / MET_ROWS).alias("calls"))
    met = materialize(met.join(calls, "b").withColumn("call", F.pmod(F.xxhash64("a"), "calls")).drop("n", "calls"))
    one = asked.withColumnRenamed("block", "a").join(met, "a").filter(reaches).drop("a", "lo2", "hi2").withColumnRenamed("call", "a")
    two = others.withColumnRenamed("block", "b").join(met.select("b", F.col("call").alias("a")).distinct(), "b")
    return _met(one, two, work, schema)


def by_radius(left: Blocks, reaching: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points of ``left`` with their ``radius`` from ``reaching`` (pid, radius), in blocks of like radius, and the boxes to ask for.

    Points of one block whose radii differ by more than a factor of two are asked
    apart, so a point far from all others opens blocks for itself only. Points
    without a row in ``reaching`` are not asked.
    """
    step = F.when(F.col("radius") <= 0, F.lit("0")).when(F.col("radius") == float("inf"), F.lit("inf")).otherwise(F.floor(F.log2("radius")).cast("string"))
    asked = materialize(left.points.join(reaching, "pid").withColumn("home", F.col("block")).withColumn("block", F.concat_ws("~", "block", step)))
    widest = asked.groupBy(F.col("home").alias("cell"), F.col("block").alias("a")).agg(F.max("radius").alias("radius"), F.count(F.lit(1)).alias("n"))
    boxes = widest.join(left.cells.filter("leaf").select("cell", "g", "lo", "hi"), "cell")
    return asked, boxes.select("a", "cell", "g", "lo", "hi", "radius", "n")


def _cells(at: np.ndarray) -> Iterator[np.ndarray]:
    """Positions of the points, by cells of at most ``CELL``, cut by the widest coordinate."""
    live = [np.arange(len(at))]
    while live:
        cell = live.pop()
        if len(cell) <= CELL:
            yield cell
            continue
        wide = (at[cell].max(axis=0) - at[cell].min(axis=0)).argmax()
        order, half = cell[np.argpartition(at[cell, wide], len(cell) // 2)], len(cell) // 2
        live += [np.sort(order[:half]), np.sort(order[half:])]


def near_cells(at: np.ndarray, to: np.ndarray, reach: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Cells of rows, each with the positions of all others that may be among the k nearest of a row in it and within its reach.

    Ties of the last are among them.
    """
    for cell in _cells(at):
        lo, hi = at[cell].min(axis=0), at[cell].max(axis=0)
        limit = reach[cell].max() * SLACK
        if 0 < k <= len(to):
            # The k others nearest to the middle are no farther from any row than by way of it.
            middle = (lo + hi) / 2
            wide, gap = ((at[cell] - middle) ** 2).sum(axis=1).max(), ((to - middle) ** 2).sum(axis=1)
            limit = min(limit, (np.sqrt(np.partition(gap, k - 1)[k - 1]) + np.sqrt(wide)) * SLACK)
        gap = np.maximum(np.maximum(lo - to, to - hi), 0)
        found = np.flatnonzero((gap * gap).sum(axis=1) <= limit * limit * SLACK)
        if len(found):
            yield cell, found


def cell_pairs(at: np.ndarray, to: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Cells of rows and of others that may lie within reach, and the distance of their boxes, ascending."""
    rows, others = list(_cells(at)), list(_cells(to))
    lo, hi = (np.array([f(at[c], axis=0) for c in rows]) for f in (np.min, np.max))
    lo2, hi2 = (np.array([f(to[c], axis=0) for c in others]) for f in (np.min, np.max))
    gap = np.maximum(np.maximum(lo[:, None] - hi2[None], lo2[None] - hi[:, None]), 0)
    gap = np.sqrt((gap * gap).sum(axis=2))
    limit = np.array([reach[c].max() for c in rows]) * SLACK
    i, j = np.nonzero(gap <= limit[:, None])
    for n in np.argsort(gap[i, j], kind="stable"):
        yield rows[i[n]], others[j[n]], gap[i[n], j[n]]


def within_reach(rows: pd.DataFrame, others: np.ndarray) -> np.ndarray:
    """Which rows have the box of the other points within their own radius."""
    at = matrix(rows)
    gaps = np.maximum(np.maximum(others.min(axis=0) - at, at - others.max(axis=0)), 0)
    return np.sqrt((gaps * gaps).sum(axis=1)) <= rows["radius"].to_numpy() * SLACK


def matrix(rows: pd.DataFrame) -> np.ndarray:
    return np.stack(rows["x"].to_numpy()).astype(float)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed over coordinates without cancellation."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        total += gap * gap
    return np.sqrt(total, out=total)


def squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances by one matrix product, and how far they may be off."""
    middle = b.mean(axis=0)
    a, b = a - middle, b - middle
    one, two = (a * a).sum(axis=1), (b * b).sum(axis=1)
    total = a @ b.T
    total *= -2
    total += one[:, None]
    total += two[None, :]
    return total, 1e-15 * (a.shape[1] + 8) * (one.max() + two.max())


def distances_at(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``distances(a, b)[i, j]``, digit for digit."""
    total = np.zeros(len(i))
    for c in range(a.shape[1]):
        gap = a[i, c] - b[j, c]
        total += gap * gap
    return np.sqrt(total, out=total)


def many_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances to nine digits at least, for sums: those that a matrix product would cancel are summed by coordinate."""
    if a.shape[1] <= FLAT:
        return distances(a, b)
    total, off = squares(a, b)
    i, j = np.nonzero(total <= off * 1e9)
    if len(i) > total.size // 8:
        return distances(a, b)
    total[i, j] = 0
    np.sqrt(total, out=total)
    total[i, j] = distances_at(a, b, i, j)
    return total


def within(a: np.ndarray, b: np.ndarray, radius: float) -> np.ndarray:
    """``distances(a, b) <= radius``; matrix products decide all but what their rounding leaves open."""
    if a.shape[1] <= FLAT:
        return distances(a, b) <= radius
    total, off = squares(a, b)
    off += 1e-15 * radius * radius
    i, j = np.nonzero(np.abs(total - radius * radius) <= off)
    if len(i) > total.size // 8:
        return distances(a, b) <= radius
    near = total <= radius * radius
    near[i, j] = distances_at(a, b, i, j) <= radius
    return near


def block_size(points: DataFrame) -> int:
    """Rows of a block: in many dimensions boxes keep few blocks apart, so blocks are larger there."""
    first = points.select(F.size("x").alias("n")).first()
    return ALL_ROWS if first and first["n"] > FLAT else BLOCK_ROWS


FOUND = "pid long, d double, id long, w long"


def nearest_of(rows: pd.DataFrame, others: pd.DataFrame, k: int) -> pd.DataFrame:
    """(pid, d, id, w): the k nearest others of each row, with all ties of the last distance.

    Rows with a ``radius`` get only those within it. Matrix products propose,
    with a margin for their rounding; distances are then summed by coordinate.
    """
    at, to = matrix(rows), matrix(others)
    ids, weights, pids = others["pid"].to_numpy(), others["w"].to_numpy(), rows["pid"].to_numpy()
    reach = rows["radius"].to_numpy() * SLACK if "radius" in rows else np.full(len(rows), np.inf)
    if at.shape[1] <= FLAT:
        met = near_cells(at, to, reach, k)
    else:
        met = ((np.arange(start, min(start + TILE, len(at))), np.arange(len(to))) for start in range(0, len(at), TILE))
    found = [_nearest_met(at[cell], to[some], reach[cell], k, pids[cell], ids[some], weights[some]) for cell, some in met]
    return pd.concat(found, ignore_index=True) if found else pd.DataFrame(columns=["pid", "d", "id", "w"])


def _nearest_met(at, to, reach, k: int, pids, ids, weights) -> pd.DataFrame:
    take, found = min(k, len(to)), []
    for start in range(0, len(at), TILE):
        part = at[start : start + TILE]
        rough, off = squares(part, to)
        limit = reach[start : start + TILE] ** 2 + off
        if np.count_nonzero(rough <= limit[:, None]) > CROWD * take * len(part):
            limit = np.minimum(limit, np.partition(rough, take - 1, axis=1)[:, take - 1] + 2 * off)
        i, j = np.nonzero(rough <= limit[:, None])
        d = distances_at(part, to, i, j)
        # Ties are kept, so that the order of rows never decides.
        order = np.lexsort((d, i))
        firsts = np.searchsorted(i, np.arange(len(part)))
        counts = np.bincount(i, minlength=len(part))
        some = counts > 0
        last = np.full(len(part), np.inf)
        last[some] = d[order][firsts[some] + np.minimum(counts[some], take) - 1]
        near = d <= np.minimum(last, reach[start : start + TILE])[i]
        i, j = i[near], j[near]
        found.append(pd.DataFrame({"pid": pids[start + i], "d": d[near], "id": ids[j], "w": weights[j]}))
    return pd.concat(found, ignore_index=True)


def neighbours(left: Blocks, right: Blocks, k: int) -> DataFrame:
    """(pid, near): the nearest right points of each left point, as (d, w, id) ascending; stored.

    Exact; as many as needed for a total weight of k, ties by id. Every point
    first gets a bound from the block that it lies in; other blocks are visited
    only by the points whose own bound reaches them. ``left`` is ``right``, or
    was placed by its cuts (``placed_in``).
    """
    def merged(parts: DataFrame) -> DataFrame:
        """Per point the nearest of all parts, cut where the weight reaches k."""
        ranked = parts.groupBy("pid").agg(
            F.array_sort(F.collect_list(F.struct("d", "id", "w"))).alias("near")
        )
        start = F.struct(
            F.lit(0).cast("long").alias("n"),
            F.array().cast("array<struct<d: double, id: long, w: long>>").alias("kept"),
        )
        walked = F.aggregate(
            "near",
            start,
            lambda at, e: F.when(at["n"] >= k, at).otherwise(
                F.struct(
                    (at["n"] + e["w"]).alias("n"),
                    F.array_append(at["kept"], e).alias("kept"),
                )
            ),
            lambda at: at["kept"],
        )
        return materialize(ranked.select("pid", walked.alias("near")))

    def home(cell: Column) -> Column:
        return F.element_at(F.split(cell, "#"), 1)

    leaves = lambda b, name: b.cells.filter("leaf").select(F.col("cell").alias(name), home(F.col("cell")).alias("home"))
    own = materialize(leaves(left, "a").join(leaves(right, "b"), "home").select("a", "b"))
    first = merged(over_pairs(left.points, right.points, own, lambda rows, others, _: nearest_of(rows, others, k), FOUND))
    total = F.aggregate("near", F.lit(0).cast("long"), lambda n, e: n + e["w"])
    bound = F.when(total >= k, F.element_at("near", -1)["d"])
    edge = F.col("margin") if left is right else F.lit(0.0)
    reaching = left.points.select("pid", edge.alias("margin")).join(first.select("pid", bound.alias("radius")), "pid", "left")
    reaching = reaching.select("pid", F.coalesce("radius", F.lit(float("inf"))).alias("radius"), "margin")
    # Points of other blocks lie beyond the margin.
    asked, boxes = by_radius(left, reaching.filter(F.col("margin") <= F.col("radius") * SLACK).drop("margin"))
    opened = block_pairs(boxes, right).join(boxes.select("a", "cell"), "a")
    opened = opened.join(own.select(F.col("a").alias("cell"), "b"), ["cell", "b"], "left_anti").select("a", "b")

    def wider(rows, others, _):
        reached = rows[within_reach(rows, matrix(others))]
        return nearest_of(reached, others, k) if len(reached) else pd.DataFrame(columns=["pid", "d", "id", "w"])

    own_near = first.select("pid", F.inline("near"))
    return merged(own_near.unionByName(over_reach(asked, boxes, right, right.points, materialize(opened), wider, FOUND)))


#: Points of the sample that brackets distances of a high rank, and thresholds of a bracket.
SAMPLE, STEPS = 4096, 16
#: Rows of a block there.
RANK_ROWS = 8192


def _thresholds(points: DataFrame, k: int, sample: int) -> DataFrame:
    """Points with ``steps``, distances around that to their k-th nearest row, from a sample of points; any distances would do."""
    size = points.agg(F.sum("w").alias("n"), F.count(F.lit(1)).alias("spots")).first()
    drawn = points.orderBy(F.xxhash64("x"), "pid").limit(sample).select("x", "w").toPandas()  # at most SAMPLE rows
    to, weights = matrix(drawn), drawn["w"].to_numpy().astype(float)
    share = k / size["n"]
    off = 4 * np.sqrt(share * (1 - share) / len(to)) + 1 / len(to)
    shares = np.linspace(max(share - off, 0), min(share + off, 1), STEPS)

    @F.pandas_udf("array<double>")
    def steps(rows: pd.Series) -> pd.Series:
        found = []
        for start in range(0, len(rows), TILE):
            d = many_distances(np.stack(rows.iloc[start : start + TILE].to_numpy()).astype(float), to)
            order = d.argsort(axis=1)
            d, below = np.take_along_axis(d, order, axis=1), np.cumsum(weights[order], axis=1) / weights.sum()
            at = np.stack([(below < s).sum(axis=1) for s in shares], axis=1)
            found += list(np.take_along_axis(d, np.minimum(at, len(to) - 1), axis=1))
        return pd.Series(found, dtype=object)

    return points.withColumn("steps", steps("x"))


def _within_steps(rows: pd.DataFrame, others: pd.DataFrame, _) -> pd.DataFrame:
    """Weight of the others within each step of each row, but for rounding."""
    at, to, steps, v = matrix(rows), matrix(others), np.stack(rows["steps"].to_numpy()), others["w"].to_numpy().astype(float)
    out = np.zeros(steps.shape)
    for i in range(0, len(at), TILE):
        for j in range(0, len(to), TILE):
            rough, _ = squares(at[i : i + TILE], to[j : j + TILE])
            for n in range(steps.shape[1]):
                out[i : i + TILE, n] += (rough <= (steps[i : i + TILE, n] ** 2)[:, None]) @ v[j : j + TILE]
    return pd.DataFrame({"pid": rows["pid"], **{f"s{n}": out[:, n] for n in range(steps.shape[1])}})


def _between(rows: pd.DataFrame, others: pd.DataFrame, _) -> pd.DataFrame:
    """Weight of the others below ``lo`` of each row, and the distances and weights of those up to ``hi``."""
    at, to, v = matrix(rows), matrix(others), others["w"].to_numpy()
    lo, hi, below, near, weight = rows["lo"].to_numpy(), rows["hi"].to_numpy(), np.zeros(len(at), dtype=np.int64), [], []
    for start in range(0, len(at), TILE):
        part = slice(start, start + TILE)
        rough, off = squares(at[part], to)
        under = rough < ((lo[part] ** 2) * (1 - 1e-15) - off)[:, None]
        below[part] = under @ v
        i, j = np.nonzero(~under & (rough <= (hi[part] ** 2 * SLACK + off)[:, None]))
        d = distances_at(at[part], to, i, j)
        less = d < lo[part][i]
        np.add.at(below, start + i[less], v[j[less]])
        kept = ~less & (d <= hi[part][i])
        i, j, d = i[kept], j[kept], d[kept]
        ends = np.searchsorted(i, np.arange(1, len(at[part])))
        near += np.split(d, ends)
        weight += np.split(v[j], ends)
    return pd.DataFrame({"pid": rows["pid"].to_numpy(), "below": below, "near": near, "weight": weight})


def rank_distances(points: DataFrame, k: int, block_rows: int = RANK_ROWS, sample: int = SAMPLE) -> DataFrame:
    """(pid, d): distance to the k-th nearest row, the row itself counted first, for large k; stored. No row where there are fewer than k.

    Exact, and without lists of k rows: one pass over all pairs of blocks counts the rows within a few steps of
    distance, the next gathers those between the two steps around the rank.
    """
    blocks = blocked(_thresholds(points, k, sample).select("pid", "x", "w", "steps"), block_rows)
    placed, every = blocks.points, materialize(near_pairs(blocks, blocks, float("inf")))
    others = placed.select("x", "w", "block")
    names = [f"s{n}" for n in range(STEPS)]
    counted = over_pairs(placed.select("pid", "x", "steps", "block"), others, every, _within_steps, "pid long, " + ", ".join(f"{n} double" for n in names))
    counted = counted.groupBy("pid").agg(*[F.sum(n).alias(n) for n in names])
    fits = placed.select("pid", "x", "steps", "block").join(counted, "pid")
    lo, hi = F.lit(0.0), F.lit(float("inf"))
    for n, name in enumerate(names):
        lo = F.when(F.col(name) < k, F.col("steps")[n]).otherwise(lo)
        hi = F.when(F.col(names[-1 - n]) >= k, F.col("steps")[STEPS - 1 - n]).otherwise(hi)
    asked = materialize(fits.select("pid", "x", "block", (lo * (1 - 1e-7)).alias("lo"), (hi * (1 + 1e-7)).alias("hi")))
    found = None
    while True:
        got = over_pairs(asked, others, every, _between, "pid long, below long, near array<double>, weight array<long>")
        got = got.select("pid", "below", F.arrays_zip(F.col("near").alias("d"), F.col("weight").alias("w")).alias("e"))
        got = got.groupBy("pid").agg(F.sum("below").alias("below"), F.array_sort(F.flatten(F.collect_list("e"))).alias("e"))
        start = F.struct(F.col("below").alias("n"), F.lit(None).cast("double").alias("d"))
        step = lambda at, e: F.when(at["n"] >= k, at).otherwise(F.struct((at["n"] + e["w"]).alias("n"), F.when(at["n"] + e["w"] >= k, e["d"]).alias("d")))
        got = materialize(got.select("pid", F.aggregate("e", start, step)["d"].alias("d")))
        done = got.filter("d IS NOT NULL")
        found = done if found is None else found.unionByName(done)
        # A step that rounding put on the wrong side of the rank is asked again without bounds, once.
        missed = asked.join(got.filter("d IS NULL").select("pid"), "pid").filter("lo > 0 OR hi < double('infinity')")
        asked = materialize(missed.withColumns({"lo": F.lit(0.0), "hi": F.lit(float("inf"))}))
        if asked.isEmpty():
            return materialize(found)


def k_distances(points: Blocks, k: int) -> DataFrame:
    """(pid, k_distance): distance to the k-th nearest row, the row itself counted first."""
    near = neighbours(points, points, k)
    enough = F.aggregate("near", F.lit(0).cast("long"), lambda n, e: n + e["w"]) >= k
    return near.select("pid", F.when(enough, F.element_at("near", -1)["d"]).alias("k_distance"))


def k_distance_rows(
    df: DataFrame, k: int = 5, x: str = "x", block_rows: int | None = None
) -> DataFrame:
    """Input rows with ``k_distance``; sorted by it they draw the curve."""
    points = distinct_points(df, x)
    blocks = blocked(points, block_rows or block_size(points))
    reached = k_distances(blocks, k).join(blocks.points.select("pid", "x"), "pid")
    return df.join(reached.select(F.col("x").alias(x), "k_distance"), x)


def _shares(labels: np.ndarray, weights: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(model, cluster) of all clusters present, and the weight that each row has in them."""
    present = [(m, int(c)) for m in range(labels.shape[1]) for c in np.unique(labels[:, m]) if c >= 0]
    share = np.zeros((len(labels), len(present)))
    for i, (m, c) in enumerate(present):
        share[:, i] = np.where(labels[:, m] == c, weights, 0)
    return present, share


def _totals(pids: np.ndarray, labels: np.ndarray, columns: list[tuple[int, int]], sums: np.ndarray) -> list[pd.DataFrame]:
    """Rows of ``cluster_distance_sums`` for the points that take part in each model."""
    out = []
    for i, (m, c) in enumerate(columns):
        valid = labels[:, m] >= 0
        out.append(pd.DataFrame({"pid": pids[valid], "model": m, "other": c, "total": sums[valid, i]}))
    return out


def cluster_distance_sums(blocks: Blocks) -> DataFrame:
    """(pid, model, other, total): summed distances of a point to each cluster's rows.

    ``labels`` holds a point's cluster under every model; all models share one
    computation of the distances. Negative labels take no part.
    """

    def sums(rows, others, same):
        at, to = matrix(rows), matrix(others)
        mine, theirs = (np.stack(side["labels"].to_numpy()) for side in (rows, others))
        w, v = (side["w"].to_numpy().astype(float) for side in (rows, others))
        columns, their_share = _shares(theirs, v)
        back, my_share = _shares(mine, w)
        out, turned = np.empty((len(at), len(columns))), np.zeros((len(to), len(back)))
        for start in range(0, len(at), TILE):
            for first in range(0, len(to), TILE):
                d = many_distances(at[start : start + TILE], to[first : first + TILE])
                part = d @ their_share[first : first + TILE]
                out[start : start + TILE] = part if first == 0 else out[start : start + TILE] + part
                if not same:
                    turned[first : first + TILE] += d.T @ my_share[start : start + TILE]
        parts = _totals(rows["pid"].to_numpy(), mine, columns, out)
        if not same:
            parts += _totals(others["pid"].to_numpy(), theirs, back, turned)
        return pd.concat(parts) if parts else pd.DataFrame(columns=["pid", "model", "other", "total"])

    schema = "pid long, model int, other int, total double"
    summed = over_pairs(blocks.points, blocks.points, all_pairs(blocks), sums, schema)
    return summed.groupBy("pid", "model", "other").agg(F.sum("total").alias("total"))
