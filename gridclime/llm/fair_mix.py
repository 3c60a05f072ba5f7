"""Mixing sources to target weights by weighted fair queueing.

Each source gets a target of words: its weight's part of the budget, but at
most ``cap`` times its own words; what is over goes to the others by weight.
The documents of a source queue up in a shuffled order, epoch after epoch, and
the virtual finish time of a document is the words of its source up to its end
divided by the source's target. All sources' queues are sorted together by
finish time and cut at the budget, so each source has been served its target
when the budget is spent, up to a document.

Sources come by code point, NULL last, and weigh 3, 1, 2, repeating. An empty
or NULL text has no words and is never taken. Rows that share an id are told
apart by size and by a hash of the text; rows equal in all are dealt with each. A
source without words has target zero. Texts of any length are counted whole;
other columns are ignored, or kept by ``mixed``. An empty table gives no rows.
Only built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclime.llm.common import WORD, id_key, stage, text_key

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
#: Rows that one window task orders, about.
ROWS_A_BUCKET = 50_000


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source_key, source, source_size, target): one row per source.

    The level is the words per unit of weight. A source whose cap lies under
    the level gets its cap; the level that spends the rest exactly is the
    largest one that does not pass the cap of the source it is computed at.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "rank")
    everything = Window.partitionBy()
    listed = F.array(*[F.lit(w) for w in weights])
    return (
        sizes.groupBy("source_key", "source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(listed, (F.col("rank") - 1) % len(weights) + 1))
        .withColumn("limit", cap * F.col("source_size"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("spent", F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("budget", share * F.sum("source_size").over(everything))
        .withColumn("level", (F.col("budget") - F.col("spent")) / F.col("left"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
        .select(
            "source_key",
            "source",
            "source_size",
            F.least(F.col("limit").cast("double"), F.col("weight") * F.coalesce("level", F.col("ratio"))).alias("target"),
        )
    )


def queue(sizes: DataFrame, goals: DataFrame, buckets: int) -> DataFrame:
    """Each row with source_size, target and the words of its source up to its end.

    A source's queue is cut into ranges of the shuffle key; sums within a range
    start at the sum of the ranges before it, so no task orders a whole source.
    """
    spread = F.conv(F.substring("shuffle", 1, 6), 16, 10).cast("long")
    dealt = sizes.withColumn("range", F.floor(spread * buckets / 2**24).cast("int"))
    before = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("source_key", "range")
        .agg(F.sum("size").alias("words"))
        .select("source_key", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
        .join(goals.hint("merge"), "source_key")
    )
    inside = Window.partitionBy("source_key", "range").orderBy("shuffle", "doc_id", "size", "text_key")
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        dealt.withColumn("upto", upto)
        .withColumn("place", F.row_number().over(inside))
        .join(starts.drop("source").hint("merge"), ["source_key", "range"])
        .withColumn("words", F.col("start") + F.col("upto"))
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, rows_a_bucket: int = ROWS_A_BUCKET
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, copies, finish."""
    sizes = stage(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null")).alias("source_key"),
            size_of().alias("size"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("shuffle"),
            text_key().alias("text_key"),
        )
    )
    buckets = max(16, sizes.count() // rows_a_bucket)
    goals = stage(targets(sizes, weights, share, cap))
    budget = share * (goals.agg(F.sum("source_size")).first()[0] or 0)
    queued = stage(queue(sizes, goals, buckets))
    turns = [F.struct(*turn(e)) for e in range(cap)]
    served = queued.where("size > 0").select("size", F.explode(F.array(*turns)).alias("turn"))
    served = served.select("size", "turn", slice_of("turn.finish", buckets).alias("slice"))
    # The queue sorted by finish time is cut in two steps: in which slice of time the budget ends, and where in it.
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    over = (
        served.groupBy("slice")
        .agg(F.sum("size").alias("words"))  # at most 4 * buckets + 1 rows
        .withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .where(F.col("before") + F.col("words") > budget)
        .orderBy("slice")
        .first()
    )
    if over is None:
        taken = [F.lit(True)] * cap
    else:
        inside = Window.partitionBy("slice").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
        last = (
            served.where(F.col("slice") == over["slice"])
            .withColumn("words", F.sum("size").over(inside))
            .where(F.col("words") + over["before"] <= budget)
            .agg(F.max("turn"))
            .first()[0]
        )
        taken = [slice_of(t.getField("finish"), buckets) < over["slice"] for t in turns]
        if last is not None:
            cut = F.struct(*[F.lit(v).cast(k).alias(c) for (c, k), v in zip(TURN.items(), last, strict=True)])
            taken = [early | ((slice_of(t.getField("finish"), buckets) == over["slice"]) & (t <= cut)) for early, t in zip(taken, turns, strict=True)]
    copies = sum((F.when((F.col("size") > 0) & x, 1).otherwise(0) for x in taken), F.lit(0)).cast("long")
    return queued.withColumn("copies", copies).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
        turns[0].getField("finish").alias("finish"),
        "text_key",
    )


#: What orders the merged queue: finish time, then fields that make the order total.
TURN = {"finish": "double", "source_key": "string", "range": "int", "place": "int", "epoch": "int"}


def turn(epoch: int) -> list[Column]:
    finish = (epoch * F.col("source_size") + F.col("words")) / F.nullif(F.col("target"), F.lit(0.0))
    return [finish.alias("finish"), F.col("source_key"), F.col("range"), F.col("place"), F.lit(epoch).alias("epoch")]


def slice_of(finish: str | Column, buckets: int) -> Column:
    time = F.col(finish) if isinstance(finish, str) else finish
    return F.least(F.floor(time * buckets), F.lit(4 * buckets)).cast("int")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents the mix takes, each as often as it is taken, in the order of the mix.

    Equal rows are interchangeable: their copies are shared out among them.
    """
    source = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("null"))
    keys = ["id", "text_key", "source_key"]
    chosen = (
        mix(docs, **options)
        .groupBy(id_key().alias("id"), "text_key", source.alias("source_key"))
        .agg(
            F.sum("copies").alias("copies"),
            F.count("*").alias("rows"),
            F.min("finish").alias("finish"),
            F.first(F.col("source_size") / F.nullif(F.col("target"), F.lit(0.0))).alias("round"),
        )
        .where("copies > 0")
    )
    rows = docs.select(F.struct("*").alias("row"), id_key().alias("id"), text_key().alias("text_key"), source.alias("source_key"))
    twin = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    copies = F.expr("copies div rows + CASE WHEN twin <= copies % rows THEN 1 ELSE 0 END")
    return (
        rows.withColumn("twin", twin)
        .join(chosen.hint("merge"), keys)
        .withColumn("copies", copies)
        .where("copies > 0")
        .select("row", "id", "text_key", "finish", "round", F.explode(F.expr("sequence(0L, copies - 1)")).alias("epoch"))
        .orderBy(F.col("finish") + F.col("epoch") * F.col("round"), "id", "text_key", "epoch")
        .select("row.*")
    )
