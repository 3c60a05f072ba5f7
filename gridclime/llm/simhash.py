"""SimHash near-duplicates by multi-index hashing.

A-Z are lower-cased; the shingles are runs of words, repeats included, and a
text of fewer words is one shingle. NULL, empty and blank texts have
fingerprint zero and link like any other. Rows that share an id are documents
of their own with that id; a NULL id is smaller than all others. Texts of any length are
hashed whole; other columns are ignored, or kept by ``keep_one``. An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclime.llm.common import id_key, stage, text_key
from gridclime.llm.components import components

SEED = 42
#: Fingerprints in a table entry from which on they are linked through points.
HOT = 256
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """64 bits; a bit is set if over half of the shingles' hashes have it set."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words)
    if n <= width:
        h = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate([[0], ends[: n - width] + 1]).tolist()
        stops = ends[width - 1 :].tolist()
        hashed = xxhash.xxh64_intdigest
        h = np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n - width + 1)
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, id, text_key, fp): fp holds the 64 bits as a signed long. NULL texts have fingerprint zero."""

    @F.pandas_udf("long")
    def of(column: pd.Series) -> pd.Series:
        found = [fingerprint(t.encode() if t else b"", width) for t in column]
        return pd.Series(np.array(found, dtype=np.uint64).view(np.int64))

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", id_key().alias("id"), text_key().alias("text_key"), of(text).alias("fp"))


def links(distinct: DataFrame, distance: int = 2, hot: int = HOT) -> DataFrame:
    """(a, b): links among distinct fingerprints ``fp`` that connect all pairs within ``distance`` bits.

    Fingerprints are cut into two halves. Of two fingerprints at most two bits
    apart, one half differs in at most one bit: each fingerprint looks up its
    halves, and its halves with one zero bit set, in the table of halves. (If
    one half differs in one bit, it is zero on one side, and that side finds the
    other.) Matches are verified over all 64 bits.

    Table entries of over ``hot`` fingerprints would make pairs in the square of
    their size. What falls on them is linked through points instead: two
    fingerprints are within two bits exactly if the balls of radius one around
    them share a point, so each point links all around it to the smallest one.
    Every such link is true, none of the connections is lost, and the rows are
    65 per fingerprint.
    """
    if distance != 2:
        raise ValueError("the balls are those for two bits")
    half = lambda s: F.shiftrightunsigned("fp", 32 * s).bitwiseAND(0xFFFFFFFF)
    halves = F.array(*[F.struct(F.lit(s).alias("seg"), half(s).alias("value")) for s in (0, 1)])
    table = distinct.select("fp", F.inline(halves))
    zero_bits = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda i: F.col("value").bitwiseAND(_bit(i)) == 0)
    flips = F.transform(zero_bits, lambda i: F.col("value").bitwiseOR(_bit(i)))
    asks = table.select("fp", "seg", F.col("value").alias("own"), F.explode(F.concat(F.array("value"), flips)).alias("value"))
    crowded = stage(table.groupBy("seg", "value").count().where(F.col("count") > hot).select("seg", "value"))
    key = ["seg", "value"]
    entries, quiet = table.join(crowded, key, "left_anti"), asks.join(crowded, key, "left_anti")
    dense = asks.join(crowded, key, "left_semi").select("fp").distinct()
    met = (
        quiet.alias("p")
        .join(entries.alias("t"), (F.col("p.seg") == F.col("t.seg")) & (F.col("p.value") == F.col("t.value")))
        .where("(p.value <> p.own) OR (p.fp < t.fp)")
        .where(F.bit_count(F.col("p.fp").bitwiseXOR(F.col("t.fp"))) <= distance)
        .select(F.col("p.fp").alias("a"), F.col("t.fp").alias("b"))
    )
    return met.unionByName(through_points(dense)) if not crowded.isEmpty() else met


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def through_points(dense: DataFrame) -> DataFrame:
    """Links to the smallest fingerprint around each point of the balls of radius one."""
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(_bit(i)))
    points = stage(dense.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("point")))
    least = points.groupBy("point").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high")
    return points.join(least.select("point", "low"), "point").where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2, hot: int = HOT) -> DataFrame:
    """One row per row: doc_id, id, text_key, fp, component (smallest id that it reaches).

    Equal fingerprints are one node, so copies make no pairs.
    """
    marked = stage(fingerprints(docs, width))
    distinct = stage(marked.groupBy("fp").agg(F.min("id").alias("low")))
    roots = components(links(distinct, distance, hot).select("a", "b"))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    of = stage(rooted.join(lowest, "root").select("fp", "component"))
    return marked.join(of.hint("merge"), "fp")


def keep_one(docs: DataFrame, width: int = 3, distance: int = 2) -> DataFrame:
    """The documents with the smallest id of each component, all columns; of rows equal in id and text, one."""
    found = near_duplicates(docs, width, distance)
    chosen = (
        found.where("id = component").groupBy("component").agg(F.min("text_key").alias("text_key")).withColumnRenamed("component", "id")
    )
    rows = docs.select(F.struct("*").alias("row"), id_key().alias("id"), text_key().alias("text_key"))
    first = F.row_number().over(Window.partitionBy("id", "text_key").orderBy("id"))
    return rows.join(chosen.hint("merge"), ["id", "text_key"]).withColumn("n", first).where("n = 1").select("row.*")
