"""Exact dedup against a minimal perfect hash over historical distinct digests.

The history's distinct digests are cut into buckets by their first bytes. Each
bucket gets a minimal perfect hash by levels: a digest that is alone in its
place of a level's bit array stays there, the others go on to the next level;
its slot is the number of set bits before its own. Slots hold the full digest
and the locator (id) and count of its winner. A digest is looked up by one
evaluation and one comparison with the digest in the slot. Members' texts are
then compared byte by byte with the winner's; rows whose digest is unknown, or
whose bytes differ after all, group among themselves by digest and text.

Texts are equal when identical after lower-casing A-Z; NULL counts as empty.
The row with the largest id stays. Rows that share an id and a text are one
document and share their fate; a NULL id is smaller than all others. Texts of any length are compared whole; other columns
are ignored. An empty history, an empty batch or both are allowed; nothing gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclime.llm.common import NO_ID, id_key, mix64, stage, text_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Distinct digests in a bucket, about; a bucket is what one task holds at a time.
BUCKET_KEYS = 4096
#: Places in a level's bit array for each digest that reaches it.
SPACE = 2


def normalized(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)


def _places(digests: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each digest (rows of four 64-bit words) in the bit array of a level."""
    h = np.full(len(digests), level + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for word in range(4):
        h = mix64(h ^ digests[:, word])
    return (h % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Bit arrays of the levels, and the slot of each digest. The digests are distinct."""
    levels, slots = [], np.zeros(len(digests), dtype=np.int64)
    rest, base = np.arange(len(digests)), 0
    while len(rest):
        size = 8 * (SPACE * len(rest) // 8 + 1)
        at = _places(digests[rest], len(levels), size)
        bits = np.bincount(at, minlength=size) == 1
        alone = bits[at]
        slots[rest[alone]] = base + (np.cumsum(bits) - 1)[at[alone]]
        levels.append(np.packbits(bits).tobytes())
        base += int(bits.sum())
        rest = rest[~alone]
    return levels, slots


def slots_of(digests: np.ndarray, levels: list[bytes]) -> np.ndarray:
    """Slots of digests; -1 if no level has a place. A stranger may get any slot."""
    slots, rest, base = np.full(len(digests), -1, dtype=np.int64), np.arange(len(digests)), 0
    for k, packed in enumerate(levels):
        bits = np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).astype(bool)
        at = _places(digests[rest], k, len(bits))
        found = bits[at]
        slots[rest[found]] = base + (np.cumsum(bits) - 1)[at[found]]
        base += int(bits.sum())
        rest = rest[~found]
    return slots


def _words(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=">u8").reshape(-1, 4).astype(np.uint64)


def build_table(history: DataFrame, buckets: int) -> DataFrame:
    """(bucket, levels, slot_digests, winners, counts) from distinct (digest, winner, rows)."""

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("digest")
        levels, slots = build_hash(_words(group["digest"]))
        order = np.argsort(slots)
        return pd.DataFrame(
            {
                "bucket": [key[0]],
                "levels": [levels],
                "slot_digests": [b"".join(group["digest"].iloc[order])],
                "winners": [group["winner"].to_numpy(np.int64)[order]],
                "counts": [group["rows"].to_numpy(np.int64)[order]],
            }
        )

    schema = "bucket int, levels array<binary>, slot_digests binary, winners array<long>, counts array<long>"
    return history.withColumn("bucket", bucket_of(buckets)).groupBy("bucket").applyInPandas(build, schema)


def bucket_of(buckets: int) -> Column:
    return (F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long") % buckets).cast("int")


def settle(table: DataFrame, batch: DataFrame, buckets: int) -> DataFrame:
    """One row per distinct digest of either side: digest, keep, group_size, member.

    Each digest of the batch is looked up in its bucket's hash. A member moves
    its slot's locator and count; the others are groups of their own.
    """

    def find(key: tuple, slots: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        keep, size = asked["newest"].to_numpy(np.int64), asked["rows"].to_numpy(np.int64)
        digests, member = asked["digest"].to_numpy(), np.zeros(len(asked), dtype=bool)
        parts = []
        if len(slots):
            packed = slots["slot_digests"].iloc[0]
            held = np.frombuffer(packed, dtype=">u8").reshape(-1, 4).astype(np.uint64)
            winners, counts = np.array(slots["winners"].iloc[0], np.int64), np.array(slots["counts"].iloc[0], np.int64)
            if len(asked):
                words = _words(asked["digest"])
                at = slots_of(words, list(slots["levels"].iloc[0]))
                member = (at >= 0) & (held[at] == words).all(axis=1)
                winners[at[member]] = np.maximum(winners[at[member]], keep[member])
                counts[at[member]] += size[member]
            own = [packed[i : i + 32] for i in range(0, len(packed), 32)]
            parts.append(pd.DataFrame({"digest": own, "keep": winners, "group_size": counts, "member": True}))
        new = ~member
        parts.append(pd.DataFrame({"digest": digests[new], "keep": keep[new], "group_size": size[new], "member": False}))
        return pd.concat(parts, ignore_index=True)

    asked = batch.withColumn("bucket", bucket_of(buckets)).groupBy("bucket")
    return table.groupBy("bucket").cogroup(asked).applyInPandas(find, "digest binary, keep long, group_size long, member boolean")


def distinct_digests(rows: DataFrame, winner: str) -> DataFrame:
    """One row per digest; partial sums come before the shuffle, so a hot digest is small."""
    return rows.groupBy("digest").agg(F.max("id").alias(winner), F.count("*").alias("rows"))


def dedup(history: DataFrame, batch: DataFrame) -> DataFrame:
    """One row per row of both: doc_id, keep_id, group_size, kept, text_sha256, member.

    ``member`` is true if the digest was in the history.
    """
    digest = F.unhex(F.sha2(normalized(), 256))
    columns = ["doc_id", id_key().alias("id"), text_key().alias("text_key"), digest.alias("digest")]
    rows = stage(history.select(*columns, F.lit(True).alias("old")).unionByName(batch.select(*columns, F.lit(False).alias("old"))))
    known = stage(distinct_digests(rows.where("old"), "winner"))
    asked = stage(distinct_digests(rows.where("NOT old"), "newest"))
    buckets = max(1, max(known.count(), asked.count()) // BUCKET_KEYS)
    groups = stage(settle(build_table(known, buckets), asked, buckets))
    grouped = stage(rows.drop("old").join(groups.hint("merge"), "digest"))
    repeats = texts_of_repeats(history, batch, grouped)
    clashes = stage(
        repeats.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high")).where("low <> high").select("digest")
    )
    if not clashes.isEmpty():  # texts that differ under one digest: group them by their bytes
        apart = stage(repeats.join(clashes, "digest"))
        own = apart.groupBy("digest", "text").agg(F.max("id").alias("own_keep"), F.count("*").alias("own_size"))
        own = apart.join(own, ["digest", "text"]).select("id", "text_key", "digest", "own_keep", "own_size").distinct()
        grouped = (
            grouped.join(own, ["id", "text_key", "digest"], "left")
            .withColumn("keep", F.coalesce("own_keep", "keep"))
            .withColumn("group_size", F.coalesce("own_size", "group_size"))
        )
    return grouped.select(
        "doc_id",
        F.nullif("keep", F.lit(NO_ID)).alias("keep_id"),
        "group_size",
        (F.col("id") == F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "member",
    )


def texts_of_repeats(history: DataFrame, batch: DataFrame, grouped: DataFrame) -> DataFrame:
    """(id, text_key, digest, text) of the documents that share a digest, by id, so that no key is hot.

    All texts of a digest are equal byte for byte if the least is the greatest;
    both combine before the shuffle, however large the group.
    """
    repeats = grouped.where("group_size > 1").select("id", "text_key", "digest").distinct()
    columns = [id_key().alias("id"), text_key().alias("text_key"), normalized().alias("text")]
    texts = history.select(*columns).unionByName(batch.select(*columns))
    return texts.join(repeats.hint("merge"), ["id", "text_key"])
