"""Sharding by a keyed permutation of the global row numbers.

Row numbers are dealt out gaplessly; a Feistel permutation with cycle walking
sends each to a position, and position p lies in shard p % shards at slot
p // shards. Shard and slot of a row, and the row of a slot, are computed from
the key alone. Counts of the shards differ by at most one, slots have no gaps.

Rows are numbered by hash buckets of their ids, so the numbers and with them
the shards are the same in every run. Rows that share an id are told apart by
checksum and size; full copies are interchangeable. A NULL text has no
bytes, texts of any length count whole, other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclime.llm.common import row_numbers
from gridclime.llm.feistel import Feistel

LAW = "rows"


def place(numbers: np.ndarray, rows: int, shards: int, key: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of global row numbers."""
    position = Feistel(rows, key).permute(numbers)
    return position % shards, position // shards


def row_at(shard: np.ndarray, slot: np.ndarray, rows: int, shards: int, key: int) -> np.ndarray:
    """Global row numbers of slots: the way back."""
    return Feistel(rows, key).invert(np.asarray(slot) * shards + np.asarray(shard))


def shard(docs: DataFrame, shards: int = 16, key: int = 20260) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the row number, per row."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    numbered = row_numbers(sized, ["doc_id", "text_crc32", "size"], "row_number")
    rows = docs.count()

    @F.pandas_udf("shard int, slot long")
    def placed(numbers: pd.Series) -> pd.DataFrame:
        at, slot = place(numbers.to_numpy(np.int64), rows, shards, key)
        return pd.DataFrame({"shard": at.astype(np.int32), "slot": slot})

    return numbered.withColumn("placed", placed("row_number")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "placed.shard",
        "placed.slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
