"""Stage tables, row keys, word positions and hashes shared by the operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclime.functions.lineage import stage_folder

#: White space that ends a word: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = -(2**63)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def stage(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet to the shared folder and read them from there.

    A lost executor costs no earlier work, and the shuffle files of the write go
    as soon as it has ended.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete a stage table that nothing reads any more."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.staged_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def id_key(column: str = "doc_id") -> Column:
    """The id as a key that joins: NULL becomes the smallest number."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def text_key(column: str = "text") -> Column:
    """Tells apart rows that share an id: rows equal in both are one document."""
    return F.xxhash64(F.col(column))


def row_numbers(df: DataFrame, order: list[str], name: str, buckets: int = 1024) -> DataFrame:
    """Number all rows from 0, gapless, without one task that sees them all.

    Rows are dealt into hash buckets of the first ordering column; a bucket is
    numbered by a window and moved by the count of the buckets before it. The
    counts are at most ``buckets`` rows, whatever the size of the table.
    """
    bucket = F.pmod(F.xxhash64(order[0]), F.lit(buckets)).cast("int")
    keyed = df.withColumn("_bucket", bucket)
    counts = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return (
        keyed.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_bucket")  # at most `buckets` rows
        .withColumn(name, F.col("_before") + F.col("_inside") - 1)
        .drop("_bucket", "_inside", "_before")
    )


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BACK)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, and where each begins and ends. NULL is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def slices(ends: np.ndarray, most: int = 1 << 21) -> list[tuple[int, int]]:
    """Runs of texts of some `most` bytes; a longer text is a run of its own."""
    out, i = [], 0
    while i < len(ends) - 1:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, side="right")) - 1)
        out.append((i, j))
        i = j
    return out


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text number of every word; a word ends with its text."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~_SPACE[data]
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    bounds = ends[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(data))]
    first[bounds] |= inside[1:-1][bounds]
    last[bounds - 1] |= inside[1:-1][bounds - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(ends, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, from differences of one running sum."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return mix64((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """64-bit hashes of all runs of n word hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = out * (_BASE + np.uint64(2 * salt)) + words[i : len(words) - n + 1 + i]
    return mix64(out ^ np.uint64(salt))


class Memory:
    """Codes of segments seen before, by their 64-bit hashes, in packed arrays; bounded, and without influence on results.

    Hashes are sorted, and next to each lies where its codes begin in one pool and
    how many they are. Only segments of at most ``longest`` bytes are kept. When
    ``most`` segments are held, or their codes fill the pool, all are dropped.
    """

    def __init__(self, kind: type, most: int = 1_000_000, longest: int = 24):
        self.kind, self.most, self.longest = np.dtype(kind), most, longest
        self.clear()

    def clear(self) -> None:
        self.hashes, self.begins, self.widths = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, self.kind), 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 if it is not held."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def add(self, hashes: np.ndarray, codes: np.ndarray, widths: np.ndarray, keep: np.ndarray) -> np.ndarray:
        """Put codes that lie end to end into the pool, and say where each begins; those to ``keep`` are found later (hashes ascend)."""
        if self.used + len(codes) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(len(self.pool), len(codes)), self.kind)])
        begins = self.used + np.cumsum(widths) - widths
        self.pool[self.used : self.used + len(codes)] = codes
        self.used += len(codes)
        at = np.searchsorted(self.hashes, hashes[keep])
        self.hashes = np.insert(self.hashes, at, hashes[keep])
        self.begins = np.insert(self.begins, at, begins[keep])
        self.widths = np.insert(self.widths, at, widths[keep])
        return begins


def encode_segments(joined: bytes, starts: np.ndarray, memory: Memory, missing) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the segments of a byte string that begin at ``starts``, end to end, and the running number of codes.

    Each distinct segment is coded once; ``missing`` gives the packed codes of a
    list of segments that are not in memory.
    """
    flat = np.frombuffer(joined, dtype=np.uint8)
    stops = np.append(starts[1:], len(flat))
    hashes, first, which = np.unique(span_hashes(flat, starts, stops), return_index=True, return_inverse=True)
    if len(memory.hashes) + len(hashes) > memory.most or memory.used > 16 * memory.most:
        memory.clear()
    at = memory.find(hashes)
    new = np.flatnonzero(at < 0)
    begins, widths = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
    old = np.flatnonzero(at >= 0)
    begins[old], widths[old] = memory.begins[at[old]], memory.widths[at[old]]
    if len(new):
        a, b = starts[first[new]], stops[first[new]]
        coded = missing([joined[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)])
        widths[new] = np.fromiter(map(len, coded), np.int64, len(coded)) // memory.kind.itemsize
        begins[new] = memory.add(hashes[new], np.frombuffer(b"".join(coded), dtype=memory.kind), widths[new], b - a <= memory.longest)
    count = widths[which]
    running = np.concatenate([[0], np.cumsum(count)])
    return memory.pool[np.arange(running[-1]) + np.repeat(begins[which] - running[:-1], count)], running
