"""Token ids in training order, in binary shards of fixed stride.

Documents are dealt into hash buckets of their ids and tokenised there; the
tokens of a bucket, each document closed by an end token, are cut into
sequences of fixed length, the last one filled up with end tokens. Sequences
are numbered through all buckets. A Feistel permutation with cycle walking,
keyed by a seed, sends each number to a global slot, so the order of training
is a shuffle that the key alone fixes; slot s is record s % records of shard
s // records. Each shard is one file of fixed-stride records, so a reader goes
through them in sequence and resumes at any slot by a seek.

Shards are written in passes over ranges of slots: only one pass's records are
in shuffle files at a time, and a pass whose files are there is not repeated.
A record is the little-endian ids and one line feed, as Spark's text writer
puts it; its committer makes files appear whole or not at all.

NULL and empty texts give an end token alone. Rows that share an id follow each
other by the hash of their texts. Long texts are coded whole, some at a time
with other short ones, and go over as many sequences as they need. Other columns
are ignored. An empty table gives a manifest, no shards, and no rows when read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridclime.llm.common import Memory, encode_segments, id_key, slices, stage, text_bytes, text_key
from gridclime.llm.feistel import Feistel
from gridclime.llm.pieces import load
from gridclime.sources import tables

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BUCKETS = 16_384
LENGTH, RECORDS, PASSES = 1024, 2048, 4
#: Segments whose ids a worker keeps, at some 40 bytes each.
MEMORY = 800_000
_ASCII_SPACE = np.zeros(256, dtype=bool)
_ASCII_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LEAD = np.zeros(256, dtype=bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _odd_spaces(data: np.ndarray) -> np.ndarray:
    """Where white space begins that is none of the six usual bytes; a text that has it is split as a whole.

    In UTF-8 that is 1C to 1F, C2 85, C2 A0, E1 9A 80, E2 80 80 to 8A, E2 80 A8, A9 and AF, E2 81 9F, E3 80 80.
    """
    low = np.flatnonzero((data >= 0x1C) & (data <= 0x1F))
    lead = np.flatnonzero(_LEAD[data])
    padded = np.append(data, [0, 0])
    one, two, three = data[lead], padded[lead + 1], padded[lead + 2]
    found = ((one == 0xC2) & ((two == 0x85) | (two == 0xA0))) | ((one == 0xE1) & (two == 0x9A) & (three == 0x80))
    general = (two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF))
    found |= (one == 0xE2) & (general | ((two == 0x81) & (three == 0x9F)))
    found |= (one == 0xE3) & (two == 0x80) & (three == 0x80)
    return np.concatenate([low, lead[found]])


class Tokens:
    """Byte-pair ids of texts; the end token is the number of ranks."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.end = len(table)
        self.widths = np.zeros(self.end, dtype=np.int64)
        self.widths[list(table.values())] = [len(k) for k in table]
        self.kind = np.dtype("<u2") if self.end < 2**16 else np.dtype("<u4")
        self.memory = Memory(self.kind, MEMORY)

    def _missing(self, segments: list[bytes]) -> list[bytes]:
        """Ids of segments. Those of one blank and a word are coded together: the pattern cuts before each blank."""
        out = [b""] * len(segments)
        plain = [k for k, s in enumerate(segments) if len(s) > 1 and s[0] == 0x20 and len(s.split()) == 1 and s[1] > 0x20 and s[-1] > 0x20]
        alone = set(range(len(segments))).difference(plain)
        for at in range(0, len(plain), 20_000):
            part = plain[at : at + 20_000]
            ids = np.array(self.coder.encode_ordinary(b"".join([segments[k] for k in part]).decode("utf-8", "replace")), dtype=self.kind)
            ends = np.cumsum([len(segments[k]) for k in part])
            bounds = np.concatenate([[0], np.searchsorted(np.cumsum(self.widths[ids]), ends) + 1])
            packed, size = ids.tobytes(), self.kind.itemsize
            for k, a, b in zip(part, (bounds[:-1] * size).tolist(), (bounds[1:] * size).tolist(), strict=True):
                out[k] = packed[a:b]
        for k in alone:
            out[k] = np.array(self.coder.encode_ordinary(segments[k].decode("utf-8", "replace")), dtype=self.kind).tobytes()
        return out

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts that lie end to end, and where the ids of each text begin and end.

        The pattern never joins what stands before a run of white space to the
        run, so texts are cut there and each distinct segment is coded once.
        """
        joined = data.tobytes()
        space = _ASCII_SPACE[data]
        head = space.copy()
        head[1:] &= ~space[:-1]
        for k in np.unique(np.searchsorted(ends, _odd_spaces(data), side="right") - 1).tolist():
            head[ends[k] : ends[k + 1]] = False
        head[ends[:-1][np.diff(ends) > 0]] = True
        starts = np.flatnonzero(head)
        ids, running = encode_segments(joined, starts, self.memory, self._missing)
        return ids, running[np.searchsorted(starts, ends)]


_held: dict[int, Tokens] = {}


def held(ranks: bytes) -> Tokens:
    """The tokeniser in this worker."""
    key = hash(ranks)
    if key not in _held:
        _held.clear()
        _held[key] = Tokens(ranks)
    return _held[key]


def sequences(docs: DataFrame, ranks: str = RANKS, length: int = LENGTH, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, at, doc_ids, n_tokens, tokens): the sequences of each bucket in order; tokens without the filling."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(load(spark, ranks))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
    dealt = (
        docs.select("doc_id", id_key().alias("id"), text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("bucket", bucket)
        .repartitionById(parts, F.floor(F.col("bucket") * parts / buckets).cast("int"))
        .sortWithinPartitions("bucket", "id", "text_key")
        .select("bucket", "doc_id", "text")
    )
    schema = "bucket int, at int, doc_ids array<long>, n_tokens int, tokens binary"

    def rows(cut: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.binary())
        columns = zip(*cut, strict=True) if cut else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in schema.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held(shipped.value)
        end = np.array([coder.end], dtype=coder.kind)
        bucket, at, kept, ids, filled = None, 0, [], [], 0  # the sequence that is being filled

        def closed() -> tuple:
            return bucket, at, list(dict.fromkeys(ids)), filled, b"".join(x.tobytes() for x in kept)

        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            for i, j in slices(ends, 1 << 20):
                codes, bounds = coder.encode(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
                cut = []
                part = zip(batch.column("bucket").slice(i, j - i).to_pylist(), batch.column("doc_id").slice(i, j - i).to_pylist(), strict=True)
                for k, (own, doc) in enumerate(part):
                    if own != bucket:
                        if filled:
                            cut.append(closed())
                        bucket, at, kept, ids, filled = own, 0, [], [], 0
                    left = np.concatenate([codes[bounds[k] : bounds[k + 1]], end])
                    while len(left):
                        piece, left = left[: length - filled], left[length - filled :]
                        kept.append(piece)
                        ids.append(doc)
                        filled += len(piece)
                        if filled == length:
                            cut.append(closed())
                            at, kept, ids, filled = at + 1, [], [], 0
                yield rows(cut)
        if filled:
            yield rows([closed()])

    return dealt.mapInArrow(work, schema)


def slotted(cut: DataFrame, total: int, key: int) -> DataFrame:
    """The sequences, of which there are ``total``, with their global ``slot``."""
    counts = cut.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    @F.pandas_udf("long")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(Feistel(total, key).permute(number.to_numpy(np.int64)))

    numbered = cut.join(F.broadcast(offsets), "bucket")  # as many rows as buckets, which is a parameter
    return numbered.withColumn("slot", slot(F.col("before") + F.col("at"))).drop("before")


def _manifest(cut: DataFrame, key: int, length: int, records: int, ranks: bytes) -> dict:
    """What the shards of these sequences depend on."""
    row = F.xxhash64("bucket", "at", "n_tokens", "tokens", F.array_join(F.transform("doc_ids", lambda d: F.coalesce(d.cast("string"), F.lit("null"))), ","))
    found = cut.agg(F.count("*").alias("sequences"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("checksum")).first()
    coder = held(ranks)
    return {
        "key": key, "length": length, "records": records, "sequences": found["sequences"], "checksum": found["checksum"],
        "width": coder.kind.itemsize, "end": coder.end, "ranks": zlib.crc32(ranks),
    }


def _exists(spark, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def manifest(spark, path: str) -> dict:
    return tables.read_metadata(spark, f"{path}/manifest")


def write_shards(
    docs: DataFrame, path: str, key: int = 20261, ranks: str = RANKS, length: int = LENGTH, records: int = RECORDS, passes: int = PASSES
) -> DataFrame:
    """Write the shards under ``path`` and return the index of their records.

    The index: slot, shard, record, byte_offset, doc_ids, n_tokens. A folder that
    holds shards of other sequences, or under another key or layout, is refused.
    """
    spark = docs.sparkSession
    coded = stage(sequences(docs, ranks, length))
    shipped = load(spark, ranks)
    wanted = _manifest(coded, key, length, records, shipped)
    if _exists(spark, f"{path}/manifest/_SUCCESS"):
        there = manifest(spark, path)
        if there != wanted:
            raise ValueError(f"{path} holds other shards: " + ", ".join(f"{k} {there.get(k)} there, {v} now" for k, v in wanted.items() if there.get(k) != v))
    else:
        tables.write_metadata(spark, wanted, f"{path}/manifest")
    total, size = wanted["sequences"], wanted["width"]
    cut = slotted(coded, total, key).withColumn("shard", F.floor(F.col("slot") / records).cast("int"))
    fill = F.lit(np.array([wanted["end"]], dtype=held(shipped).kind).tobytes())
    shards = -(-total // records)
    step = max(1, -(-shards // passes))
    for first in range(0, shards, step):
        last = min(shards, first + step)
        target = f"{path}/shards/from={first}"
        if _exists(spark, f"{target}/_SUCCESS"):
            continue
        padded = F.concat("tokens", F.unhex(F.repeat(F.hex(fill), F.lit(length) - F.col("n_tokens"))))
        (
            cut.where((F.col("shard") >= first) & (F.col("shard") < last))
            .select("shard", "slot", padded.cast("string").alias("record"))
            .repartitionById(last - first, (F.col("shard") - first).cast("int"))
            .sortWithinPartitions("shard", "slot")
            .select("shard", "record")
            .write.mode("overwrite")
            .partitionBy("shard")
            .text(target)
        )
    record = (F.col("slot") % records).cast("int")
    return cut.select("slot", "shard", record.alias("record"), (record * (length * size + 1)).cast("long").alias("byte_offset"), "doc_ids", "n_tokens")


def read_shards(spark, path: str, tokens: bool = True) -> DataFrame:
    """(slot, tokens_crc32 and, if wanted, tokens) of the records in all shards, in order within a shard."""
    layout = manifest(spark, path)
    width, records = layout["length"] * layout["width"], layout["records"]
    schema = "slot long, tokens_crc32 long" + ", tokens binary" * tokens
    if not layout["sequences"]:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(f"{path}/shards")
    shard = F.regexp_extract("path", r"shard=(\d+)/", 1).cast("int")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                view = memoryview(content.as_buffer())
                held_records = [view[at : at + width] for at in range(0, len(view), width + 1)]
                slots = number * records + np.arange(len(held_records))
                columns = {"slot": pa.array(slots), "tokens_crc32": pa.array([zlib.crc32(r) for r in held_records], pa.int64())}
                if tokens:
                    columns["tokens"] = pa.array(held_records, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    # A file, of `records` records, is one row; it is cut up in the task that reads it.
    return files.select(shard.alias("shard"), "content").mapInArrow(work, schema)


def read_from(spark, path: str, slot: int = 0, ahead: int = 64) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, ids) of all records from a slot on, one after the other; ``ahead`` records are held at a time.

    The reader opens the slot's shard and seeks to the record, so a stopped
    training goes on where it was without reading what came before.
    """
    layout = manifest(spark, path)
    stride = layout["length"] * layout["width"] + 1
    kind = "<u2" if layout["width"] == 2 else "<u4"
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    while slot < layout["sequences"]:
        shard, record = divmod(slot, layout["records"])
        (found,) = files.globStatus(context._jvm.org.apache.hadoop.fs.Path(f"{path}/shards/from=*/shard={shard}/part-*"))
        stream = files.open(found.getPath())
        try:
            stream.seek(record * stride)
            while data := bytes(stream.readNBytes(ahead * stride)):
                for at in range(0, len(data), stride):
                    yield slot, np.frombuffer(data[at : at + stride - 1], dtype=kind)
                    slot += 1
        finally:
            stream.close()
