"""Document fingerprints: quartile bucket digests.

Every run of five bytes gives six byte triplets that hold its last byte; each
is hashed to one of 256 counters. The digest is the length on a logarithmic
scale, two quartile ratios, and two bits per bucket that say in which quarter
of the counts it lies. Digests are compared by a difference score with an upper
bound; the likeness is what is left of the bound.

NULL counts as an empty text. A text of under five bytes has no triplets; its
buckets hold a hash of its bytes, so that very short texts are alike only if
they are equal. Equal texts have equal digests. Rows that share an id follow
each other in the order of their texts. Texts of any length are read whole; other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclime.llm.common import id_key, slices

BUCKETS = 256
#: Pairs of earlier bytes, by distance from the last of the five, that join it in a triplet.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
SPAN = 4
#: Cost by distance of two quarters; its mean over unrelated quarters is 1.375.
COST = np.array([0, 1, 2, 4])
#: The score that unrelated digests reach on average; a higher one counts as this.
BOUND = 352
LENGTH_COST, RATIO_COST = 4, 2

_rng = np.random.default_rng(5)
_TABLES = np.stack([np.stack([_rng.permutation(256) for _ in range(3)]) for _ in TRIPLETS]).astype(np.uint8)
_QUARTERS = np.arange(256)[:, None] >> np.array([6, 4, 2, 0]) & 3
_BYTE_COST = COST[np.abs(_QUARTERS[:, None, :] - _QUARTERS[None, :, :])].sum(axis=2).astype(np.uint8)


def bucket_counts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hits of each bucket by the triplets of each text; the texts lie end to end."""
    n = len(ends) - 1
    out = np.zeros(n * BUCKETS, dtype=np.int64)
    step = 1 << 20
    text = np.repeat(np.arange(n), np.diff(ends))
    for at in range(0, max(0, len(data) - SPAN), step):
        part, own = data[at : at + step + SPAN], text[at : at + step + SPAN]
        whole = np.flatnonzero(own[SPAN:] == own[:-SPAN])
        base = own[SPAN:][whole] * BUCKETS
        for (i, j), (a, b, c) in zip(TRIPLETS, _TABLES, strict=True):
            h = a[part[SPAN:]] + b[part[SPAN - i : len(part) - i]] + c[part[SPAN - j : len(part) - j]]
            out += np.bincount(base + h[whole], minlength=len(out))
    return out.reshape(n, BUCKETS)


def digests(texts: list[bytes]) -> np.ndarray:
    """One row of bytes per text: length, quartile ratios, quarters of the buckets."""
    out = np.zeros((len(texts), 2 + BUCKETS // 4), dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.concatenate([[0], np.cumsum(lengths)])
    out[:, 0] = np.minimum(255, np.log(np.maximum(lengths, 1)) / np.log(1.1) + (lengths > 0)).astype(np.uint8)
    for i, j in slices(ends, 1 << 19):
        data = np.frombuffer(b"".join(texts[i:j]), dtype=np.uint8)
        counts = bucket_counts(data, ends[i : j + 1] - ends[i])
        q1, q2, q3 = np.sort(counts, axis=1)[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]].T
        top = np.maximum(q3, 1)
        out[i:j, 1] = (100 * q1 // top % 16) << 4 | (100 * q2 // top % 16)
        codes = (counts > q1[:, None]).astype(np.uint8) + (counts > q2[:, None]) + (counts > q3[:, None])
        out[i:j, 2:] = codes[:, 0::4] << 6 | codes[:, 1::4] << 4 | codes[:, 2::4] << 2 | codes[:, 3::4]
    for i in np.flatnonzero(lengths <= SPAN):
        out[i, 1] = 0xFF
        out[i, 2:] = np.frombuffer(hashlib.sha512(texts[i]).digest(), dtype=np.uint8)[: BUCKETS // 4]
    return out


def differences(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Scores of digest rows, from 0 (equal) up to `BOUND`."""
    score = _BYTE_COST[a[:, 2:], b[:, 2:]].sum(axis=1, dtype=np.int64)
    step = np.abs(a[:, 0].astype(np.int64) - b[:, 0])
    score += np.where(step <= 1, step, LENGTH_COST * step)
    for shift in (4, 0):
        apart = np.abs((a[:, 1] >> shift & 15).astype(np.int64) - (b[:, 1] >> shift & 15))
        apart = np.minimum(apart, 16 - apart)
        score += np.where(apart <= 1, apart, RATIO_COST * apart)
    return np.minimum(score, BOUND)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - differences(a, b) / BOUND


def fingerprint_texts(column: pd.Series) -> list[str]:
    return [x.tobytes().hex() for x in digests([(t or "").encode() for t in column])]


def fingerprint(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns and ``fingerprint``, in hex digits."""

    @F.pandas_udf("string")
    def of(column: pd.Series) -> pd.Series:
        return pd.Series(fingerprint_texts(column.where(column.notna(), "")))

    return df.withColumn("fingerprint", of(text))


def deal(docs: DataFrame, parts: int) -> DataFrame:
    """(part, last, key, doc_id, text): ranges of ids, each followed by the document after it.

    ``parts`` cuts between ids and the largest id of each range go through the
    driver, nothing else. The document with the largest id of a range is dealt
    out twice: into its own range and, as `last`, to the end of the next range
    above it. The largest of all ends the lowest range.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), id_key().alias("key"))
    marks = [i / parts for i in range(1, parts)] or [0.5]
    cuts = docs.select(id_key().alias("key")).agg(F.percentile_approx("key", marks, 10 * parts)).first()[0]
    cuts = np.unique(np.array(cuts or [], dtype=np.int64))

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(np.int64)).astype(np.int32))

    tops = {
        r["part"]: r["top"]
        for r in docs.select(id_key().alias("key"))
        .groupBy(part_of("key").alias("part"))
        .agg(F.max("key").alias("top"))
        .collect()  # at most `parts` rows
    }
    order = sorted(tops)
    above = dict(zip(order, order[1:] + order[:1], strict=True))

    @F.pandas_udf("array<int>")
    def parts_of(key: pd.Series) -> pd.Series:
        keys = key.to_numpy(np.int64)
        own = np.searchsorted(cuts, keys)
        return pd.Series([[p, above[p]] if k == tops[p] else [p] for k, p in zip(keys.tolist(), own.tolist(), strict=True)])

    return (
        rows.withColumn("parts", parts_of("key"))
        .select(F.posexplode("parts").alias("last", "part"), "key", "doc_id", "text")
        .repartitionById(max(1, len(cuts) + 1), "part")
        .sortWithinPartitions("part", "last", F.desc("key"), "text")
    )


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and the two likenesses.

    The edited text is the text with its last third of code points replaced by
    the beginning of the next document in descending order of ids. The texts
    are shuffled once and then streamed; a task holds one batch.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (part, last, id, text, digest) of the row that waits for the next one
        for batch in batches:
            columns = [batch.column(c) for c in ("part", "last", "doc_id", "text")]
            for i, j in slices(np.concatenate([[0], np.cumsum(pa.compute.binary_length(columns[3]).to_numpy())])):
                part, last, ids, texts = (c.slice(i, j - i).to_pylist() for c in columns)
                rows = held + list(zip(part, last, ids, texts, digests([t.encode() for t in texts]), strict=True))
                held = rows[-1:]
                pairs = [(a, b) for a, b in zip(rows, rows[1:], strict=False) if not a[1] and a[0] == b[0]]
                if not pairs:
                    continue
                edited = [(a[3][: len(a[3]) - len(a[3]) // 3] + b[3][: len(a[3]) // 3]).encode() for a, b in pairs]
                own, other = np.stack([a[4] for a, _ in pairs]), np.stack([b[4] for _, b in pairs])
                changed = digests(edited)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a[2] for a, _ in pairs], pa.int64()),
                        pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                        pa.array([x.tobytes().hex() for x in own]),
                        pa.array([x.tobytes().hex() for x in changed]),
                        pa.array(likeness(own, changed)),
                        pa.array(likeness(own, other)),
                    ],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    return deal(docs, parts).mapInArrow(work, schema)
