"""Substring dedup by relative Lempel-Ziv parsing.

The reference of a document is every document with a smaller id. It is indexed
by content: of each 13 consecutive words (a window) one 7-word phrase is an
anchor, the one with the smallest hash, so equal windows have equal anchors,
and the anchors of a text cover it without gaps. A block of the index is a
range of anchor hashes and lies in one task; it holds for each anchor the first
document and position that have it. Every document asks every block that can
hold a match of it, by its anchors, and is then factored greedily: a factor is
a longest run of anchors whose entries continue each other in one reference
document. Windows inside a factor of 13 words or more are duplicates.

Where factors end, the entries name different documents or none, and a window
across the end may still stand in a third document. Such windows, if their
anchor occurs in two documents or more, are looked up whole: by two 64-bit
hashes, in an index of all such windows. A window inside a factor need not be
in that index, since the document it was found in stands for it; so copies of a
passage add little. The result is exact: a word is removed if and only if a
window that covers it also starts in a document with a smaller id.

NULL and empty texts have no words. Rows that share an id never remove each
other's words; a NULL id is smaller than all others. Rows equal in id and text
get the same result. Texts of any length are factored whole; other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclime.llm.common import gram_hashes, id_key, slices, span_hashes, stage, text_bytes, text_key, words_of

WINDOW = 13
#: Words of an anchor. A window has as many anchor places, so anchors leave no gaps.
PHRASE = (WINDOW + 1) // 2
PLACES = WINDOW - PHRASE + 1


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of each run of `width` values, by doubling."""
    have = 1
    while 2 * have <= width:
        values, have = pick(values[:-have], values[have:]), 2 * have
    return pick(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


class Parsed:
    """Words, windows and anchors of texts that lie end to end in one byte array."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data = data
        self.starts, self.stops, self.doc = words_of(data, ends)
        self.first = np.searchsorted(self.doc, np.arange(len(ends) - 1))  # first word of each text
        self.n_words = np.bincount(self.doc, minlength=len(ends) - 1)
        self.words = span_hashes(data, self.starts, self.stops)
        n = len(self.words) - WINDOW + 1
        if n <= 0:
            self.windows, self.least = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            self.anchors, self.anchor_hash = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            return
        phrases = gram_hashes(self.words, PHRASE)
        least = _slide(phrases, PLACES, np.minimum)
        whole = self.doc[:n] == self.doc[WINDOW - 1 :]
        self.windows = np.flatnonzero(whole)  # word numbers at which windows start
        self.least = least[whole]  # hash of each window's anchor
        padded = np.zeros(n + 2 * (PLACES - 1), dtype=np.uint64)
        padded[PLACES - 1 : PLACES - 1 + n] = np.where(whole, least, 0)
        self.anchors = np.flatnonzero((phrases == _slide(padded, PLACES, np.maximum)) & (phrases > 0))
        self.anchor_hash = phrases[self.anchors]

    def place(self, word: np.ndarray) -> np.ndarray:
        """Position in its text of a word number."""
        return word - self.first[self.doc[word]]


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(hash, id, place): the distinct anchors of each document with their first place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            ids = batch.column("id").to_numpy()
            for i, j in slices(ends):
                p = Parsed(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
                doc = p.doc[p.anchors]
                order = np.lexsort((p.anchors, p.anchor_hash, doc))
                d, h = doc[order], p.anchor_hash[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
                own = p.anchors[order[new]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[new].view(np.int64)), pa.array(ids[i + d[new]]), pa.array(p.place(own).astype(np.int32))],
                    names=["hash", "id", "place"],
                )

    return docs.select(id_key().alias("id"), "text").mapInArrow(work, "hash long, id long, place int")


def entries_by_document(docs: DataFrame) -> DataFrame:
    """(id, hashes, sources, places): each document's anchors that two documents or more have, with their first occurrence.

    The index is built by an aggregation, so a phrase that many documents share
    is one row per task before the shuffle; in the join Spark splits it.
    """
    anchors = anchor_rows(docs)
    place = F.struct("id", "place")
    index = stage(
        anchors.groupBy("hash")
        .agg(F.min(place).alias("first"), F.max("id").alias("last"))
        .where("first.id < last")
        .select("hash", F.col("first.id").alias("source"), F.col("first.place").alias("source_place"))
    )
    shared = anchors.select("hash", "id").join(index.hint("merge"), "hash")
    listed = shared.groupBy("id").agg(F.collect_list(F.struct("hash", "source", "source_place")).alias("found"))
    return listed.select(
        "id", F.col("found.hash").alias("hashes"), F.col("found.source").alias("sources"), F.col("found.source_place").alias("places")
    )


def _flat(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _factor(p: Parsed, ids: np.ndarray, known: np.ndarray, source: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word + 1 of the greedy factors of 13 words or more.

    known, source, place: the index entries that the texts met, sorted by hash.
    """
    if not len(known) or not len(p.anchors):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(known, p.anchor_hash), len(known) - 1)
    doc = p.doc[p.anchors]
    match = (known[at] == p.anchor_hash) & (source[at] < ids[doc])
    anchors, at, doc = p.anchors[match], at[match], doc[match]
    if not len(anchors):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shift = place[at] - p.place(anchors)
    joined = (
        (doc[1:] == doc[:-1])
        & (source[at][1:] == source[at][:-1])
        & (shift[1:] == shift[:-1])
        & (anchors[1:] - anchors[:-1] <= PHRASE)
    )
    begin = np.concatenate([[True], ~joined])
    end = np.concatenate([~joined, [True]])
    first, stop = anchors[begin], anchors[end] + PHRASE
    long = stop - first >= WINDOW
    return first[long], stop[long]


def parse(docs: DataFrame) -> DataFrame:
    """(id, text_key, starts, stops, open, h1, h2): factors of each document, and the windows that factors leave open."""
    entries = entries_by_document(docs)
    texts = docs.select(id_key().alias("id"), text_key().alias("text_key"), "text")
    schema = "id long, text_key long, starts array<int>, stops array<int>, open array<int>, h1 array<long>, h2 array<long>"

    def lists(values: np.ndarray, doc: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)), pa.array(values).cast(kind))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            all_ids = batch.column("id").to_numpy()
            for i, j in slices(ends):
                p = Parsed(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
                part = batch.slice(i, j - i)
                known, order = np.unique(_flat(part.column("hashes")).view(np.uint64), return_index=True)
                source, place = _flat(part.column("sources"))[order], _flat(part.column("places"))[order].astype(np.int64)
                first, stop = _factor(p, all_ids[i:j], known, source, place)
                inside = np.zeros(len(p.words) + 1, dtype=np.int64)
                np.add.at(inside, first, 1)
                np.add.at(inside, stop - WINDOW + 1, -1)
                shared = np.isin(p.least, known) if len(known) else np.zeros(len(p.least), dtype=bool)
                windows = p.windows[shared & (np.cumsum(inside)[p.windows] == 0)]
                n, doc = j - i, p.doc[windows]
                h1, h2 = (gram_hashes(p.words, WINDOW, salt)[windows].view(np.int64) for salt in (1, 2))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("text_key"),
                        lists(p.place(first), p.doc[first], n, pa.int32()),
                        lists(p.place(stop - 1) + 1, p.doc[first], n, pa.int32()),
                        lists(p.place(windows), doc, n, pa.int32()),
                        lists(h1, doc, n, pa.int64()),
                        lists(h2, doc, n, pa.int64()),
                    ],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    return texts.join(entries.hint("merge"), "id").mapInArrow(work, schema)


def duplicate_spans(docs: DataFrame) -> DataFrame:
    """(id, text_key, starts, stops, open): factors, and starts of further windows that stand in smaller ids."""
    parsed = stage(parse(docs))
    asked = parsed.select("id", "text_key", F.inline(F.arrays_zip("open", "h1", "h2")))
    key = ["h1", "h2"]
    held = stage(asked.groupBy(*key).agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select(*key, "least"))
    found = asked.join(held.hint("merge"), key).where("id > least").groupBy("id", "text_key").agg(F.collect_set("open").alias("windows"))
    none = F.array().cast("array<int>")
    return (
        parsed.select("id", "text_key", "starts", "stops")
        .join(stage(found).hint("merge"), ["id", "text_key"], "left")
        .where("size(starts) > 0 OR windows IS NOT NULL")
        .select("id", "text_key", "starts", "stops", F.coalesce("windows", none).alias("windows"))
        .dropDuplicates(["id", "text_key"])
    )


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, n_words, n_removed, kept_text, starts, stops (removed word ranges)."""
    spans = stage(duplicate_spans(docs))
    texts = docs.select("doc_id", id_key().alias("id"), text_key().alias("text_key"), "text")
    schema = "doc_id long, n_words long, n_removed long, kept_text string, starts array<int>, stops array<int>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            for i, j in slices(ends):
                own, own_ends = data[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
                rows = batch.slice(i, j - i)
                begin, stop, doc = words_of(own, own_ends)
                count = np.bincount(doc, minlength=j - i)
                first = np.concatenate([[0], np.cumsum(count)])
                raw = own.tobytes()
                out = []
                spans_of = zip(*(rows.column(c).to_pylist() for c in ("starts", "stops", "windows")), strict=True)
                for k, (starts, stops, windows) in enumerate(spans_of):
                    words = [raw[a:b] for a, b in zip(begin[first[k] : first[k + 1]].tolist(), stop[first[k] : first[k + 1]].tolist(), strict=True)]
                    cover = np.zeros(count[k] + 1, dtype=np.int64)
                    if starts or windows:
                        np.add.at(cover, starts, 1)
                        np.add.at(cover, stops, -1)
                        np.add.at(cover, windows, 1)
                        np.add.at(cover, np.array(windows, dtype=np.int64) + WINDOW, -1)
                    gone = np.cumsum(cover) > 0
                    edges = np.diff(np.concatenate([[0], gone.astype(np.int8)]))
                    if gone.any():
                        words = [w for w, g in zip(words, gone.tolist(), strict=False) if not g]
                    out.append((count[k], int(gone.sum()), b" ".join(words), np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)))
                n, removed, kept, a, b = (list(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(n, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array(a, pa.list_(pa.int32())),
                        pa.array(b, pa.list_(pa.int32())),
                    ],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    none = F.array().cast("array<int>")
    joined = texts.join(spans.hint("merge"), ["id", "text_key"], "left")
    return joined.select("doc_id", "text", *[F.coalesce(c, none).alias(c) for c in ("starts", "stops", "windows")]).mapInArrow(work, schema)
