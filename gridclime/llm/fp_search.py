"""Ranked lexical search with trees of frequent terms.

Terms are maximal runs of ASCII letters and digits and of all characters beyond
ASCII, A-Z lower-cased. Items are taken in blocks; one pass over the documents
per block counts each document's terms and those of them that the block's items
hold, its restricted vector. Vectors are stored, and frequencies over all
documents give the weights.

A task then takes its vectors in groups of at most ``GROUP`` documents and builds
a tree of each group: terms of a vector are ordered by document frequency, the
rarest first, so that vectors with equal beginnings share a path. A subtree is a
range of the sorted documents; it has the largest tf of every term in it and the
smallest m, which bound the score of each of its documents for any item. A
depth-first search takes the children of a node by descending bound and leaves
those whose bound is below the score of the item's last hit so far; documents
that are left are scored in whole numbers, a few side by side. Bounds equal to
that score are followed, because ties go to the smaller id. Of rows equal in
vector and m only the first ``top`` ids are searched: the others cannot be hits.
A task gives ``top`` rows per item at most; ranking those is exact.

Each row of the documents is a document. NULL and empty texts have no term and
do not count in N. Repeated ids and rows are ranked side by side; a NULL id
comes after all others of its score. An item of NULL or empty text, or whose
terms stand nowhere, has no rows; repeated items have rows each. Long texts are
read whole, a few MB of a batch at a time. Other columns are ignored. Empty
tables give no rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridclime.llm.common import slices, span_hashes, stage, text_bytes, unstage

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Items and distinct terms of a block: what one pass over the documents serves.
ITEMS, TERMS = 1024, 50_000
#: Documents and terms of a tree.
GROUP, ENTRIES = 16_384, 4_000_000
#: Documents of a range that are scored together.
BUNCH = 64
TOP = 10
NO_ID = 2**63 - 1

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_LOWER_ARRAY = np.frombuffer(_LOWER, dtype=np.uint8)
_INSIDE = np.zeros(256, dtype=bool)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _INSIDE[_a : _b + 1] = True


def terms_of(text: str | None) -> list[str]:
    """The terms of one text, in order, with repeats."""
    return [t.encode().translate(_LOWER).decode() for t in TERM.findall(text or "")]


def _spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text number of the terms of texts that lie end to end."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _INSIDE[data]
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    bounds = ends[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(data))]
    first[bounds] |= inside[1:-1][bounds]
    last[bounds - 1] |= inside[1:-1][bounds - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(ends, starts, side="right") - 1


class Vocabulary:
    """The distinct terms of a block of items, by their 64-bit hashes; matches are compared byte by byte."""

    def __init__(self, terms: list[str]):
        words = [t.encode() for t in terms]
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        stops = np.cumsum([len(w) for w in words])
        hashes = span_hashes(data, stops - [len(w) for w in words], stops)
        order = np.argsort(hashes)
        self.words = [words[i] for i in order]
        self.hashes = hashes[order]

    def find(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The number of each span's term, -1 for other terms."""
        h = span_hashes(data, starts, stops)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        at[self.hashes[at] != h] = -1
        hits = np.flatnonzero(at >= 0)
        _, firsts = np.unique(at[hits], return_index=True)
        joined = data.tobytes()
        for k in hits[firsts].tolist():  # one comparison for each distinct term
            if joined[starts[k] : stops[k]] != self.words[at[k]]:
                raise ValueError("two terms share a 64-bit hash")
        return at


def restricted(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """(doc_id, n, terms, tfs): n counts all terms; the vectors are packed 32-bit numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(words.hashes)
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            for i, j in slices(ends):
                part = _LOWER_ARRAY[data[ends[i] : ends[j]]]
                starts, stops, own = _spans(part, ends[i : j + 1] - ends[i])
                n = np.bincount(own, minlength=j - i)
                found = words.find(part, starts, stops)
                hit = found >= 0
                cell, tf = np.unique(own[hit] * size + found[hit], return_counts=True)
                bounds = np.searchsorted(cell, np.arange(j - i + 1) * size).tolist()
                terms, tfs = (cell % size).astype("<i4").tobytes(), tf.astype("<i4").tobytes()
                cut = list(zip(bounds[:-1], bounds[1:], strict=True))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(i, j - i),
                        "n": pa.array(n, pa.int64()),
                        "terms": pa.array([terms[4 * a : 4 * b] for a, b in cut], pa.binary()),
                        "tfs": pa.array([tfs[4 * a : 4 * b] for a, b in cut], pa.binary()),
                    }
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(work, "doc_id long, n long, terms binary, tfs binary")


def document_frequencies(vectors: DataFrame, size: int) -> DataFrame:
    """(term, df) of the terms that stand in some document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, dtype=np.int64)
        for batch in batches:
            data, _ = text_bytes(batch.column("terms"))
            held += np.bincount(np.frombuffer(data.tobytes(), dtype="<i4"), minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int64()), "n": pa.array(held[at], pa.int64())})

    return vectors.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))


class Tree:
    """The tree of a group of vectors.

    ``terms`` are places in the order of frequency, ascending in each document;
    documents are sorted by them, so a subtree is a range [low, high). Subtrees of
    over ``BUNCH`` documents are nodes of their own; smaller ones that lie side by
    side under a node are bunched, up to so many documents. ``tops`` has for every
    range and term what the term brings at most: its part at the largest tf and the
    smallest m of the range.
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, offsets: np.ndarray, terms: np.ndarray, tfs: np.ndarray, size: int, bunch: int = BUNCH):
        self.ids, self.m, self.offsets, self.terms, self.tfs = ids, m, offsets, terms, tfs
        self.part = (1_000_000_000 * tfs) // (1000 * tfs + 8 * np.repeat(m, np.diff(offsets)))
        self.low, self.high, self.kids = [0], [len(ids)], [[]]
        self._grow(self._shared(), bunch)
        self.tops = np.zeros((len(self.low), size), dtype=np.int32)
        for v, (a, b) in enumerate(zip(self.low, self.high, strict=True)):
            if b > a:
                tf = np.zeros(size, dtype=np.int64)
                np.maximum.at(tf, terms[offsets[a] : offsets[b]], tfs[offsets[a] : offsets[b]])
                self.tops[v] = (1_000_000_000 * tf) // (1000 * tf + 8 * int(m[a:b].min()))

    def _shared(self) -> np.ndarray:
        """Terms that each document shares, from the start on, with the one before it."""
        lengths = np.diff(self.offsets)
        least = np.minimum(lengths[1:], lengths[:-1])
        out = np.zeros(len(lengths), dtype=np.int64)
        if least.sum():
            steps = np.arange(least.sum()) - np.repeat(np.cumsum(least) - least, least)
            differ = self.terms[np.repeat(self.offsets[:-2], least) + steps] != self.terms[np.repeat(self.offsets[1:-1], least) + steps]
            at = np.where(differ, steps, np.iinfo(np.int64).max)
            some = least > 0
            out[1:][some] = np.minimum(np.minimum.reduceat(at, (np.cumsum(least) - least)[some]), least[some])
        return out

    def _grow(self, shared: np.ndarray, bunch: int) -> None:
        """Split each large node where its documents part: behind the path that all of them share."""

        def add(a: int, b: int, parent: int) -> None:
            self.kids[parent].append(len(self.low))
            self.low.append(a)
            self.high.append(b)
            self.kids.append([])

        waiting = [0] if len(self.ids) else []
        while waiting:
            v = waiting.pop()
            a, b = self.low[v], self.high[v]
            depth = shared[a + 1 : b].min(initial=np.iinfo(np.int64).max)
            cuts = [a, *(np.flatnonzero(shared[a + 1 : b] <= depth) + a + 1).tolist(), b]
            start = a  # of the bunch that is being filled
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                if high - start > bunch:
                    if low > start:
                        add(start, low, v)
                    start = low
                if high - low > bunch:
                    add(low, high, v)
                    waiting.append(len(self.low) - 1)
                    start = high
            if b > start:
                add(start, b, v)

    def search(self, at: np.ndarray, w: np.ndarray, weights: np.ndarray, best: list[tuple[int, int]], top: int) -> None:
        """Put the hits of an item into ``best``, a heap of (score, -id) of ``top`` entries at most.

        ``at`` are the item's terms and ``w`` their weights; ``weights`` has a
        number for every term, 0 where the item lacks it.
        """
        stack = [(np.iinfo(np.int64).max, 0)] if len(at) and len(self.ids) else []  # the bound of a node, and it
        while stack:
            bound, v = stack.pop()
            if len(best) == top and bound < best[0][0]:
                continue
            if not self.kids[v]:
                self._score(self.low[v], self.high[v], weights, best, top)
                continue
            kids = np.array(self.kids[v])
            bounds = self.tops[np.ix_(kids, at)].astype(np.int64) @ w
            good = np.flatnonzero(bounds >= (best[0][0] if len(best) == top else 1))
            stack += [(int(bounds[k]), int(kids[k])) for k in good[np.argsort(bounds[good], kind="stable")]]

    def _score(self, a: int, b: int, weights: np.ndarray, best: list[tuple[int, int]], top: int) -> None:
        """Scores of all documents of a range."""
        first, last = self.offsets[a], self.offsets[b]
        scores = np.add.reduceat(weights[self.terms[first:last]] * self.part[first:last], self.offsets[a:b] - first)
        for k in np.flatnonzero(scores >= (best[0][0] if len(best) == top else 1)).tolist():
            entry = (int(scores[k]), -int(self.ids[a + k]))
            if len(best) < top:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)


def grown(ids: np.ndarray, m: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], size: int, top: int) -> Tree:
    """The tree of documents given by id, m and (terms, tfs), terms ascending and none empty.

    Of documents equal in vector and m the ``top`` smallest ids are kept.
    """
    keys = [(t.astype(">u4").tobytes(), f.astype(">u4").tobytes(), x) for (t, f), x in zip(vectors, m.tolist(), strict=True)]
    order = sorted(range(len(keys)), key=lambda i: (keys[i], ids[i]))
    kept, same = [], 0
    for k, i in enumerate(order):
        same = same + 1 if k and keys[i] == keys[order[k - 1]] else 0
        if same < top:
            kept.append(i)
    offsets = np.concatenate([[0], np.cumsum([len(vectors[i][0]) for i in kept])]).astype(np.int64)
    terms = np.concatenate([vectors[i][0] for i in kept]).astype(np.int64)
    tfs = np.concatenate([vectors[i][1] for i in kept]).astype(np.int64)
    return Tree(ids[kept], m[kept], offsets, terms, tfs, size)


def hits(vectors: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], place: np.ndarray, total: int, terms_total: int, top: int) -> DataFrame:
    """(item, doc_id, score): for each item the best ``top`` documents of each task.

    ``queries``: (places of the item's terms, ascending, and their weights);
    ``place`` is the place of a term in the order of frequency, -1 if it stands
    in no document or in no item.
    """
    size = int(place.max(initial=-1)) + 1

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        ids, m, held, entries = [], [], [], 0

        def close() -> None:
            nonlocal ids, m, held, entries
            if held:
                tree = grown(np.array(ids, dtype=np.int64), np.array(m, dtype=np.int64), held, size, top)
                weights = np.zeros(size, dtype=np.int64)
                for (at, w), found in zip(queries, best, strict=True):
                    weights[at] = w
                    tree.search(at, w, weights, found, top)
                    weights[at] = 0
            ids, m, held, entries = [], [], [], 0

        for batch in batches:
            docs = batch.column("doc_id").fill_null(NO_ID).to_pylist()
            counts = batch.column("n").to_pylist()
            for doc, n, t, f in zip(docs, counts, batch.column("terms"), batch.column("tfs"), strict=True):
                at = place[np.frombuffer(t.as_buffer(), dtype="<i4")]
                order = np.argsort(at, kind="stable")
                order = order[np.searchsorted(at[order], 0) :]
                if not len(order):
                    continue
                ids.append(doc)
                m.append(10 + (90 * n * total) // terms_total)
                held.append((at[order], np.frombuffer(f.as_buffer(), dtype="<i4")[order]))
                entries += len(order)
                if len(ids) >= GROUP or entries >= ENTRIES:
                    close()
        close()
        rows = [(i, None if -d == NO_ID else -d, s) for i, found in enumerate(best) for s, d in found]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["item", "doc_id", "score"])

    return vectors.where("length(terms) > 0").mapInArrow(search, "item int, doc_id long, score long")


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """(item_id, terms) in blocks of bounded size; they pass through the driver, as queries do."""
    block, terms, cells = [], set(), 0
    for row in items.select("item_id", "text").toLocalIterator():
        own = sorted(set(terms_of(row["text"])))
        cells += len(own)
        if block and (len(block) >= ITEMS or len(terms) + len(own) > TERMS or cells > 10 * TERMS):
            yield block
            block, terms, cells = [], set(), len(own)
        block.append((row["item_id"], own))
        terms.update(own)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    found = []
    for block in _blocks(items):
        terms = sorted({t for _, own in block for t in own})
        if not terms:
            continue
        words = Vocabulary(terms)
        vectors = stage(restricted(docs, words))
        sums = vectors.where("n > 0").agg(F.count("*").alias("total"), F.sum("n").alias("terms")).first()
        if not sums["total"]:
            unstage(vectors)
            continue
        weight = F.floor(1000 * F.ln(F.lit(2.0 * sums["total"] + 2) / (2 * F.col("df") + 1))).cast("long")
        counted = stage(document_frequencies(vectors, len(terms)).select("term", "df", weight.alias("w")))
        rows = counted.orderBy("df", "term").collect()  # one per term of the block
        place = np.full(len(terms), -1, dtype=np.int64)
        place[[r["term"] for r in rows]] = np.arange(len(rows))
        weights = np.array([r["w"] for r in rows], dtype=np.int64)
        number = {w.decode(): i for i, w in enumerate(words.words)}
        queries = []
        for _, own in block:
            at = np.sort(place[[number[t] for t in own]])
            at = at[at >= 0]
            queries.append((at, weights[at]))
        hit = hits(vectors, queries, place, sums["total"], sums["terms"], top)
        by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = hit.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item int, item_id {kind}")
        found.append(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))  # a block's items
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
