"""Quality classifier: random-indexing word vectors, pooled, then a two-layer network.

Each word has a slot, by its hash. Each slot has a sparse random index vector of
a few +1 and -1. The context vector of a slot is the sum of the index vectors of
the words at its occurrences in the whole corpus: itself and two neighbours to
either side. The corpus is read once for them; sums are whole numbers, so they
do not depend on the order of rows. The vectors have a fixed number of slots and
dimensions, whatever the size of the corpus.

A document is the mean and the spread of its words' vectors, weighted down for
frequent words. A network of two layers, fitted in numpy on a bounded sample of
labelled documents, gives a score, which a temperature, fitted on labelled
documents that the network has not seen, turns into a calibrated probability.

A text without words (NULL, empty or blank) has zero vectors and gets the score
of those. Labels that are NULL, or for ids that are not in the table, are not
used; an id with several labels is used once. Without labels of both kinds the
score is their share, or 0.5 without any. Of several labels of an id the least counts. Texts of
any length are read whole, repeated rows are scored each, other columns stay. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclime.llm.common import mix64, slices, span_hashes, text_bytes, words_of

SLOTS, DIMENSIONS, ENTRIES, REACH = 16_384, 64, 4, 2
#: The most labelled documents that the network is fitted on, chosen by a hash of the id.
SAMPLE = 15_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 256, 3e-3, 1e-4
THRESHOLD = 0.7

_cells = mix64(np.arange(1, SLOTS * ENTRIES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)).reshape(SLOTS, ENTRIES)
#: Dimension and sign of the entries of each slot's index vector.
_WHERE = (_cells % np.uint64(DIMENSIONS)).astype(np.int64)
_SIGN = np.where(_cells >> np.uint64(40) & np.uint64(1), 1, -1).astype(np.int64)


def held_out(column: str = "doc_id") -> Column:
    """Documents whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def slots_in(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and text number of every word of texts that lie end to end."""
    starts, stops, text = words_of(data, ends)
    return (span_hashes(data, starts, stops) % np.uint64(SLOTS)).astype(np.int64), text


def context_sums(slots: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Sums of index vectors around the occurrences of each slot: SLOTS x DIMENSIONS."""
    cells, signs = [], []
    for apart in range(REACH + 1):
        near = np.flatnonzero(text[: len(text) - apart] == text[apart:])
        pairs = [(slots[near], slots[near + apart])]
        if apart:
            pairs.append(pairs[0][::-1])
        for word, other in pairs:
            cells.append((word[:, None] * DIMENSIONS + _WHERE[other]).ravel())
            signs.append(_SIGN[other].ravel())
    flat = np.concatenate(cells)
    plus = np.concatenate(signs) > 0
    size = SLOTS * DIMENSIONS
    return (np.bincount(flat[plus], minlength=size) - np.bincount(flat[~plus], minlength=size)).reshape(SLOTS, DIMENSIONS)


def corpus_sums(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Context sums and counts of all slots over the whole corpus.

    Each task adds up its texts and sends a row per slot; the sums come to the
    driver, SLOTS rows in all.
    """
    names = [f"d{i}" for i in range(DIMENSIONS)]
    schema = "slot int, n long, " + ", ".join(f"{c} int" for c in names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((SLOTS, DIMENSIONS), dtype=np.int64), np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            for i, j in slices(ends):
                slots, text = slots_in(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
                if len(slots):
                    sums += context_sums(slots, text)
                    counts += np.bincount(slots, minlength=SLOTS)
        met = np.flatnonzero(counts)
        columns = [pa.array(met, pa.int32()), pa.array(counts[met])]
        columns += [pa.array(sums[met, d], pa.int32()) for d in range(DIMENSIONS)]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "n", *names])

    parts = docs.select("text").mapInArrow(work, schema)
    found = parts.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).toPandas()
    sums, counts = np.zeros((SLOTS, DIMENSIONS)), np.zeros(SLOTS)
    at = found["slot"].to_numpy()
    sums[at], counts[at] = found[names].to_numpy(), found["n"].to_numpy()
    return sums, counts


def word_vectors(sums: np.ndarray, counts: np.ndarray, damping: float = 1e-3) -> np.ndarray:
    """Unit context vectors, less what all words have in common, weighted down for frequent slots; 32-bit."""
    total = max(counts.sum(), 1)
    unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    unit -= (unit * counts[:, None]).sum(axis=0) / total
    return (unit * (damping / (damping + counts / total))[:, None]).astype(np.float32)


def pooled(data: np.ndarray, ends: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word vectors of each text; zeros for a text without words."""
    out = np.zeros((len(ends) - 1, 2 * DIMENSIONS))
    for i, j in slices(ends, 1 << 20):
        slots, text = slots_in(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i])
        if not len(slots):
            continue
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        n = np.diff(np.append(first, len(text)))[:, None]
        rows = vectors[slots]
        mean = np.add.reduceat(rows, first, axis=0, dtype=np.float64) / n
        square = np.add.reduceat(rows * rows, first, axis=0, dtype=np.float64) / n
        out[i + text[first], :DIMENSIONS] = mean
        out[i + text[first], DIMENSIONS:] = np.sqrt(np.maximum(square - mean * mean, 0))
    return out


@dataclass
class Network:
    """score = sigmoid((tanh(((x - center) / scale) @ w1 + b1) @ w2 + b2) / temperature)."""

    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.center) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Mini-batch Adam on the log loss, from a fixed seed."""
    rng = np.random.default_rng(seed)
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - center) / scale
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN)]
    p.append(np.array(np.log(share / (1 - share))))
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for rows in np.array_split(rng.permutation(len(z)), max(1, len(z) // BATCH)):
            xb, hidden = z[rows], np.tanh(z[rows] @ p[0] + p[1])
            error = (1 / (1 + np.exp(-(hidden @ p[2] + p[3]))) - y[rows]) / len(rows)
            back = np.outer(error, p[2]) * (1 - hidden**2)
            grads = [xb.T @ back + DECAY * p[0], back.sum(axis=0), hidden.T @ error + DECAY * p[2], error.sum()]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Network(center, scale, p[0], p[1], p[2], float(p[3]))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, on a fine grid."""
    grid = np.exp(np.linspace(np.log(0.2), np.log(8), 200))
    loss = [np.mean(np.logaddexp(0, np.where(y == 1, -1, 1) * logits / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors of the whole corpus, and the calibrated network.

    At most ``sample`` labelled documents come to the driver, as pooled vectors.
    """
    spark = docs.sparkSession
    vectors = word_vectors(*corpus_sums(docs))
    usable = labels.where(~held_out() & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = (
        usable.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
        .withColumn("draw", F.xxhash64("doc_id", F.lit(3)))
        .orderBy("draw", "doc_id")
        .limit(sample)
    )
    shipped = spark.sparkContext.broadcast(vectors)

    @F.pandas_udf("array<float>")
    def pool(column: pd.Series) -> pd.Series:
        data, ends = text_bytes(pa.array(column, pa.string()))
        return pd.Series(list(pooled(data, ends, shipped.value).astype(np.float32)))

    # The sample is bounded by its parameter, so it goes to every task.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    found = texts.select("doc_id", "quality", "draw", pool("text").alias("x")).toPandas()
    found = found.drop_duplicates("doc_id").sort_values(["draw", "doc_id"])
    y = found["quality"].to_numpy(np.float64)
    if len(np.unique(y)) < 2:
        share = float(y.mean()) if len(y) else 0.5
        zero, flat = np.zeros(2 * DIMENSIONS), np.clip(share, 1e-6, 1 - 1e-6)
        return vectors, Network(zero, zero + 1, np.zeros((2 * DIMENSIONS, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), float(np.log(flat / (1 - flat))))
    x = np.stack(found["x"].to_numpy()).astype(np.float64)
    apart = np.arange(len(y)) % 5 == 4  # these calibrate
    if len(np.unique(y[~apart])) < 2 or len(np.unique(y[apart])) < 2:
        return vectors, fit_network(x, y)
    network = fit_network(x[~apart], y[~apart])
    network.temperature = fit_temperature(network.logits(x[apart]), y[apart])
    return vectors, network


def score(docs: DataFrame, vectors: np.ndarray, network: Network, name: str = "score") -> DataFrame:
    """All columns and the probability of label 1, from the text alone."""
    shipped = docs.sparkSession.sparkContext.broadcast((vectors, network))

    @F.arrow_udf("double")
    def of(column: pa.Array) -> pa.Array:
        table, model = shipped.value
        data, ends = text_bytes(column)
        return pa.array(model.score(pooled(data, ends, table)))

    return docs.withColumn(name, of("text"))
