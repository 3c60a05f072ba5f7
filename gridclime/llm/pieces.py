"""SentencePiece encoding and decoding by suffix-array matching.

A text is encoded as the library does it for a BPE model: blanks become the
space mark, one mark is put before a text that isn't empty, and of all adjacent
pieces whose join is a piece the best-scored one is joined, the leftmost of
equals, until none is left. Characters that are no piece become byte pieces.

A batch is cut before each run of marks, which no piece of such a model crosses
(it is checked when the model is read). The distinct segments of a batch are
laid end to end; the suffix array of that text is sorted as deep as the longest
piece, and a binary search of every piece in it gives the range of its
occurrences. The occurrences are the edges of a lattice; sorted by position
they form a table (position, length) -> piece, and relaxing it joins, in each
step and in all segments at once, the pair with the best edge.

Segments seen before are taken from a bounded memory, which has no influence on
the result. NULL texts have NULL ids, empty texts have no ids. Decoding restores
every text, but for the space mark itself, which becomes a blank as in the
library. Texts of any length are encoded whole, repeated rows each. All other
columns stay, but one named like the result, which is replaced. An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclime.llm.common import Memory, encode_segments, slices, text_bytes

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Segments kept in memory by a worker, and characters of segments that are matched at once.
MEMORY, CHARS = 300_000, 1_000_000
NONE = -1
#: Code points are moved up by one, so that 0 is free
_SHIFT = 1


class Pieces:
    """A model's pieces, and encoding and decoding with them."""

    def __init__(self, proto: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        ids = range(model.get_piece_size())
        if not all(model.is_byte(model.piece_to_id(f"<0x{b:02X}>")) for b in range(256)):
            raise ValueError("the model has no byte pieces")
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        names = {i: model.id_to_piece(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in names.values()):
            raise ValueError("a piece crosses the beginning of a word")
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        self.longest = max(map(len, names.values()))
        self.ids = np.array(plain, dtype=np.int32)
        self.lengths = np.array([len(names[i]) for i in plain])
        self.codes = np.zeros((len(plain), self.longest), dtype=np.int64)
        for row, i in enumerate(plain):
            self.codes[row, : len(names[i])] = [ord(c) + _SHIFT for c in names[i]]
        # Ranks of scores: equal scores have equal ranks; joins need a rank above zero.
        scores = np.array([model.get_score(i) for i in plain])
        self.rank = np.zeros(len(ids) + 1, dtype=np.int32)
        self.rank[self.ids] = np.unique(scores, return_inverse=True)[1] + 1
        self.bytes_of = np.empty(len(ids), dtype=object)
        self.bytes_of[:] = b""
        for i, p in names.items():
            self.bytes_of[i] = p.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids.tolist()):
            self.bytes_of[i] = bytes([b])
        self.memory = Memory(np.int32, MEMORY)

    # Matching

    def suffixes(self, text: np.ndarray) -> np.ndarray:
        """Positions of a text (code points, 0 between segments) in the order of what follows, as deep as the longest piece."""
        n = len(text)
        present = np.zeros(0x110000 + _SHIFT, dtype=bool)
        present[text] = True
        present[0] = True
        dense = (np.cumsum(present) - 1)[text]  # the characters at hand, numbered in order
        bits = max(1, int(present.sum() - 1).bit_length())
        depth = min(self.longest, 63 // bits)
        tail = np.concatenate([dense, np.zeros(depth, dtype=np.int64)])
        key = tail[:n].copy()
        for d in range(1, depth):
            key = key << bits | tail[d : n + d]
        while True:
            order = np.argsort(key)
            if depth >= self.longest:
                return order
            ranked = key[order]
            step = np.concatenate([[1], (ranked[1:] != ranked[:-1]).astype(np.int64)])
            rank = np.zeros(n + depth, dtype=np.int64)
            rank[order] = np.cumsum(step)
            key = rank[:n] << 32 | rank[depth : depth + n]
            depth *= 2

    def edges(self, text: np.ndarray) -> np.ndarray:
        """Table (position, length) -> id of the piece that occurs there: all occurrences, sorted by position."""
        order = self.suffixes(text)
        padded = np.concatenate([text, np.zeros(self.longest, dtype=text.dtype)])
        low, high = np.zeros(len(self.ids), dtype=np.int64), np.full(len(self.ids), len(order), dtype=np.int64)
        for depth in range(self.longest):
            at = np.flatnonzero((self.lengths > depth) & (low < high))
            if not len(at):
                break
            code = self.codes[at, depth]
            bounds = [_search(padded, order, depth, code, low[at], high[at], side) for side in (False, True)]
            low[at], high[at] = bounds
        count = np.where(low < high, high - low, 0)
        total = int(count.sum())
        which = np.repeat(np.arange(len(count)), count)
        within = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        table = np.full((len(text) + 1, self.longest + 1), NONE, dtype=np.int32)
        table[order[low[which] + within], self.lengths[which]] = self.ids[which]
        return table

    # Relaxing

    def match(self, segments: list[bytes]) -> list[bytes]:
        """Ids, as bytes, of distinct segments."""
        joined = b"".join(segments)
        flat = np.frombuffer(joined, dtype=np.uint8)
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        lengths = np.add.reduceat(flat & 0xC0 != 0x80, np.cumsum(sizes) - sizes, dtype=np.int64)  # in characters
        starts = np.cumsum(lengths + 1) - lengths - 1
        text = np.zeros(int((lengths + 1).sum()), dtype=np.int64)
        own = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        codes = np.frombuffer(joined.decode().encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        codes[codes == 0x20] = ord(MARK)
        text[own] = codes + _SHIFT
        table = self.edges(text)
        out = [b""] * len(segments)
        width = np.where(lengths <= 32, -(-lengths // 4) * 4, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        for w in np.unique(width):
            group = np.flatnonzero(width == w)
            for part in np.array_split(group, max(1, len(group) * int(w) // 2_000_000)):
                self._join(table, text, starts[part], lengths[part], int(w), part, out)
        return out

    def _join(self, table, text, starts, lengths, width, numbers, out) -> None:
        """Join pairs in segments of one width, the best pair of every segment in each step."""
        n, limit = len(starts), self.longest
        size = (np.arange(width + 1) < lengths[:, None]).astype(np.int32)  # characters of the symbol that starts here
        steps = np.arange(width + 1, dtype=np.int32)
        after = np.minimum(steps + 1, lengths[:, None].astype(np.int32))  # start of the next symbol
        before = np.tile(steps - 1, (n, 1))
        gain = np.zeros((n, width + 1), dtype=np.int32)
        at = starts[:, None] + np.arange(width + 1)
        pair = np.arange(width + 1) + 2 <= lengths[:, None]
        gain[pair] = self.rank[table[at[pair], 2]]
        live = np.arange(n)
        while len(live):
            best = gain[live].argmax(axis=1)
            more = gain[live, best] > 0
            live, best = live[more], best[more]
            if not len(live):
                break
            gone = after[live, best]
            follow = after[live, gone]
            size[live, best] += size[live, gone]
            size[live, gone] = 0
            gain[live, gone] = 0
            after[live, best] = follow
            before[live, follow] = best
            for left, right in ((best, follow), (before[live, best], best)):
                ok = (left >= 0) & (right < lengths[live])
                rows, l, r = live[ok], left[ok], right[ok]
                span = size[rows, l] + size[rows, r]
                fits = span <= limit
                value = np.zeros(len(rows), dtype=np.int32)
                value[fits] = self.rank[table[starts[rows[fits]] + l[fits], span[fits]]]
                gain[rows, l] = value
            ended = best[follow >= lengths[live]]
            gain[live[follow >= lengths[live]], ended] = 0
        row, column = np.nonzero(size)
        ids = table[starts[row] + column, np.minimum(size[row, column], limit)]
        bounds = np.searchsorted(row, np.arange(n + 1))
        unknown = np.flatnonzero(ids == NONE)
        bad = set(row[unknown].tolist())
        packed, edges = ids.tobytes(), (bounds * ids.itemsize).tolist()
        for k, number in enumerate(numbers.tolist()):
            out[number] = packed[edges[k] : edges[k + 1]]
        for k in bad:
            own = slice(bounds[k], bounds[k + 1])
            codes = text[starts[row[own]] + column[own]]
            parts = [[i] if i != NONE else self.byte_ids[list(chr(c - _SHIFT).encode())] for i, c in zip(ids[own].tolist(), codes.tolist(), strict=True)]
            out[numbers[k]] = np.concatenate(parts).astype(np.int32).tobytes()

    # Texts

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of UTF-8 texts that lie end to end, and where the ids of each text end."""
        n = len(ends) - 1
        filled = np.diff(ends) > 0
        raw = data.tobytes()
        blank = bytes([0x20])
        texts = [raw[a:b].replace(MARK.encode(), blank) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        joined = b"".join(blank + t for t, f in zip(texts, filled.tolist(), strict=True) if f)
        flat = np.frombuffer(joined, dtype=np.uint8)
        sizes = np.array([len(t) + 1 if f else 0 for t, f in zip(texts, filled.tolist(), strict=True)], dtype=np.int64)
        text_starts = np.cumsum(sizes) - sizes
        is_blank = flat == 0x20
        head = is_blank.copy()
        head[1:] &= ~is_blank[:-1]
        head[text_starts[filled]] = True
        starts = np.flatnonzero(head)
        ids, running = encode_segments(joined, starts, self.memory, self.encode_bytes)
        return ids, running[np.searchsorted(starts, np.append(text_starts, len(flat)))]

    def encode_bytes(self, segments: list[bytes]) -> list[bytes]:
        """Ids of distinct segments, in groups of bounded size."""
        out, group, size = [], [], 0
        for k, s in enumerate(segments):
            group.append(s)
            size += len(s) + 1
            if size >= CHARS or k == len(segments) - 1:
                out += self.match(group)
                group, size = [], 0
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes_of[ids].tolist()).removeprefix(b" ") if len(ids) else b""


def _search(text, order, depth, code, low, high, right) -> np.ndarray:
    """First places in ranges of the suffix array whose character at a depth is not less (or is greater)."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        value = text[order[middle] + depth]
        go = value <= code[open_] if right else value < code[open_]
        low[open_[go]] = middle[go] + 1
        high[open_[~go]] = middle[~go]


def load(spark, path: str = MODEL) -> bytes:
    """The model's bytes, read on the driver: a local path, or one that Spark reads. A model is of fixed size."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as file:
        return file.read()


_held: dict[int, Pieces] = {}


def held(proto: bytes) -> Pieces:
    """The model in this worker."""
    key = hash(proto)
    if key not in _held:
        _held.clear()
        _held[key] = Pieces(proto)
    return _held[key]


def encode(docs: DataFrame, path: str = MODEL, text: str = "text", name: str = "piece_ids") -> DataFrame:
    """All columns and ``piece_ids`` (array<int>). No shuffle; a task holds one batch."""
    shipped = docs.sparkSession.sparkContext.broadcast(load(docs.sparkSession, path))

    @F.arrow_udf("array<int>")
    def of(column: pa.Array) -> pa.Array:
        pieces = held(shipped.value)
        data, ends = text_bytes(column)
        done = [pieces.encode(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i]) for i, j in slices(ends, 3 << 20)]
        values = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int32)
        shift = np.cumsum([0] + [len(d[0]) for d in done])
        bounds = np.concatenate([[0]] + [d[1][1:] + s for d, s in zip(done, shift, strict=False)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values), mask=column.is_null() if column.null_count else None)

    return docs.withColumn(name, of(text))


def decode(df: DataFrame, path: str = MODEL, ids: str = "piece_ids", name: str = "decoded") -> DataFrame:
    """All columns and the text of the ids."""
    shipped = df.sparkSession.sparkContext.broadcast(load(df.sparkSession, path))

    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        pieces = held(shipped.value)
        values, bounds = column.values.to_numpy(), column.offsets.to_numpy().tolist()
        valid = column.is_valid().to_pylist()
        spans = zip(bounds, bounds[1:], valid, strict=False)
        return pa.array([pieces.decode(values[a:b]) if v else None for a, b, v in spans], pa.string())

    return df.withColumn(name, of(ids))
