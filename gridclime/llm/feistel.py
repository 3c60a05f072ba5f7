"""A keyed permutation of the numbers below any size."""

from __future__ import annotations

import numpy as np

from gridclime.llm.common import mix64


class Feistel:
    """Balanced Feistel network on an even number of bits, with cycle walking.

    The network permutes all numbers of its bits, at most four times ``size``.
    A number that leaves the range is sent through again until it is back in,
    which keeps the map a permutation of 0 .. size - 1. Both directions are
    computed from the key alone.
    """

    def __init__(self, size: int, key: int, rounds: int = 6):
        if size < 0:
            raise ValueError("size is negative")
        self.size, self.key, self.rounds = size, key, rounds
        half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.half, self.mask = np.uint64(half), np.uint64((1 << half) - 1)
        seeds = [(key * 0x9E3779B97F4A7C15 + i) % 2**64 for i in range(1, rounds + 1)]
        self.keys = mix64(np.array(seeds, dtype=np.uint64))

    def _pass(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in keys:
            left, right = right, left ^ (mix64(right + k) & self.mask)
        return (right << self.half) | left  # the halves swap, so that the reversed keys undo it

    def _walk(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        x = np.asarray(x).astype(np.uint64)
        if len(x) and int(x.max()) >= self.size:
            raise ValueError("number outside the permutation")
        out = self._pass(x, keys)
        while len(away := np.flatnonzero(out >= np.uint64(self.size))):
            out[away] = self._pass(out[away], keys)
        return out.astype(np.int64)

    def permute(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys)

    def invert(self, y: np.ndarray) -> np.ndarray:
        return self._walk(y, self.keys[::-1])
