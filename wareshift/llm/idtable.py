"""Remembered ids of text units, in numpy arrays of fixed size."""

from __future__ import annotations

import numpy as np


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes begin[i] .. begin[i]+size[i]-1, one run after another."""
    if not len(size):
        return np.zeros(0, np.int64)
    total = np.cumsum(size)
    return np.arange(total[-1]) + np.repeat(begin - (total - size), size)


class IdTable:
    """Ids by 128-bit fingerprint.  A slot holds one unit (a later one takes
    an earlier one's place) and points into a flat buffer of ids; a full
    buffer starts the table anew.  Memory: 28 bytes a slot and the buffer."""

    def __init__(self, dtype: np.dtype, bits: int = 19, ids: int = 1 << 22):
        self.bits, self.dtype, self.room = bits, dtype, ids
        self._clear()

    def _clear(self) -> None:
        n = 1 << self.bits
        self.key = np.zeros(n, np.uint64)
        self.other = np.zeros(n, np.uint64)
        self.begin = np.zeros(n, np.int64)
        self.size = np.full(n, -1, np.int32)
        self.buffer = np.zeros(self.room, self.dtype)
        self.used = 0

    def find(self, key: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which units are known, and their ids' places in ``buffer``."""
        slot = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        size = self.size[slot]
        known = (size >= 0) & (self.key[slot] == key) & (self.other[slot] == other)
        return known, self.begin[slot], size.astype(np.int64)

    def put(self, key: np.ndarray, other: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        if len(flat) > self.room:
            return
        if self.used + len(flat) > self.room:
            self._clear()
        self.buffer[self.used : self.used + len(flat)] = flat
        # of units that share a slot the last one stays, with all its fields
        slot = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        last = len(slot) - 1 - np.unique(slot[::-1], return_index=True)[1]
        slot = slot[last]
        self.key[slot], self.other[slot] = key[last], other[last]
        self.begin[slot] = (self.used + np.cumsum(size) - size)[last]
        self.size[slot] = size[last]
        self.used += len(flat)

    def ids(self, key: np.ndarray, other: np.ndarray, compute) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat, begin, size): unit i's ids are flat[begin[i]:][:size[i]].
        ``compute(places)`` gives the ids, one run after another, and the
        sizes of the units not known."""
        known, begin, size = self.find(key, other)
        have = np.flatnonzero(known)
        flat = self.buffer[ragged(begin[have], size[have])]
        begin[have] = np.cumsum(size[have]) - size[have]
        new = np.flatnonzero(~known)
        if len(new):
            fresh, sizes = compute(new)
            size[new] = sizes
            begin[new] = len(flat) + np.cumsum(sizes) - sizes
            self.put(key[new], other[new], fresh, sizes)
            flat = np.concatenate([flat, fresh])
        return flat, begin, size
