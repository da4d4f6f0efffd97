"""Hash map from non-negative 64-bit keys to 64-bit values, in numpy arrays, looked up for whole arrays."""

from __future__ import annotations

import numpy as np

ABSENT = -1
#: Odd 64-bit multiplier of the hash.
MIX = np.uint64(0x9E3779B97F4A7C15)


class IntMap:
    """Open addressing with linear probing; at most half full."""

    def __init__(self, room: int = 16):
        self._make(max(16, room))

    def _make(self, room: int) -> None:
        bits = max(5, int(room * 2).bit_length())
        self.size, self.shift, self.mask = 0, np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, ABSENT, np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MIX) >> self.shift).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not there yet."""
        if (self.size + len(keys)) * 2 > len(self.keys):
            held = self.keys >= 0
            old = self.keys[held], self.values[held]
            self._make(2 * (self.size + len(keys)))
            self.add(*old)
        slot, open_ = self._slot(keys), np.arange(len(keys))
        while len(open_):
            free = open_[self.keys[slot[open_]] < 0]
            self.keys[slot[free]] = keys[free]  # of those that want one slot the last stays
            won = self.keys[slot[open_]] == keys[open_]
            self.values[slot[open_[won]]] = values[open_[won]]
            open_ = open_[~won]
            slot[open_] = (slot[open_] + 1) & self.mask
        self.size += len(keys)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, ``ABSENT`` where a key is not there."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], ABSENT)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out
