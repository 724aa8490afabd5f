"""A compact memory of encoded runs: an open-addressed table of 127 bits of hashes with places in one array of ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from .bpe import LibraryEncoder, runs_of


class TableEncoder(LibraryEncoder):
    """``LibraryEncoder`` whose runs are remembered in numpy arrays, some 25 bytes each in place of 200.

    Runs are told apart by 127 of the 128 bits of XXH3 (one marks a used place). The table starts anew when it is half full, so its size is fixed.
    """

    def __init__(self, text: str, bits: int = 22):
        super().__init__(text)
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        n = 1 << self.bits
        self.high, self.low = np.zeros(n, np.uint64), np.zeros(n, np.uint64)  # high 0 is a free slot
        self.offset, self.size = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        self.ids, self.used, self.count = np.zeros(1 << self.bits - 1, np.uint32), 0, 0

    def _find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for those that aren't there."""
        out = np.full(len(high), -1, np.int64)
        left, mask = np.arange(len(high)), np.int64((1 << self.bits) - 1)
        slot = (high >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            here = self.high[slot]
            hit = (here == high[left]) & (self.low[slot] == low[left])
            out[left[hit]] = slot[hit]
            on = ~hit & (here != 0)
            left, slot = left[on], (slot[on] + 1) & mask
        return out

    def _insert(self, high: np.ndarray, low: np.ndarray, offset: np.ndarray, size: np.ndarray) -> None:
        """Add distinct keys that aren't there: of those that meet at a free slot one stays, the others go on."""
        left, mask = np.arange(len(high)), np.int64((1 << self.bits) - 1)
        slot = (high >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.high[slot] == 0)
            self.high[slot[free]] = high[left[free]]  # the last of equals holds
            self.low[slot[free]] = low[left[free]]
            stay = np.zeros(len(left), bool)
            stay[free] = (self.high[slot[free]] == high[left[free]]) & (self.low[slot[free]] == low[left[free]])
            self.offset[slot[stay]] = offset[left[stay]]
            self.size[slot[stay]] = size[left[stay]]
            left, slot = left[~stay], (slot[~stay] + 1) & mask
        self.count += len(high)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        at, runs = runs_of(texts)
        names = runs.dictionary.to_pylist()
        if not names:
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        digest = xxhash.xxh3_128_digest
        hashes = np.frombuffer(b"".join(map(digest, names)), np.uint64).reshape(-1, 2)
        high, low = hashes[:, 0] | np.uint64(1), np.ascontiguousarray(hashes[:, 1])
        if self.count + len(names) > 1 << (self.bits - 1) and self.count:
            self.clear()
        if len(names) > 1 << (self.bits - 1):  # more distinct runs than a table may hold: without it
            return super().encode(texts)
        found = self._find(high, low)
        new = np.flatnonzero(found < 0)
        if len(new):
            ids = self.resolve([names[i] for i in new.tolist()])
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            flat = np.frombuffer(b"".join(ids), "<u4")
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
            self.ids[self.used : self.used + len(flat)] = flat
            self._insert(high[new], low[new], self.used + np.cumsum(size) - size, size)
            self.used += len(flat)
            found[new] = self._find(high[new], low[new])
        which = runs.indices.to_numpy()
        n = self.size[found].astype(np.int64)[which]
        end = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        place = np.repeat(self.offset[found].astype(np.int64)[which] - end[:-1], n)
        place += np.arange(len(place))
        return self.ids[place], end[at[1:]]
