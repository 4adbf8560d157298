"""Token ids of text units (pieces of text a tokenizer treats independently),
each distinct unit encoded once per worker while it stays in a bounded cache.
Units are told apart by a 64-bit hash of their bytes."""

from __future__ import annotations

from itertools import chain

import numpy as np

from lodestone.llm.common import span_hash

MAX_UNITS = 200_000              # cached units per worker; the cache starts anew beyond


class UnitCache:
    """Hashes are looked up in an open-addressing table of numpy arrays (linear probing, at
    most half full), all units of a call at once."""

    def __init__(self, encode, max_units: int = MAX_UNITS):
        """``encode``: list of units (bytes) -> list of id sequences."""
        self.encode, self.max_units = encode, max_units
        self._reset()

    def __len__(self) -> int:
        return self.have

    def _reset(self):
        self.have = 0
        self.hash = np.zeros(1024, np.uint64)
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used = np.zeros(4096, np.int32), 0
        self._table(4096)

    def _table(self, size: int) -> None:
        """An empty table of ``size`` (a power of two) places, filled with the units at hand."""
        self.mask = np.int64(size - 1)
        self.key, self.slot = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        self._place(self.hash[:self.have], 0)

    def _home(self, hashes: np.ndarray) -> np.ndarray:
        return hashes.view(np.int64) & self.mask

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 for those not held."""
        at = self._home(hashes)
        slots = self.slot[at]
        on = np.flatnonzero((self.key[at] != hashes) & (slots >= 0))
        at = at[on]
        while len(on):
            at = (at + 1) & self.mask
            slots[on] = self.slot[at]
            more = (self.key[at] != hashes[on]) & (slots[on] >= 0)
            on, at = on[more], at[more]
        return slots

    def _place(self, hashes: np.ndarray, first: int) -> None:
        """Enter distinct hashes not held yet as slots ``first``, ``first`` + 1, ..."""
        at, left = self._home(hashes), np.arange(len(hashes))
        while len(left):
            free = left[self.slot[at[left]] < 0]
            self.slot[at[free]] = first + free              # of several at one place the last stays
            got = free[self.slot[at[free]] == first + free]
            self.key[at[got]] = hashes[got]
            left = left[self.slot[at[left]] != first + left]
            at[left] = (at[left] + 1) & self.mask

    def _add(self, hashes: np.ndarray, units: list[bytes]) -> None:
        coded = self.encode(units)
        n, have = len(units), self.have
        lens = np.fromiter(map(len, coded), np.int64, n)
        flat = np.fromiter(chain.from_iterable(coded), np.int32, int(lens.sum()))
        while have + n > len(self.start):
            self.start, self.length, self.hash = (
                np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.length, self.hash))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(flat)] = flat
        self.length[have:have + n] = lens
        self.start[have:have + n] = self.used + np.cumsum(lens) - lens
        self.hash[have:have + n] = hashes
        self.used += len(flat)
        self.have += n
        size = len(self.slot)
        while 2 * self.have > size:
            size *= 2
        if size > len(self.slot):
            self._table(size)
        else:
            self._place(hashes, have)

    def ids(self, padded: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """(ids of all units in order, ids per unit)."""
        if len(starts) == 0:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if self.have > self.max_units:
            self._reset()
        hashes = span_hash(padded, starts, ends)
        slots = self._find(hashes)
        new = np.flatnonzero(slots < 0)
        if len(new):
            uniq, at, inverse = np.unique(hashes[new], return_index=True, return_inverse=True)
            have = self.have
            self._add(uniq, [padded[a:b].tobytes() for a, b in
                             zip(starts[new[at]].tolist(), ends[new[at]].tolist(), strict=True)])
            slots[new] = have + inverse
        return self._expand(slots)

    def _expand(self, slots: np.ndarray):
        n = self.length[slots]
        before = np.cumsum(n) - n
        index = np.repeat(self.start[slots] - before, n) + np.arange(int(n.sum()))
        return self.pool[index], n
