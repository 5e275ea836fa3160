"""Cuckoo filters as numpy tables: approximate sets of 128-bit keys that can also forget a key.

A key is two 64-bit numbers. Its fingerprint, 16 bits and never 0, stands in one of two buckets of four
slots; the second bucket follows from the first and the fingerprint, so a fingerprint can be moved without
its key. A key that was added is always found; one that was not is found with a chance of about 8 / 2**16.
"""

from __future__ import annotations

import numpy as np

from loomset.llm import flat

SLOTS = 4
#: moves of one insertion before the table counts as full
_MOVES = 200


def _places(low: np.ndarray, high: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mark = (low & np.uint64(0xFFFF)).astype(np.uint16)
    mark[mark == 0] = 1
    mask = np.uint64(buckets - 1)
    first = high & mask
    return mark, first.astype(np.int64), (first ^ (flat.mixed(mark.astype(np.uint64)) & mask)).astype(np.int64)


class CuckooFilter:
    """A table of ``buckets`` (a power of two) times four fingerprints."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def of(cls, low: np.ndarray, high: np.ndarray) -> CuckooFilter:
        """A filter of these distinct keys, at most three quarters full."""
        buckets = 1
        while buckets * SLOTS * 3 < len(low) * 4:
            buckets *= 2
        while True:
            made = cls(buckets)
            if made.add(low, high):
                return made
            buckets *= 2

    @classmethod
    def read(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(table), table)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def contains(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each key may be in the set; never false for one that is."""
        mark, first, second = _places(low, high, self.buckets)
        return ((self.table[first] == mark[:, None]) | (self.table[second] == mark[:, None])).any(axis=1)

    def add(self, low: np.ndarray, high: np.ndarray) -> bool:
        """Add keys that are not in the set. False if the table is too full; it is then of no more use."""
        mask = self.buckets - 1
        mark, first, second = _places(low, high, self.buckets)
        other = (flat.mixed(np.arange(1 << 16, dtype=np.uint64)) & np.uint64(mask)).astype(np.int64).tolist() if len(mark) else []
        rows = self.table.tolist()
        for m, a, b in zip(mark.tolist(), first.tolist(), second.tolist()):
            for at in (a, b):
                if 0 in rows[at]:
                    rows[at][rows[at].index(0)] = m
                    break
            else:
                at = b
                for turn in range(_MOVES):
                    slot = turn % SLOTS
                    m, rows[at][slot] = rows[at][slot], m
                    at ^= other[m]
                    if 0 in rows[at]:
                        rows[at][rows[at].index(0)] = m
                        break
                else:
                    return False
        self.table = np.array(rows, np.uint16).reshape(self.buckets, SLOTS)
        return True

    def remove(self, low: np.ndarray, high: np.ndarray) -> None:
        """Forget keys that are in the set, one fingerprint each."""
        for m, a, b in zip(*(x.tolist() for x in _places(low, high, self.buckets))):
            at = a if (self.table[a] == m).any() else b
            slot = np.flatnonzero(self.table[at] == m)
            if not len(slot):
                raise ValueError("a key that is not in the filter cannot be removed")
            self.table[at, slot[0]] = 0
