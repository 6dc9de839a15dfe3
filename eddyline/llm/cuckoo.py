"""A cuckoo filter over 64-bit key hashes: approximate membership with deletion.

Four 16-bit fingerprints per bucket; a fingerprint may sit in its first bucket or in the
one that the fingerprint's own hash leads to. No inserted key is ever missed. An unseen
key is reported present with probability about 8 / 65536 at full load.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
MAX_KICKS = 500
MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


class CuckooFilter:
    def __init__(self, keys: int = 0, table: np.ndarray | None = None):
        if table is None:
            buckets = 1
            while buckets * SLOTS * 0.85 < max(keys, 1):
                buckets *= 2
            table = np.zeros((buckets, SLOTS), np.uint16)
        self.table = table

    @classmethod
    def from_bytes(cls, data: bytes) -> "CuckooFilter":
        return cls(table=np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, hashes: np.ndarray):
        mixed = _mixed(hashes.astype(np.uint64, copy=False))
        marks = (mixed & np.uint64(0xFFFF)).astype(np.uint16)
        marks[marks == 0] = 1
        first = ((mixed >> np.uint64(16)) & np.uint64(len(self.table) - 1)).astype(np.int64)
        return marks, first, self._other(first, marks)

    def _other(self, bucket, marks):
        jump = _mixed(np.asarray(marks, np.uint64)) & np.uint64(len(self.table) - 1)
        return np.asarray(bucket) ^ jump.astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        marks, first, second = self._places(hashes)
        wanted = marks[:, None]
        return (self.table[first] == wanted).any(1) | (self.table[second] == wanted).any(1)

    def insert(self, hashes: np.ndarray) -> bool:
        """Adds distinct keys; False if the table is too full (build a larger one)."""
        rng = np.random.default_rng(42)
        for mark, a, b in zip(*self._places(hashes)):
            for bucket in (a, b):
                free = np.flatnonzero(self.table[bucket] == 0)
                if len(free):
                    self.table[bucket, free[0]] = mark
                    break
            else:
                bucket = (a, b)[int(rng.integers(2))]
                for _ in range(MAX_KICKS):
                    slot = int(rng.integers(SLOTS))
                    mark, self.table[bucket, slot] = self.table[bucket, slot], mark
                    bucket = int(self._other(bucket, mark))
                    free = np.flatnonzero(self.table[bucket] == 0)
                    if len(free):
                        self.table[bucket, free[0]] = mark
                        break
                else:
                    return False
        return True

    def delete(self, hashes: np.ndarray) -> None:
        """Removes keys that were inserted; others must not be passed."""
        for mark, a, b in zip(*self._places(hashes)):
            for bucket in (a, b):
                held = np.flatnonzero(self.table[bucket] == mark)
                if len(held):
                    self.table[bucket, held[0]] = 0
                    break


def built(hashes: np.ndarray) -> CuckooFilter:
    """A filter with exactly these distinct keys, as large as it needs to be."""
    room = len(hashes)
    while True:
        found = CuckooFilter(room)
        if found.insert(hashes):
            return found
        room = int(room * 1.5) + 16
