"""Hashes of all words of many texts at once, without a Python step per word.

A word's hash is the sum of its characters times powers of an odd base, modulo 2^64,
taken as a difference of running sums and brought back to power 0 by the inverse base.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)
_is_word = np.array([chr(c).isalnum() or c == 95 for c in range(1 << 16)])
_is_blank = np.array([chr(c).isspace() for c in range(1 << 16)])
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int):
    if len(_powers[0]) < n:
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(n + n // 4, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def words_of(texts: list[str], blank_separated: bool = False, stem: int = 0):
    """(hashes, stem hashes or None, words per text).

    Words are runs of letters, digits and underscores, or of anything but white space.
    The stem of a word is its first ``stem`` characters and hashes unlike any word.
    """
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "replace"), np.uint32)
    low = np.minimum(codes, 0xFFFF)
    inside = ~_is_blank[low] if blank_separated else _is_word[low]
    lengths = np.array([len(t) for t in texts])
    edges = np.diff(np.concatenate([[False], inside, [False]]).view(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    powers, inverses = _power_tables(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)).astype(np.uint64) * powers[: len(codes)], out=sums[1:])
    hashes = _mixed((sums[ends] - sums[starts]) * inverses[starts])
    stems = None
    if stem:
        stems = _mixed((sums[np.minimum(ends, starts + stem)] - sums[starts]) * inverses[starts] + MIX)
    counts = np.diff(np.searchsorted(starts, np.cumsum([0, *(lengths + 1)])))
    return hashes, stems, counts


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * BASE
    return x ^ (x >> np.uint64(32))
