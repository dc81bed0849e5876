"""Counts of byte n-grams within words, by whole-array operations.

A word is bounded by two bytes that UTF-8 never has: ``START`` before it and ``STOP`` after it. A gram
of at most eight bytes is one number, its bytes from the left, most significant first.
"""

from __future__ import annotations

import numpy as np

START, STOP = 0xFE, 0xFF
MOST = 8


def lines(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All words with their bounds as one array of bytes, and where each begins (and the end)."""
    data = np.frombuffer(
        b"".join([b"\xfe%b\xff" % w for w in words]), np.uint8
    ).astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    return data, np.append(0, np.cumsum(sizes))


def grams(data: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places): the gram of ``size`` bytes that ends at each place where one fits its word."""
    if len(data) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = np.zeros(len(data) - size + 1, dtype=np.uint64)
    for i in range(size):
        keys = (keys << np.uint64(8)) | data[i : i + len(keys)]
    ends = np.arange(size - 1, len(data))
    inside = place_in_word(len(data), begins)[ends] >= size - 1
    return keys[inside], ends[inside]


def place_in_word(n: int, begins: np.ndarray) -> np.ndarray:
    return np.arange(n) - np.repeat(begins[:-1], np.diff(begins))


def word_of(n: int, begins: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(begins) - 1), np.diff(begins))


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    first = np.append(0, np.flatnonzero(np.diff(keys)) + 1)
    return keys[first], np.add.reduceat(weights, first)


def find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted table, -1 where they are not in it."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)
