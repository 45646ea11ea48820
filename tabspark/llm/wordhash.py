"""Vectorised words and word hashes of an Arrow batch of texts.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D (the pattern
``[^\\x20\\x09-\\x0D]+``; the separators are ASCII, so bytes and characters agree).  A word's
64-bit hash is a polynomial over its bytes modulo 2^64, mixed; a gram's hash is
a polynomial over the hashes of its words.  All of it is numpy over whole
batches: some ten nanoseconds a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

# Odd multipliers of the polynomials.
BYTE_STEP = 0x9E3779B97F4A7C15
WORD_STEP = 0xD6E8FEB86659FD93
SLICE_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_STEP))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array without nulls."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1]
    at = at.astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of texts with at most ``most`` bytes together (a longer text by itself)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


class Words:
    """The words of texts: ``start``, ``end`` (bytes) and ``doc`` of each, and ``first`` (n + 1 word positions by text)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = IS_WORD[data]
        n = len(data)
        opens, closes = inside.copy(), inside.copy()
        if n:
            heads, tails = offsets[:-1], offsets[1:]
            full = heads < tails
            before = np.empty(n, dtype=bool)
            before[0], before[1:] = False, inside[:-1]
            before[heads[full]] = False
            after = np.empty(n, dtype=bool)
            after[-1], after[:-1] = False, inside[1:]
            after[tails[full] - 1] = False
            opens &= ~before
            closes &= ~after
        self.data, self.offsets = data, offsets
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets, "left")
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        size = self.end - self.start
        if not len(size):
            return np.zeros(0, np.uint64)
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        powers = np.cumprod(np.full(int(size.max()), BYTE_STEP, dtype=np.uint64))
        codes = BYTE_HASH[self.data[place + np.repeat(self.start, size)]] * powers[place]
        return mix(np.add.reduceat(codes, first) + size.astype(np.uint64))

    def room(self, k: int) -> np.ndarray:
        """Whether k words of the same text begin at each word."""
        return np.arange(len(self.start)) + k <= self.first[self.doc + 1]


def grams(word_hashes: np.ndarray, k: int, step: int = WORD_STEP) -> np.ndarray:
    """Hash of the k words from each position on (past the end: of fewer; mask with ``room``)."""
    out = word_hashes.copy()
    for j in range(1, k):
        out *= np.uint64(step)
        out[:max(0, len(out) - j)] += word_hashes[j:]
    return mix(out)
