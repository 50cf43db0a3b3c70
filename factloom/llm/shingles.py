"""Distinct word shingles of whole texts, as 64-bit hashes, for a block of texts at a time.

A word's hash is xxh3 of its bytes, a shingle's a mix of a random-coefficient sum of its words' hashes: two different shingles have
equal hashes with a chance of 2**-64, also where they are made of alike words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from factloom.llm.textscan import BLOCK_BYTES, mix, window_hashes


class WordHashes(dict):
    """64-bit hashes of words, kept while there are at most ``LIMIT``."""

    LIMIT = 1 << 16

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_sets(texts: list[bytes | None], n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row of each shingle counted from the first, hashes): sorted, distinct for each row.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z (what bytes.lower and bytes.split do); a text of fewer than ``n`` words,
    but not none, has its whole sequence as one shingle.
    """
    known, first = WordHashes(), 0
    while first < len(texts):
        words: list[bytes] = []
        counts, end, size = [], first, 0
        while end < len(texts) and (end == first or size < BLOCK_BYTES):
            own = (texts[end] or b"").lower().split()
            words += own
            counts.append(len(own))
            size += len(texts[end] or b"")
            end += 1
        yield first, end, *_shingles(known.of(words), np.array(counts), n)
        first = end


def _shingles(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([[0], np.cumsum(counts)])
    row_of = np.repeat(np.arange(len(counts)), counts)
    h = window_hashes(words, n)
    rows = row_of[: len(h)]
    whole = rows == row_of[n - 1 :] if len(h) else np.zeros(0, bool)
    h, rows = h[whole], rows[whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        value = np.zeros(len(short), np.uint64)
        for j in range(n - 1):
            has = counts[short] > j
            value[has] = mix(value[has] * np.uint64(3) + words[at[short[has]] + j] + np.uint64(j + 1))
        h, rows = np.concatenate([h, value]), np.concatenate([rows, short])
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return rows[new], h[new]


def sums_by(values: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct groups, sums of values modulo 2**64) for sorted groups."""
    if not len(groups):
        return groups, values
    start = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    return groups[start], np.add.reduceat(values, start)
