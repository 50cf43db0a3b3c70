"""Vectorised scanning of UTF-8 text columns: whole Arrow batches are tokenised and hashed with numpy.

Texts of a batch lie one after another in one byte buffer; nothing here crosses a text's end. Buffers are cut
into blocks of whole texts so that temporary arrays stay small; a single very long text is one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = (1 << 20) - 64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def bytes_and_offsets(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and the n + 1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive runs of whole texts."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@lru_cache(4)
def _powers_to(n: int, base: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _powers_to(1 << max(16, (n - 1).bit_length()), base)[:n]


@lru_cache(8)
def byte_values(seed: int) -> np.ndarray:
    """A random odd 64-bit value for each byte."""
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def prefix_sums(data: np.ndarray, seed: int) -> np.ndarray:
    """Prefix sums of value(byte) * multiplier**position: any substring's polynomial hash is a difference of two."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values(seed)[data] * powers(len(data), _MULTIPLIER), out=out[1:]) if len(data) else None
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end), equal for equal bytes at any place."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums), _INVERSE)[starts] + (ends - starts).astype(np.uint64))


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal word runs inside texts, and for each text the index of its first word (n + 1)."""
    before = np.zeros(len(is_word), bool)
    before[1:] = is_word[:-1]
    inner = offsets[:-1][offsets[:-1] < len(is_word)]
    before[inner] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.zeros(len(is_word), bool)
    after[:-1] = is_word[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(is_word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def window_hashes(words: np.ndarray, n: int, multiplier: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hashes of each n consecutive words (those that start too near the end are missing); windows may cross texts."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - n + 1].copy()
    for j in range(1, n):
        out *= np.uint64(multiplier)
        out += words[j : len(words) - n + 1 + j]
    return mix(out)


def lower_table(keep) -> bytes:
    """A bytes.translate table: A-Z become a-z; bytes that ``keep`` rejects become a space."""
    return bytes((b + 32 if 65 <= b <= 90 else b) if keep(b + 32 if 65 <= b <= 90 else b) else 32 for b in range(256))
