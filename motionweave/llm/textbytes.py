"""Whole texts as bytes in Arrow buffers, taken apart with numpy; no string object per text or word."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (a finaliser of multiplications and shifts)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def offsets_and_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, data) of a string or binary column without missing values; offsets has one more entry than rows."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    n = len(column)
    if n == 0 or where is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    if data is None:
        return at - at[0], np.zeros(0, np.uint8)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0]:at[-1]]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `size` bytes; a longer text is a block of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    size = 1 << max(21, int(n).bit_length())
    up, down = _powers(size)
    return up[:n], down[:n]


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; `span_hash` reads any substring's hash from it."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def _word_tables() -> tuple[np.ndarray, np.ndarray]:
    c = np.arange(256)
    upper = (c >= 65) & (c <= 90)
    word = ((c >= 48) & (c <= 57)) | upper | ((c >= 97) & (c <= 122)) | (c >= 128)
    return word, np.where(upper, c + 32, c).astype(np.uint8)


_IS_WORD, _LOWER = _word_tables()


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, start, end) of every word: runs of ASCII letters (lower-cased), digits and bytes beyond ASCII.

    offsets are those of the rows of one block, data the block's bytes; a word never crosses rows.
    """
    base = offsets[0]
    data = data[base:offsets[-1]]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IS_WORD[data]
    change = inside[1:] != inside[:-1]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets - base] = True
    starts = np.flatnonzero(inside[1:] & (change | cut))
    ends = np.flatnonzero(inside[:-1] & (change | cut))
    prefix = prefix_hash(_LOWER[data])
    rows = np.searchsorted(offsets - base, starts, side="right") - 1
    return span_hash(prefix, starts, ends), rows, starts, ends


def word_starts(offsets: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the lower-cased bytes start..end of a block, counted from the block's first byte."""
    return span_hash(prefix_hash(_LOWER[data[offsets[0]:offsets[-1]]]), start, end)

