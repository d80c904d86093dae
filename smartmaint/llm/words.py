"""Words of many texts at once, on their UTF-8 bytes (numpy, for Python workers).

A word is a maximal run of bytes that are digits, letters a-z after
lower-casing A-Z, or above 0x7F: the code-point class
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of the lower-cased text, since every
byte of a non-ASCII character is above 0x7F.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True

_rng = np.random.default_rng(20240131)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
LONG_WORD = 4096  # bytes; longer words are hashed one by one
_POWER = np.cumprod(np.full(LONG_WORD, _BASE, np.uint64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and its row offsets into them (null: empty)."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = pa.compute.fill_null(column, "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def word_bounds(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and how many words precede each row (length: rows + 1)."""
    edge = np.zeros(len(raw) + 1, bool)  # a row starts here
    edge[rows] = True
    word = IS_WORD[raw]
    starts = np.flatnonzero(word & (edge[:-1] | ~np.concatenate(([False], word[:-1])))) if len(raw) else np.empty(0, int)
    ends = np.flatnonzero(word & (edge[1:] | ~np.concatenate((word[1:], [False])))) + 1 if len(raw) else np.empty(0, int)
    return starts, ends, np.searchsorted(starts, rows, "left")


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each lower-cased word."""
    out = np.empty(len(starts), np.uint64)
    lens = ends - starts
    total = np.concatenate(([0], np.cumsum(np.minimum(lens, LONG_WORD))))
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(total, total[i] + chunk, "right")) - 1)
        n = np.minimum(lens[i:j], LONG_WORD)
        first = np.cumsum(n) - n
        pos = np.arange(int(n.sum())) - np.repeat(first, n)
        v = _BYTE[LOWER[raw[pos + np.repeat(starts[i:j], n)]]]
        v *= _POWER[pos]
        h = np.add.reduceat(v, first)
        h ^= n.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        out[i:j] = h
        i = j
    for i in np.flatnonzero(lens > LONG_WORD):
        import xxhash
        out[i] = xxhash.xxh64_intdigest(LOWER[raw[starts[i]:ends[i]]].tobytes())
    return out
