"""Words and rolling hashes of a batch of texts as numpy arrays, straight from Arrow's buffers."""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; a longer word makes its own piece.
PIECE = 1 << 20
_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=8)
def _powers(base: int, length: int) -> np.ndarray:
    steps = np.full(length, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; tables are kept by power-of-two length."""
    return _powers(base, 1 << max(4, (n - 1).bit_length() if n > 1 else 0))[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def space_class() -> np.ndarray:
    """Which bytes belong to words when words end at \\x20 and \\x09-\\x0D."""
    ok = np.ones(256, dtype=bool)
    ok[[0x20, *range(0x09, 0x0E)]] = False
    return ok


class Words(NamedTuple):
    """Words of a batch: byte ranges, document of each word, and each document's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # of length documents + 1
    offsets: np.ndarray  # of length documents + 1, in bytes


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and each text's byte offset; nulls are empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):  # combine_chunks of zero chunks
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.large_string())
    array = array.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    raw = array.buffers()[2] if len(array) else None
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(column: pa.ChunkedArray | pa.Array, in_word: np.ndarray) -> Words:
    """Maximal runs of bytes that ``in_word`` allows, never across texts."""
    data, offsets = text_bytes(column)
    n_docs = len(offsets) - 1
    if not len(data):
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, empty, np.zeros(n_docs + 1, np.int64), offsets)
    inside = in_word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
    edge[offsets] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets).astype(np.int64)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    return Words(data, starts, ends, doc, first, offsets)


@lru_cache(maxsize=4)
def byte_values(in_word: bytes, lower: bool) -> np.ndarray:
    """A random 64-bit value for each byte of a word, 0 for others; ``lower`` folds A-Z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if lower:
        values[0x41:0x5B] = values[0x61:0x7B]
    values[np.frombuffer(in_word, dtype=bool) == 0] = 0
    return values


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of each byte range; bytes between two ranges must have value 0."""
    out = np.empty(len(starts), dtype=np.uint64)
    back = inverse(_BYTE_BASE)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE, side="right")))
        part = values[data[base : ends[j - 1]]]
        part *= powers(_BYTE_BASE, len(part))
        at = starts[i:j] - base
        out[i:j] = np.add.reduceat(part, at) * powers(back, int(at[-1]) + 1)[at]
        i = j
    return mix(out)


def hash_words(words: Words, in_word: np.ndarray, lower: bool = False) -> np.ndarray:
    return hash_runs(words.data, words.starts, words.ends, byte_values(in_word.tobytes(), lower))


def window_hashes(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive word hashes, also those across documents."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    base = _WORD_BASE[which]
    values = hashes if which == 0 else mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, n), out=total[1:])
    return mix((total[size:] - total[:-size]) * powers(inverse(base), n - size + 1))


def window_starts(words: Words, size: int) -> np.ndarray:
    """Word numbers at which a window of ``size`` words lies within one document."""
    if len(words.starts) < size:
        return np.zeros(0, np.int64)
    at = np.arange(len(words.starts) - size + 1)
    return at[words.doc[at] == words.doc[at + size - 1]]
