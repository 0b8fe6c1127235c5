"""Vectorized text kernels that run inside Spark tasks (numpy over Arrow batches).

A *block* is a run of texts laid out back to back: ``data`` (uint8) and
``offsets`` (int64, one more than texts).  Blocks hold about ``BLOCK_BYTES``
bytes, or one text if that is longer, so a task's memory does not grow with
its partition.  Null texts are empty.

Words are ``[^\\x20\\x09-\\x0D]+``: runs of non-space bytes.  UTF-8 never uses
the space bytes inside a character, so byte runs are the character runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 256 << 10  # the arrays of a block (8 bytes a byte of text) stay in cache

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_rng = np.random.Generator(np.random.PCG64(20240101))
#: A random 64-bit value per byte, and the odd base of the polynomial hash.
BYTE_VALUE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """``BASE**i`` (or its inverse) modulo 2**64 for i < n; kept per worker up to
    one block's length, so that a single huge text does not pin its table."""
    key = "inv" if inverse else "pow"
    have = _powers.get(key)
    if have is None or len(have) < n:
        base = BASE_INV if inverse else BASE
        have = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 2 * BLOCK_BYTES:
            _powers[key] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finalizer (a bijection of uint64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def blocks(texts: pa.Array | pa.ChunkedArray, lower: bool = False,
           block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, data, offsets) of consecutive blocks of a text column."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if lower:
        texts = pc.utf8_lower(texts)
    n = len(texts)
    if n == 0:
        return
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + block_bytes, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray,
          separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (byte positions) of every word, and words per text."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets) - 1, np.int64)
    word = ~separator[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each word, the same wherever the word stands."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(BYTE_VALUE[data] * powers(len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(len(data) + 1, inverse=True)[starts])


def window_hashes(h: np.ndarray, counts: np.ndarray, width: int,
                  mask: tuple[int, ...] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word windows that lie inside one text.

    ``mask`` names the word offsets that count (default: all).  Returns the
    hashes, the index of each window's first word, and windows per text.
    """
    per = np.maximum(counts - (width - 1), 0)
    if len(h) < width or per.sum() == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), per
    m = len(h) - width + 1
    out = np.zeros(m, dtype=np.uint64)
    for k in (mask if mask is not None else range(width)):
        out += h[k:k + m] * (BYTE_VALUE[k % 256] | np.uint64(1))
    first = np.cumsum(counts) - counts
    at = np.arange(int(per.sum()), dtype=np.int64) + np.repeat(first - (np.cumsum(per) - per), per)
    return mix(out[at]), at, per


def rows_of(counts: np.ndarray) -> np.ndarray:
    """Text index of each element, from elements per text."""
    return np.repeat(np.arange(len(counts)), counts)
