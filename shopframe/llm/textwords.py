"""Words of Arrow text columns as numpy arrays: positions and 64-bit hashes.

A word is a run of bytes other than 0x20 and 0x09-0x0D. UTF-8 never uses those
bytes inside a longer character, so splitting bytes is splitting the text.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240607))
#: A random 64-bit value per byte; words are hashed as polynomials over these.
BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
BASE, SEQ, GRAM = (int(x) | 1 for x in _RNG.integers(2**62, 2**63, 3, dtype=np.uint64))
LOWER = np.arange(256)
LOWER[65:91] += 32
IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def worker_memory(name: str) -> dict:
    """A dictionary that lasts as long as the Python worker, whichever task asks."""
    module = sys.modules.setdefault("_llm_worker_memory", types.ModuleType("_llm_worker_memory"))
    return module.__dict__.setdefault(name, {})


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def base_powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least n of each."""
    kept = worker_memory("powers")
    if base not in kept or len(kept[base][0]) < n:
        n = max(n, 1 << 16)
        kept[base] = powers(base, n), powers(pow(base, -1, 2**64), n)
    return kept[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]: off[-1]] if len(off) else buf, off - off[0]


def pieces(off: np.ndarray, limit: int = 1 << 20):
    """Ranges of rows that hold about ``limit`` bytes, or one longer row."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_bounds(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words; no word crosses a row."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    w = IS_WORD[buf]
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(buf))]
    first[cut] = w[cut]
    last[cut - 1] = w[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray, table: np.ndarray = BYTE,
                base: int = BASE, block: int = 1 << 18) -> np.ndarray:
    """64-bit hash of the bytes of each span [s, e); spans are in order of start."""
    out = np.empty(len(s), np.uint64)
    lo = 0
    while lo < len(s):
        at = int(s[lo])
        hi = max(lo + 1, int(np.searchsorted(s, at + block, "left")))
        end = int(e[lo:hi].max())
        pw, inv = base_powers(base, end - at + 1)
        c = np.zeros(end - at + 1, np.uint64)
        np.cumsum(table[buf[at:end]] * pw[: end - at], out=c[1:])
        i, j = s[lo:hi] - at, e[lo:hi] - at
        out[lo:hi] = (c[j] - c[i]) * inv[i] + (e[lo:hi] - s[lo:hi]).astype(np.uint64)
        lo = hi
    return mix(out)


def words_of(buf: np.ndarray, off: np.ndarray, lower: bool = False):
    """(word hashes, starts, ends, first word of each row and the end)."""
    s, e = word_bounds(buf, off)
    h = span_hashes(buf, s, e, BYTE[LOWER] if lower else BYTE)
    return h, s, e, np.searchsorted(s, off)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values (n - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    pw = powers(GRAM, k)
    g = np.zeros(n, np.uint64)
    for t in range(k):
        g += h[t: t + n] * pw[t]
    return mix(g)
