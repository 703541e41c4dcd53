"""Sorted hash arrays that are memory-mapped: several in one file, looked up by bucket and 32 further bits.

An array's entries are in order of their 64-bit hashes. An index over the top
bits, about one step for sixteen entries, leads to a bucket; within it entries
keep the next 32 bits only. Rows of numbers are stored as one byte, the place
among the array's most frequent rows; other rows stand in a side table by the
entry's place.
"""

from __future__ import annotations

import json

import numpy as np

from .store_files import mapped

#: entries that a step of the index leads to, and the byte that sends to the side table
STEP, OTHER = 16, 255


def bundle(arrays: dict[str, np.ndarray]) -> np.ndarray:
    """Named arrays as one array of bytes, each at a multiple of 8."""
    held, at = [], 0
    for name, a in arrays.items():
        held.append((name, a.dtype.str, a.shape, at))
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(held).encode()
    head += b" " * (-len(head) % 8)
    out = np.zeros(8 + len(head) + at, np.uint8)
    out[:8] = np.frombuffer(np.array([len(head)], np.int64).tobytes(), np.uint8)
    out[8: 8 + len(head)] = np.frombuffer(head, np.uint8)
    for (_, _, _, place), a in zip(held, arrays.values(), strict=True):
        place += 8 + len(head)
        out[place: place + a.nbytes] = np.frombuffer(np.ascontiguousarray(a).tobytes(), np.uint8)
    return out


def opened(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a stored bundle, memory-mapped."""
    m = np.asarray(mapped(folder, name))
    size = int(m[:8].view(np.int64)[0])
    out = {}
    for key, dtype, shape, at in json.loads(m[8: 8 + size].tobytes()):
        n = int(np.prod(shape)) * np.dtype(dtype).itemsize
        out[key] = m[8 + size + at: 8 + size + at + n].view(dtype).reshape(shape)
    return out


def _rows(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the rows, the rows that bytes stand for, and places and rows of the others."""
    if not len(values):
        return np.zeros(0, np.uint8), values[:0], np.zeros(0, np.uint32), values[:0]
    mixed = np.zeros(len(values), np.uint64)
    for c in values.T:
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64)
    _, at, back, often = np.unique(mixed, return_index=True, return_inverse=True, return_counts=True)
    top = np.argsort(-often, kind="stable")[:OTHER]
    code = np.full(len(at), OTHER, np.uint8)
    code[top] = np.arange(len(top))
    code = code[back]
    code[(values != values[at[back]]).any(axis=1)] = OTHER  # rows that only mix alike
    rest = np.flatnonzero(code == OTHER)
    return code, values[at[top]], rest.astype(np.uint32), values[rest]


def table(name: str, h: np.ndarray, values: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays that hold rows of numbers by their hashes; without rows there are none."""
    if not len(h):
        return {}
    order = np.argsort(h)
    h = h[order]
    bits = max(1, (len(h) // STEP).bit_length())
    index = np.searchsorted(h >> np.uint64(64 - bits), np.arange(2**bits + 1, dtype=np.uint64)).astype(np.uint32)
    code, common, place, rest = _rows(values[order])
    kind = np.min_scalar_type(int(rest.max(initial=0)))
    return {f"{name}.index": index, f"{name}.rest": ((h << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32), f"{name}.code": code,
            f"{name}.common": common, f"{name}.place": place, f"{name}.other": rest.astype(kind)}


def found(arrays: dict[str, np.ndarray], name: str, h: np.ndarray, width: int) -> np.ndarray:
    """The rows of numbers of hashes, zero where there is none."""
    out = np.zeros((len(h), width), np.int64)
    if f"{name}.index" not in arrays or not len(h):
        return out
    index, rest = arrays[f"{name}.index"], arrays[f"{name}.rest"]
    bits = (len(index) - 1).bit_length() - 1
    bucket, want = (h >> np.uint64(64 - bits)).astype(np.int64), ((h << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    lo, end = index[bucket].astype(np.int64), index[bucket + 1].astype(np.int64)
    n = end - lo
    while n.any():  # halves every bucket at once
        half = n >> 1
        right = (n > 0) & (rest[np.minimum(lo + half, len(rest) - 1)] < want)
        lo = np.where(right, lo + half + 1, lo)
        n = np.where(right, n - half - 1, half)
    hit = np.flatnonzero((lo < end) & (rest[np.minimum(lo, len(rest) - 1)] == want))
    at = lo[hit]
    code = arrays[f"{name}.code"][at]
    common = arrays[f"{name}.common"]
    out[hit] = common[np.minimum(code, len(common) - 1)]
    other = code == OTHER
    if other.any():
        out[hit[other]] = arrays[f"{name}.other"][np.searchsorted(arrays[f"{name}.place"], at[other])]
    return out
