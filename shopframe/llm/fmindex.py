"""Operator 2, substring dedup with FM-indexes.

A window of 35 words is repeated if its words also start anywhere else. The
candidates (``anchors``) are dealt into shards; a shard builds an FM-index of
its segments: suffixes sorted by prefix doubling, the Burrows-Wheeler transform
in a wavelet matrix (bit planes with popcounts, no pointers), and a text's
segments are streamed through it from their ends. Backward search gives the
interval of suffixes that start with the current window; for the window one
word earlier the interval is widened to the suffixes that share all but the
last word, and one backward step follows. The weight of an interval is the
number of places where its window stands; windows above the threshold (two) are
reported as intervals.

Words are compared by 64-bit hashes. A null text has no words, repeated rows
are repeated text, texts shorter than a window lose nothing, an empty table
gives no rows, other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .anchors import Kind, Piece, repeated, runs_of
from .common import Work
from .textwords import word_bounds

WIDTH, GRAM_WORDS = 35, 6


class WaveletMatrix:
    """Rank of symbols in a sequence, by bit planes with a popcount per 64 bits."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.planes, self.blocks, self.zeros = [], [], []
        for shift in range(self.bits - 1, -1, -1):
            bit = ((seq >> shift) & 1).astype(np.uint8)
            packed = np.packbits(np.append(bit, np.zeros(128 - len(bit) % 64, np.uint8)), bitorder="little").view(np.uint64)
            self.planes.append(packed)
            self.blocks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(len(bit) - int(bit.sum()))
            one = bit.astype(bool)
            seq = np.concatenate([seq[~one], seq[one]])
        self.start = self._descend(np.zeros(n_symbols, np.int64), np.arange(n_symbols))

    def _descend(self, i: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for plane, block, zeros, shift in zip(self.planes, self.blocks, self.zeros, range(self.bits - 1, -1, -1), strict=True):
            at = i >> 6
            ones = block[at] + np.bitwise_count(plane[at] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))
            i = np.where((symbol >> shift) & 1, zeros + ones, i - ones)
        return i

    def rank(self, i: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._descend(i, symbol) - self.start[symbol]


class FMIndex:
    """Backward search over sequences of 64-bit symbols, for patterns of at most ``width`` symbols."""

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray, width: int):
        length = np.array([len(s) for s in sequences])
        self.first = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
        n = int((length + 1).sum())
        self.alphabet, symbol = np.unique(np.concatenate(sequences), return_inverse=True)
        self.text = np.zeros(n, np.int64)  # 0 closes a sequence
        owner = np.repeat(np.arange(len(sequences)), length + 1)
        inner = np.ones(n, bool)
        inner[self.first + length] = False
        self.text[inner] = symbol + 1
        # suffixes by their first symbols: 1, 2, 4, ... until more than a pattern
        ranks, size = [np.unique(self.text, return_inverse=True)[1]], 1
        while size <= width:
            key = ranks[-1] * n
            key[: n - size] += ranks[-1][size:] + 1 if n > size else 0
            ranks.append(np.unique(key, return_inverse=True)[1])
            size *= 2
        sa = np.argsort(ranks[-1], kind="stable")
        n_symbols = len(self.alphabet) + 1
        bwt = self.text[sa - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=n_symbols))])
        self.wavelet = WaveletMatrix(bwt, n_symbols)
        self.weight = np.concatenate([[0], np.cumsum(weights[owner[sa]])])
        # rows that share all but the last symbol of a pattern
        same, at, left = np.ones(n - 1, bool), 0, width - 1
        for level in range(len(ranks) - 1, -1, -1):
            if left >= 1 << level:
                place = np.minimum(sa + at, n)
                r = np.append(ranks[level], -1)[place]
                same &= r[1:] == r[:-1]
                at, left = at + (1 << level), left - (1 << level)
        edge = np.flatnonzero(~same) + 1
        group = np.zeros(n, np.int64)
        group[edge] = 1
        group = np.cumsum(group)
        self.group, self.group_lo = group, np.concatenate([[0], edge])
        self.group_hi = np.append(edge, n)

    def step(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with one more symbol in front."""
        c = self.before[symbol]
        return c + self.wavelet.rank(lo, symbol), c + self.wavelet.rank(hi, symbol)

    def widen(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        g = self.group[lo]
        return self.group_lo[g], self.group_hi[g]


def window_weights(sequences: list[np.ndarray], weights: np.ndarray, width: int) -> list[np.ndarray]:
    """For every window of every sequence the weight of its occurrences in all sequences."""
    index = FMIndex(sequences, weights, width)
    windows = np.array([len(s) - width + 1 for s in sequences])
    order = np.argsort(-windows, kind="stable")
    first, left = index.first[order], windows[order]
    out = np.zeros((len(order), int(left[0])), np.int64)
    at = first + left - 1  # the current window's start
    lo, hi = np.zeros(len(order), np.int64), np.full(len(order), len(index.text))
    for t in range(width - 1, -1, -1):
        lo, hi = index.step(lo, hi, index.text[at + t])
    for k in range(int(left[0])):
        live = int(np.searchsorted(-left, -k, "left"))  # sequences with more than k windows
        if k:
            lo, hi = index.widen(lo[:live])
            lo, hi = index.step(lo, hi, index.text[at[:live] - k])
        out[np.arange(live), left[:live] - 1 - k] = index.weight[hi[:live]] - index.weight[lo[:live]]
    result: list[np.ndarray] = [out[0]] * len(order)
    for row, i in enumerate(order.tolist()):
        result[i] = out[row, : windows[i]]
    return result


def _ship(lists: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
    for rows in lists:
        yield pa.RecordBatch.from_arrays([pa.array([r.shard for r in rows], pa.int32()), pa.array([r.segment for r in rows], pa.int64()), pa.array([r.weight for r in rows], pa.int64()),
                                          pa.array([r.window for r in rows], pa.int32()), pa.array([r.symbols for r in rows], pa.binary())], names=["shard", "segment", "weight", "window", "symbols"])


def _find(width: int):
    def run(table: pa.Table) -> pa.Table:
        sequences = [np.frombuffer(x, np.uint64) for x in table.column("symbols").to_pylist()]
        found = window_weights(sequences, table.column("weight").to_numpy(), width)
        rows = [(s, w + a, w + b) for s, w, f in zip(table.column("segment").to_pylist(), table.column("window").to_pylist(), found, strict=True) for a, b in zip(*runs_of(f >= 2), strict=True)]
        c = list(zip(*rows, strict=True)) if rows else [[]] * 3
        return pa.table({"segment": pa.array(c[0], pa.int64()), "a": pa.array(c[1], pa.int32()), "b": pa.array(c[2], pa.int32())})
    return run


def _describe(data: np.ndarray, runs: np.ndarray) -> tuple[int, int, int, str]:
    """Words, removed words, removed runs, and the hash of the kept words joined by spaces."""
    text = data.tobytes()
    if not len(runs):
        words = text.split()
        return len(words), 0, 0, hashlib.sha256(b" ".join(words)).hexdigest()
    s, e = word_bounds(data, np.array([0, len(data)]))
    keep = np.ones(len(s), bool)
    for a, b in runs:
        keep[a:b] = False
    kept = [text[i:j] for i, j in zip(s[keep].tolist(), e[keep].tolist(), strict=True)]
    return len(s), int((~keep).sum()), len(runs), hashlib.sha256(b" ".join(kept)).hexdigest()


def substring_dedup(docs: DataFrame, work: Work, width: int = WIDTH, gram: int = GRAM_WORDS, shard_symbols: int = 1 << 20,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, cls, n, n_removed, n_spans, kept_sha256): one row per document."""
    kind = Kind(True, width, gram, shard_symbols)
    return repeated(docs, work, kind, _ship, "shard int, segment long, weight long, window int, symbols binary", _find(width), _describe, id_col, text_col)
