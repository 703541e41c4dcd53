"""Supports of candidate itemsets from vertical bitmaps.

Baskets are dealt to groups of (segment, salt), so a large segment spans many
tasks. Each group's rows meet in one task in this order: first the candidates of
the segment, then its baskets. Candidates come by prefix: a row ``(prefix,
lasts)`` stands for all sets ``prefix + [x, y]`` with x before y in ``lasts``.

The task reads baskets in chunks of at most ``CHUNK_ROWS`` rows and
``CHUNK_ITEMS`` entries (a longer basket is a chunk of its own) and turns a
chunk on its side. An item in at least one row of 64 becomes a bitmap, which
takes at most 8 bytes an entry; rarer items keep the sorted list of their rows.
The rows of ``prefix + [x]`` are the intersection of their bitmaps or lists, and
the supports of all extensions y are counted at once: frequent rows by bitmap
intersections and bit counts, few rows by counting the items of just these
rows. No pair or triple of a basket is ever listed, so a basket of any length
costs memory in proportion to its items. Weights (equal baskets counted once)
are counted by their binary digits.

The functions run in Spark's Python workers and are shipped by value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_ROWS, CHUNK_ITEMS = 1 << 15, 1 << 20
#: entries of a (segment, salt) group
GROUP_ITEMS = 1 << 22


class Chunk:
    """Baskets turned on their side; items are codes from 0."""

    def __init__(self, row: np.ndarray, item: np.ndarray, weight: np.ndarray, n_items: int):
        self.weight, self.n_items = weight, n_items
        self.words = -(-len(weight) // 64)
        by_item = np.lexsort((row, item))
        self.row, item = row[by_item], item[by_item]
        self.first = np.searchsorted(item, np.arange(n_items + 1))
        size = np.diff(self.first)
        self.is_dense = size * 64 >= len(weight)
        self.slot = np.cumsum(self.is_dense) - 1
        self.bits = np.zeros((int(self.is_dense.sum()), self.words), np.uint64)
        mine = self.is_dense[item]
        r = self.row[mine]
        at = self.slot[item[mine]] * self.words + (r >> 6)
        head = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
        if len(head):
            self.bits.reshape(-1)[at[head]] = np.bitwise_or.reduceat(np.uint64(1) << (r & 63).astype(np.uint64), head)
        self.thin_row, self.thin_item = self.row[~mine], item[~mine]
        # the baskets themselves, for sets with few rows
        by_row = np.argsort(self.row, kind="stable")
        self.item = item[by_row]
        self.start = np.searchsorted(self.row[by_row], np.arange(len(weight) + 1))
        self.digits = [(j, self._bitmap(np.flatnonzero(weight >> j & 1))) for j in range(int(weight.max(initial=1)).bit_length()) if (weight >> j & 1).any()]

    def _bitmap(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        np.bitwise_or.at(out, rows >> 6, np.uint64(1) << (rows & 63).astype(np.uint64))
        return out

    def rows_of(self, items: Sequence[int]) -> tuple[np.ndarray | None, np.ndarray | None]:
        """(bitmap, None) or (None, list) of the rows that hold all the items."""
        thin = [i for i in items if not self.is_dense[i]]
        bits = None
        for i in items:
            if self.is_dense[i]:
                own = self.bits[self.slot[i]]
                bits = own if bits is None else bits & own
        if not thin:
            return bits, None
        rows = self.row[self.first[thin[0]]: self.first[thin[0] + 1]]
        for i in thin[1:]:
            rows = np.intersect1d(rows, self.row[self.first[i]: self.first[i + 1]], assume_unique=True)
        if bits is not None:
            rows = rows[(bits[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1) > 0]
        return None, rows

    def extensions(self, items: Sequence[int], more: np.ndarray) -> np.ndarray:
        """For each of the items ``more``: weight of the rows that hold it beside ``items``."""
        bits, rows = self.rows_of(items)
        if bits is not None:
            out = np.zeros(self.n_items, np.int64)
            some = np.flatnonzero(bits)
            thick = more[self.is_dense[more]]
            if len(thick) and len(some):
                both = self.bits[np.ix_(self.slot[thick], some)] & bits[some]
                out[thick] = sum((np.bitwise_count(both & w[some]).sum(1, dtype=np.int64) << j for j, w in self.digits), np.zeros(len(thick), np.int64))
            if len(thick) < len(more):
                hit = (bits[self.thin_row >> 6] >> (self.thin_row & 63).astype(np.uint64)) & np.uint64(1) > 0
                out += np.bincount(self.thin_item[hit], self.weight[self.thin_row[hit]], minlength=self.n_items).astype(np.int64)
            return out[more]
        size = self.start[rows + 1] - self.start[rows]
        end = np.cumsum(size)
        take = np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[rows] - (end - size), size)
        return np.bincount(self.item[take], np.repeat(self.weight[rows], size), minlength=self.n_items).astype(np.int64)[more]


def _ranges(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows within the limits of a chunk."""
    end, lo = np.cumsum(size), 0
    while lo < len(size):
        before = end[lo] - size[lo]
        hi = min(lo + CHUNK_ROWS, max(lo + 1, int(np.searchsorted(end, before + CHUNK_ITEMS, "right"))))
        yield lo, min(hi, len(size))
        lo = min(hi, len(size))


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The rows of a list column of codes."""
    flat, size = column.flatten().to_numpy(zero_copy_only=False), np.asarray(pc.list_value_length(column))
    return iter(np.split(flat, np.cumsum(size)[:-1])) if len(size) else iter(())


class Candidates:
    """The candidates of a segment: prefixes with their last items, as codes of a vocabulary."""

    def __init__(self, parts: list[tuple[pa.Array, pa.Array]]):
        prefix, lasts = (pa.concat_arrays([p[i] for p in parts]) for i in range(2))
        self.vocabulary = pc.unique(pa.concat_arrays([prefix.flatten(), lasts.flatten()]))
        self.prefixes = [(p.tolist(), x) for p, x in zip(_lists(self.coded(prefix)), _lists(self.coded(lasts)), strict=True)]

    def coded(self, items: pa.Array) -> pa.ListArray:
        size = np.asarray(pc.list_value_length(items))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pc.index_in(items.flatten(), value_set=self.vocabulary).cast(pa.int64()))

    def supports(self, items: pa.Array, weight: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(sets as rows of codes, weights) of the candidates within some baskets; those that occur."""
        code = pc.index_in(items.flatten(), value_set=self.vocabulary)
        size = np.asarray(pc.fill_null(pc.list_value_length(items), 0))
        known = np.asarray(pc.is_valid(code))
        row, code = np.repeat(np.arange(len(size)), size)[known], pc.drop_null(code).to_numpy(zero_copy_only=False).astype(np.int64)
        size = np.bincount(row, minlength=len(size))
        keep = size >= level
        row, code = (np.cumsum(keep) - 1)[row[keep[row]]], code[keep[row]]
        size, weight = size[keep], weight[keep]
        edge = np.concatenate([[0], np.cumsum(size)])
        sets, counts = [np.zeros((0, level), np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in _ranges(size):
            chunk = Chunk(row[edge[lo]: edge[hi]] - lo, code[edge[lo]: edge[hi]], weight[lo:hi], len(self.vocabulary))
            there = np.diff(chunk.first) > 0
            for prefix, lasts in self.prefixes:
                lasts = lasts[there[lasts]]
                if not there[prefix].all():
                    continue
                for i in range(len(lasts) - 1):
                    n = chunk.extensions([*prefix, lasts[i]], lasts[i + 1:])
                    hit = np.flatnonzero(n)
                    if len(hit):
                        own = np.empty((len(hit), level), np.int64)
                        own[:, :-1], own[:, -1] = [*prefix, lasts[i]], lasts[i + 1:][hit]
                        sets.append(own)
                        counts.append(n[hit])
        return np.concatenate(sets), np.concatenate(counts)


def _counter(by: Sequence[str], level: int):
    """Task function: of each group the candidates, then the baskets; gives (by..., items, count)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, given, candidates, waiting = None, [], None, []

        def counts(kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
            if not waiting:
                return
            sets, n = candidates.supports(pa.concat_arrays([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]), level)
            waiting.clear()
            if len(n):
                items = candidates.vocabulary.take(pa.array(sets.reshape(-1)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * level, pa.int32()), items)
                keys = [pa.array([v] * len(n), kinds.field(c).type) for c, v in zip(by, group, strict=False)]
                yield pa.RecordBatch.from_arrays([*keys, lists, pa.array(n)], names=[*by, "items", "count"])

        for batch in batches:
            key = list(zip(*[batch.column(c).to_pylist() for c in (*by, "_salt", "_kind")], strict=True))
            cuts = [0, *(i for i in range(1, len(key)) if key[i] != key[i - 1]), len(key)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if key[lo][:-1] != group:
                    yield from counts(batch.schema)
                    group, given, candidates = key[lo][:-1], [], None
                part = batch.slice(lo, hi - lo)
                if key[lo][-1] == 0:
                    given.append((part.column("items"), part.column("lasts")))
                elif given:
                    candidates = candidates or Candidates(given)
                    waiting.append((part.column("items"), part.column("weight").to_numpy()))
                    if sum(len(w[0]) for w in waiting) >= CHUNK_ROWS or sum(w[0].flatten().nbytes for w in waiting) >= 16 * CHUNK_ITEMS:
                        yield from counts(batch.schema)
        if waiting:
            yield from counts(batch.schema)

    return run


def groups_of(size: str) -> Column:
    """Into how many groups a segment is dealt, as an aggregate of its patterns' sizes."""
    return F.greatest(F.lit(1), F.ceil(F.sum(size) / GROUP_ITEMS)).cast("int")


def support_counts(dealt: DataFrame, candidates: DataFrame, by: Sequence[str], level: int) -> DataFrame:
    """(by..., items, count) of the candidates that occur.

    ``dealt`` has ``by..., _salt, items, weight``; ``candidates`` has ``by...,
    _salt, prefix, lasts``, once for each group of its segment, with ``lasts``
    in the order that the result's items take.
    """
    kind = T.ArrayType(dealt.schema["items"].dataType.elementType)
    both = candidates.select(*by, "_salt", F.lit(0).alias("_kind"), F.col("prefix").cast(kind).alias("items"), F.col("lasts").cast(kind).alias("lasts"), F.lit(0).cast("long").alias("weight")) \
        .unionByName(dealt.select(*by, "_salt", F.lit(1).alias("_kind"), F.col("items").cast(kind).alias("items"), F.lit(None).cast(kind).alias("lasts"), F.col("weight").cast("long").alias("weight")))
    met = both.repartition(*by, "_salt").sortWithinPartitions(*by, "_salt", "_kind")
    schema = T.StructType([*[T.StructField(c, dealt.schema[c].dataType) for c in by], T.StructField("items", kind), T.StructField("count", T.LongType())])
    return met.mapInArrow(_counter(by, level), schema).groupBy(*by, "items").agg(F.sum("count").alias("count"))
