"""Operator 13, periodic run detection by a dictionary of basic factors.

The basic factors of a text are its substrings of ``L = 2**k`` words. Level k
names them: equal factors of one document get equal names, made from the names
of their two halves. Sorting the names puts a factor's occurrences side by
side, so each position learns its successor, the next place of its factor.
Within twice the factor's length such occurrences form arithmetic progressions.
A run of period q reaches from ``L >= q`` on over consecutive positions whose
successors are all exactly q words away: no shorter distance is possible where
q is the smallest period. Each level therefore proposes the periods in
``(L/2, L]``. A maximal stretch of consecutive positions ``i..j`` with the same
distance q is a progression that extends as far as it can, and spans the words
``i .. j + q + L - 1``; a run of exponent 3 or more has such a stretch in
exactly one level, so nothing is found twice.

A factor that occurs once in its document is in no run of longer factors, so
its position leaves at that level, as do documents too short for the level's
periods. Work is therefore about one sort of the words, plus sorts of the
positions that are left.

Tasks read their own texts; there is no shuffle. Words are compared by 64-bit
hashes. A text is held whole by one worker, with about 100 bytes per word.

A null or empty text has no words and no runs. Every row is judged by itself,
so repeated rows give repeated results. An empty table gives no rows; columns
other than the two named are not read, whatever their names. A null id is
passed on, and no ``reorder`` is made for it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textwords import buffer_of, mix, pieces, words_of

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def planted_order(doc_id: int, n: int) -> np.ndarray | None:
    """Word order of the check's planted documents: from word a on, p words repeat."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def successors(names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(new names as ranks, distance to the next equal name or 0, occurs more than once), by position.

    ``at`` holds the positions in ascending order.
    """
    order = np.argsort(names, kind="stable")
    by = names[order]
    same = by[1:] == by[:-1]
    rank = np.empty(len(by), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(~same)])
    far = np.zeros(len(by), np.int64)
    far[order[:-1][same]] = (at[order[1:]] - at[order[:-1]])[same]
    again = np.zeros(len(by), bool)
    again[order[1:][same]] = True
    return rank, far, again | (far > 0)


def runs_of(words: np.ndarray, first: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> tuple[np.ndarray, ...]:
    """(row, start within the row, length, period) of the runs, by row, start and period.

    ``words`` are the hashes of the rows' words one after another, ``first``
    the rows' offsets. ``min_exponent`` is at least 3.
    """
    if min_exponent < 3:
        raise ValueError("min_exponent is at least 3")
    n_row = np.diff(first)
    row = np.repeat(np.arange(len(n_row)), n_row)
    last = first[1:][row]
    names = np.empty(len(words), np.int64)
    at = np.arange(len(words))
    key = mix(words + mix(row.astype(np.uint64) + np.uint64(1)))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 1
    while len(at):
        rank, far, again = successors(key, at)
        # the progressions: consecutive positions with one distance
        here = np.flatnonzero((far > size // 2) & (far <= size))
        if len(here):
            p, q = at[here], far[here]
            cut = np.flatnonzero((np.diff(p) != 1) | (np.diff(q) != 0)) + 1
            i, j = np.concatenate([[0], cut]), np.concatenate([cut, [len(p)]]) - 1
            start, period = p[i], q[i]
            length = p[j] - start + period + size
            good = length >= np.maximum(min_length, min_exponent * period)
            found.append((start[good], length[good], period[good]))
        # factors of twice the length, where both halves occur again and the text can hold their periods
        names.fill(-1)
        at = at[again]
        names[at] = rank[again]
        fits = (at + 2 * size <= last[at]) & (n_row[row[at]] >= max(min_length, min_exponent * (size + 1)))
        at = at[fits]
        half = names[np.minimum(at + size, len(names) - 1)]
        at, half = at[half >= 0], half[half >= 0]
        key = names[at] * len(names) + half
        size *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 4
    start, length, period = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    return row[start], start - first[row[start]], length, period


def joined_words(buf: np.ndarray, s: np.ndarray, e: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Text of the given words (in order of row), joined by one space within a row: bytes and row offsets."""
    closing = np.ones(len(s), bool)  # the last word of a row has no space after it
    closing[:-1] = row[1:] != row[:-1]
    size = e - s + ~closing
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    take = np.arange(total) + np.repeat(s - (end - size), size)
    take[(end - 1)[~closing]] = len(buf)
    per_row = np.bincount(row, size, minlength=n_rows).astype(np.int64)
    return np.append(buf, np.uint8(32))[take], np.concatenate([[0], np.cumsum(per_row)])


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4,
                  reorder: Callable[[int, int], np.ndarray | None] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): every run of each text, and the text without the repeats.

    A run is a maximal stretch of words with smallest period q and length at
    least ``max(min_length, min_exponent * q)``. ``collapsed`` keeps the first q
    words of each run, joined by one space. ``reorder(doc_id, n)`` may give
    another order of a document's n words, or None.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = buffer_of(batch.column("text"))
            ids = batch.column("doc_id")
            for lo, hi in pieces(off):
                part, own = buf[off[lo]: off[hi]], ids.slice(lo, hi - lo)
                h, s, e, first = words_of(part, off[lo: hi + 1] - off[lo])
                n_row = np.diff(first)
                if reorder is not None:
                    source = np.arange(len(h))
                    for i, doc in enumerate(own.to_pylist()):
                        if doc is not None and (order := reorder(doc, int(n_row[i]))) is not None:
                            source[first[i]: first[i + 1]] = first[i] + order
                    h, s, e = h[source], s[source], e[source]
                r, start, length, period = runs_of(h, first, min_length, min_exponent)
                edge = np.zeros(len(h) + 1, np.int64)
                np.add.at(edge, first[r] + start + period, 1)
                np.add.at(edge, first[r] + start + length, -1)
                keep = np.cumsum(edge[:-1]) == 0
                row = np.repeat(np.arange(hi - lo), n_row)
                text, ends = joined_words(part, s[keep], e[keep], row[keep], hi - lo)
                n_runs = np.bincount(r, minlength=hi - lo)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_runs)]), pa.int32()),
                                                 pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], fields=list(RUN)))
                texts = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(text))
                yield pa.RecordBatch.from_arrays([own, pa.array(n_row), lists, texts.cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def digests(found: DataFrame) -> DataFrame:
    """Counts, the longest run and SHA-256 digests of what ``periodic_runs`` returns."""
    top = F.expr("array_sort(runs, (a, b) -> CASE WHEN a.length <> b.length THEN IF(a.length > b.length, -1, 1) "
                 "WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1) WHEN a.period < b.period THEN -1 WHEN a.period > b.period THEN 1 ELSE 0 END)")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    t = found.withColumn("_top", F.get(top, F.lit(0)))
    return t.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_top.start").alias("start"), F.col("_top.length").alias("length"),
                    F.col("_top.period").alias("period"), F.expr("(1000 * _top.length) div _top.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
