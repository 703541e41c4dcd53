"""Candidates for repeated windows: anchored segments of texts.

Texts are sequences of symbols (word hashes or bytes). A window is ``width``
consecutive symbols. Its anchor is the least of the hashes of the k-grams in
it (the leftmost of equal ones), so equal windows have equal anchors at equal
places. Consecutive windows with the same anchor form a segment: the symbols
from the first window's start to the last one's end. Every window belongs to
one segment, so

* windows whose anchor occurs once in the corpus are unique: they are left out
  before any text moves,
* windows that are equal lie in segments with the same anchor: an anchor's
  segments are all that has to be compared.

Equal texts are one text with a weight, equal segments are one segment with a
weight. The last step takes the repeated windows back to the texts that hold
the segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work
from .textwords import BYTE, GRAM, base_powers, buffer_of, gram_hashes, mix, pieces, words_of

#: segments of one anchor that are compared together; those of a more frequent anchor go window by window
ANCHOR_SEGMENTS = 4096


@dataclass(frozen=True)
class Kind:
    """What a symbol is (words as 64-bit hashes, or bytes), window and anchor lengths, and about how many symbols a shard has."""

    words: bool
    width: int
    gram: int
    shard_symbols: int

    def symbols(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the rows and the rows' offsets."""
        if not self.words:
            return buf, off
        h, _, _, first = words_of(buf, off)
        return h, first

    @property
    def dtype(self):
        return np.uint64 if self.words else np.uint8


def segments(sym: np.ndarray, kind: Kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor's place, anchor, content hash) of a sequence's segments."""
    n = len(sym) - kind.width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    values = sym if kind.words else BYTE[sym]
    grams = _grams(values, kind.gram)
    place = _least(grams, kind.width - kind.gram + 1)
    new = np.ones(n, bool)
    new[1:] = place[1:] != place[:-1]
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, n))
    at = place[start]
    return start, count, at - start, grams[at], _contents(values, start, count + kind.width - 1, at - start)


def _grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams: sums over prefixes for long grams, term by term for short ones."""
    if k <= 8:
        return gram_hashes(values, k)
    n = len(values) - k + 1
    out = np.empty(n, np.uint64)
    block = 1 << 16
    pw, inv = base_powers(GRAM, block + k + 1)
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        c = np.zeros(hi - lo + k, np.uint64)
        np.cumsum(values[lo: hi + k - 1] * pw[: hi + k - 1 - lo], out=c[1:])
        out[lo:hi] = (c[k:] - c[:-k]) * inv[: hi - lo]
    return mix(out)


def _least(grams: np.ndarray, w: int) -> np.ndarray:
    """Place of the least of every ``w`` consecutive values, the leftmost of equal ones.

    The order is that of the values' upper 44 bits; blocks keep the place in the lower ones.
    """
    n = len(grams) - w + 1
    out = np.empty(n, np.int64)
    block = 1 << 16
    low = np.uint64((1 << 20) - 1)
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        v = (grams[lo: hi + w - 1] & ~low) | np.arange(hi + w - 1 - lo, dtype=np.uint64)
        size = 1
        while 2 * size <= w:
            v = np.minimum(v[:-size], v[size:])
            size *= 2
        if size < w:
            v = np.minimum(v[: hi - lo], v[w - size: w - size + hi - lo])
        out[lo:hi] = (v[: hi - lo] & low).astype(np.int64) + lo
    return out


def _contents(values: np.ndarray, start: np.ndarray, length: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Hashes of the segments' symbols together with the anchor's place in them."""
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        at = int(start[lo])
        hi = max(lo + 1, int(np.searchsorted(start, at + (1 << 17))))
        end = int((start[lo:hi] + length[lo:hi]).max())
        pw, inv = base_powers(GRAM, end - at + 1)
        c = np.zeros(end - at + 1, np.uint64)
        np.cumsum(values[at:end] * pw[: end - at], out=c[1:])
        i = start[lo:hi] - at
        out[lo:hi] = (c[i + length[lo:hi]] - c[i]) * inv[i]
        lo = hi
    return mix(mix(out) + length.astype(np.uint64) * np.uint64(4096) + anchor.astype(np.uint64))


def text_class(text):
    """Names a text: its 128-bit hash."""
    return F.unhex(F.md5(text.cast("binary")))


def _by_content(found: list[tuple]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The distinct segments of each text (windows, place, anchor, segment), where each starts, and the texts' offsets.

    A text that repeats itself holds a segment many times; that is one row with many starts.
    """
    rows, order, counts, cuts = [], [], [], [0]
    base = 0
    for start, windows, place, anchor, content in found:
        _, at, back, n = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
        rows.append(np.stack([windows[at], place[at], anchor.view(np.int64)[at], content.view(np.int64)[at]], axis=1))
        order.append(start[np.argsort(back, kind="stable")])
        counts.append(n)
        base += len(at)
        cuts.append(base)
    join = lambda parts, empty: np.concatenate(parts) if parts else empty
    off = np.concatenate([[0], np.cumsum(join(counts, np.zeros(0, np.int64)))])
    starts = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(join(order, np.zeros(0, np.int64)).astype(np.int32)))
    return join(rows, np.zeros((0, 4), np.int64)), starts, np.array(cuts)


def _scan(kind: Kind, describe: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = buffer_of(batch.column("text"))
            for lo, hi in pieces(off):
                part, at = buf[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
                sym, first = kind.symbols(part, at)
                rows, starts, cuts = _by_content([segments(sym[first[i]: first[i + 1]], kind) for i in range(hi - lo)])
                struct = pa.StructArray.from_arrays([starts, *[pa.array(rows[:, k].astype(np.int32)) for k in (0, 1)], pa.array(rows[:, 2]), pa.array(rows[:, 3])],
                                                    names=["starts", "windows", "place", "anchor", "segment"])
                whole = [describe(part[at[i]: at[i + 1]], np.zeros((0, 2), np.int64)) for i in range(hi - lo)]
                cols = list(zip(*whole, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("cls").slice(lo, hi - lo),
                                                  pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), struct), pa.array(cols[0], pa.int64()), pa.array(cols[3])],
                                                 names=["doc_id", "cls", "segments", "n", "sha"])
    return run


@dataclass
class Piece:
    """The symbols of a wanted segment, or of one of its windows."""

    shard: int
    segment: int
    weight: int
    window: int
    place: int
    symbols: bytes


def _wanted(kind: Kind, shards: int):
    """The pieces of the segments that each text stands for, a block of texts at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Piece]]:
        for batch in batches:
            buf, off = buffer_of(batch.column("text"))
            want = batch.column("want").to_pylist()
            for lo, hi in pieces(off):
                sym, first = kind.symbols(buf[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
                rows = []
                for i in range(lo, hi):
                    own = sym[first[i - lo]: first[i - lo + 1]]
                    for w in want[i]:
                        a, n = w["start"], w["windows"]
                        if w["alone"]:  # window by window, dealt by content
                            for k in range(n):
                                data = own[a + k: a + k + kind.width].tobytes()
                                route = int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")
                                rows.append(Piece(route % shards, w["segment"], w["weight"], k, w["place"] - k, data))
                        else:
                            route = int(mix(np.array([w["anchor"]], np.int64).view(np.uint64))[0])
                            rows.append(Piece(route % shards, w["segment"], w["weight"], 0, w["place"], own[a: a + n + kind.width - 1].tobytes()))
                if rows:
                    yield rows
    return run


def shards_for(wanted: DataFrame, kind: Kind) -> int:
    """How many shards the shipped symbols of rows (windows, alone) fill; the windows of a segment that is ``alone`` travel one by one."""
    symbols = F.when(F.col("alone"), F.col("windows").cast("long") * kind.width).otherwise(F.col("windows") + kind.width)
    size = wanted.agg(F.sum(symbols)).first()[0] or 0
    return max(1, -(-size // kind.shard_symbols))


def _cover(kind: Kind, describe: Callable):
    """Joins a text's covering intervals and describes what is left of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = buffer_of(batch.column("text"))
            runs = batch.column("runs").to_pylist()
            out = []
            for i in range(len(runs)):
                spans = sorted((r["a"], r["b"]) for r in runs[i])
                merged: list[list[int]] = []
                for a, b in spans:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                out.append(describe(buf[off[i]: off[i + 1]], np.array(merged, np.int64).reshape(-1, 2)))
            c = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.string())], names=["cls", "n_removed", "n_spans", "sha"])
    return run


def repeated(docs: DataFrame, work: Work, kind: Kind, ship: Callable, shipped: str, find: Callable, describe: Callable,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, n_removed, n_spans, kept_sha256): what is left of each text without its repeated windows.

    ``ship`` turns lists of pieces into Arrow batches of the schema ``shipped``,
    which has ``shard``; ``find`` takes a shard's rows and returns ``segment, a,
    b``: the windows a..b-1 of a segment are repeated.
    ``describe(bytes, runs)`` returns (symbols, removed symbols, runs, sha256 of the rest).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), text_class(text).alias("cls"), text.alias("text"))
    segment = "array<struct<starts:array<int>,windows:int,place:int,anchor:long,segment:long>>"
    scan = work.store(texts.mapInArrow(_scan(kind, describe), f"doc_id long, cls binary, segments {segment}, n long, sha string"), "scan")
    # one row per text and segment, with the number of documents that hold the text
    classes = scan.groupBy("cls").agg(F.count(F.lit(1)).alias("docs"))
    held = scan.select("cls", "segments").where(F.size("segments") > 0).dropDuplicates(["cls"]).join(classes, "cls").select("cls", "docs", F.explode("segments").alias("s"))
    held = held.select("cls", "docs", "s.*").withColumn("times", F.col("docs") * F.size("starts"))
    # summaries are stored before they are joined, so that Spark can split the partition of a frequent key
    often = work.store(held.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor"), "often")
    held = work.store(held.join(often, "anchor", "left_semi"), "held")
    work.drop("often")
    distinct = held.groupBy("anchor", "segment").agg(F.sum("times").alias("weight"), F.min(F.struct("cls", F.element_at("starts", 1).alias("start"), "windows", "place")).alias("r"))
    distinct = work.store(distinct.select("anchor", "segment", "weight", "r.*"), "distinct")
    hot = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ANCHOR_SEGMENTS).select("anchor", F.lit(True).alias("alone"))
    wanted = distinct.join(hot, "anchor", "left").withColumn("alone", F.coalesce("alone", F.lit(False)))
    shards = shards_for(wanted, kind)
    wanted = wanted.groupBy("cls").agg(F.collect_list(F.struct("start", "windows", "place", "anchor", "segment", "weight", "alone")).alias("want"))
    touched = held.select("cls").distinct().join(wanted, "cls", "left").withColumn("want", F.coalesce("want", F.array().cast("array<struct<start:int,windows:int,place:int,anchor:long,segment:long,weight:long,alone:boolean>>")))
    touched = work.store(touched, "want")  # before texts travel, so that the files of both shuffles are not there at once
    work.drop("distinct")
    touched = work.store(texts.select("cls", "text").join(touched, "cls").dropDuplicates(["cls"]), "touched")
    work.drop("want")
    pieces_of = _wanted(kind, shards)
    rows = touched.where(F.size("want") > 0).mapInArrow(lambda batches: ship(pieces_of(batches)), shipped)
    found = work.store(rows.groupBy("shard").applyInArrow(find, "segment long, a int, b int"), "found")
    # the windows of a segment are repeated wherever the segment is
    by_segment = work.store(found.groupBy("segment").agg(F.collect_list(F.struct("a", "b")).alias("runs")), "by-segment")
    work.drop("found")
    span = lambda s, x: F.struct((s + x["a"]).alias("a"), (s + x["b"] + kind.width - 1).alias("b"))
    spans = F.flatten(F.transform("starts", lambda s: F.transform("runs", lambda x: span(s, x))))
    runs = held.join(by_segment, "segment").select("cls", F.explode(spans).alias("r"))
    runs = work.store(runs.groupBy("cls").agg(F.collect_list("r").alias("runs")), "runs")
    work.drop("held", "by-segment")
    cut = touched.select("cls", "text").join(runs, "cls").mapInArrow(_cover(kind, describe), "cls binary, n_removed long, n_spans long, sha string")
    cut = work.store(cut.select(F.col("cls").alias("_cls"), "n_removed", "n_spans", F.col("sha").alias("_sha")), "cut")
    work.drop("touched", "runs")
    out = scan.select("doc_id", "cls", "n", "sha").join(cut, F.col("cls") == F.col("_cls"), "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "cls", "n", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("_sha", "sha").alias("kept_sha256"))


def runs_of(good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[0], good.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
