"""Operator 11, phrase collocations by mergeable Misra-Gries summaries.

Phrases are counted level by level, a word more at a time. A level reads the
texts once:

1. Tasks hash the phrases of the level. A phrase counts only if its first and
   its last words (one less than the phrase) both were among the survivors of
   the level below, as no phrase is more frequent than its parts.
2. Hashes are dealt to partitions by their leading bits. What a task has
   gathered for a partition leaves as one row of packed arrays, with its mass
   (number of occurrences); rows of one partition meet in one task, masses first.
3. That task knows the partition's mass m and keeps a Misra-Gries summary of
   ``SLACK * m / min_count + 1`` counters. Summaries are merged by adding
   counters; beyond the capacity k the (k+1)-th largest counter is subtracted
   from all. What is subtracted in total, E, is at most ``m / (k + 1)``, less
   than ``min_count``, so no phrase with ``min_count`` occurrences is lost. The
   survivors are the hashes whose counter plus E reaches ``min_count``.

The next level, and the last pass, must know the survivors. Each partition
sets its survivors' bits in its own slice of a bitmap; the whole bitmap has at
most ``2**MAX_BITS`` bits (16 MB) whatever the data, and is broadcast. A bit
set by another hash only lets a phrase through that is not frequent.

The second pass reads the texts again and counts, by their spelling, all
phrases whose bits are set; sums below ``min_count`` go. These counts are exact,
and every part of a frequent phrase is among them. Scores, the best cut and
the test against longer phrases are joins and aggregates of the counts in
Spark, in decimal arithmetic of 38 digits.

Everything is per language. A null language is ``und``, a null text is empty.
Repeated rows count each time, as do overlapping occurrences. Rows with a null
id count like others. Texts without a word add nothing; of very long texts a
worker holds one whole, with about 100 bytes per word. Ties in the score go to
the more frequent phrase, then to the smaller one in byte order, so ranks are
defined. An empty table gives no rows; columns other than the language and the
text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Work
from .textwords import BYTE, LOWER, buffer_of, mix, pieces, span_hashes

#: capacity of a summary in units of mass / min_count
SLACK = 4
#: occurrences that a partition is laid out for, and the fewest partitions
PART_MASS, MIN_PARTS = 1 << 24, 64
#: the bitmap of survivors: bits for each, and the most bits of all
BITS_EACH, MAX_BITS = 16, 27
#: languages whose totals are broadcast
MAX_BROADCAST = 10_000
#: distinct entries that a task gathers, bytes of a block of texts
GATHER, BLOCK_BYTES = 1 << 21, 1 << 21
UNKNOWN = "und"
IS_PART = np.ones(256, bool)
IS_PART[[*b"\t\n\x0b\x0c\r .,;:!?"]] = False
ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[[*b"\n\x0b\x0c\r.,;:!?"]] = True
TO_LOWER = bytes(LOWER.astype(np.uint8))
STEP = np.uint64(0xD6E8FEB86659FD93)


class Block:
    """Words of a block of rows: hashes that tell languages apart, places, and where pieces begin."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, langs: list[str]):
        part = IS_PART[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[off] = True
        before, after = np.append(False, part[:-1]) if len(buf) else part, np.append(part[1:], False) if len(buf) else part
        self.s = np.flatnonzero(part & (~before | edge[:-1]))
        self.e = np.flatnonzero(part & (~after | edge[1:])) + 1
        self.buf = buf
        row = np.searchsorted(off, self.s, "right") - 1
        self.langs = list(dict.fromkeys(langs))
        code = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.array([code[x] for x in langs], np.int64)[row]
        own = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in self.langs], np.uint64)
        self.word = mix(span_hashes(buf, self.s, self.e, BYTE[LOWER]) ^ own[self.lang])
        ends = np.concatenate([[0], np.cumsum(ENDS_PIECE[buf])])
        self.opens = np.ones(len(self.s), bool)  # no phrase goes from the word before into this one
        self.opens[1:] = (row[1:] != row[:-1]) | (ends[self.s[1:]] > ends[self.e[:-1]])

    def grams(self, filters: list[Filter], top: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, hashes by first word, may be frequent) for phrases of 1 to ``top`` words.

        The filter of a size must let a phrase through; without one its parts' filters decide.
        """
        g, ok = self.word, np.ones(len(self.word), bool)
        for size in range(1, top + 1):
            if size > 1:
                n = max(0, len(self.word) - size + 1)
                g = mix(g[:n] * STEP + self.word[size - 1:])
                ok = ok[:n] & ok[1: n + 1] & ~self.opens[size - 1:]
            if size <= len(filters):
                at = np.flatnonzero(ok)
                ok[at] = filters[size - 1].has(g[at])
            yield size, g, ok

    def spelled(self, first: int, size: int) -> str:
        text = self.buf[self.s[first]: self.e[first + size - 1]].tobytes().translate(TO_LOWER)
        return b" ".join(text.split()).decode()


class Filter:
    """A bitmap over the leading bits of hashes."""

    def __init__(self, bits: int, data: np.ndarray):
        self.shift, self.data = np.uint64(64 - bits), data

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[at], np.add.reduceat(counts, at)


class MisraGries:
    """Mergeable summary: at most ``capacity`` counters, each too low by at most ``error``."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        if sum(len(k) for k, _ in self.waiting) > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        more = [(self.keys, self.counts), *self.waiting]
        self.waiting = []
        self.keys, self.counts = summed(np.concatenate([k for k, _ in more]), np.concatenate([c for _, c in more]))
        if len(self.keys) > self.capacity:
            least = int(np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1])
            self.error += least
            left = self.counts > least
            self.keys, self.counts = self.keys[left], self.counts[left] - least

    def frequent(self, min_count: int) -> np.ndarray:
        """Hashes that may occur ``min_count`` times."""
        self.merge()
        return self.keys[self.counts + self.error >= min_count]


def packed(keys: np.ndarray, counts: np.ndarray, key_bits: int) -> tuple[bytes, bytes]:
    """Sorted keys as differences, byte planes apart, so that the exchange compresses them; counts in the fewest bytes."""
    low = keys & np.uint64((1 << key_bits) - 1)
    planes = np.diff(low, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T[: -(-key_bits // 8)]
    small = counts.astype(np.min_scalar_type(int(counts.max())))
    return planes.tobytes(), small.itemsize.to_bytes(1, "big") + small.tobytes()


def unpacked(part: int, keys: bytes, counts: bytes, key_bits: int) -> tuple[np.ndarray, np.ndarray]:
    n_planes = -(-key_bits // 8)
    planes = np.frombuffer(keys, np.uint8).reshape(n_planes, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :n_planes] = planes.T
    low = np.cumsum(wide.view("<u8")[:, 0], dtype=np.uint64)
    return low | np.uint64(part << key_bits), np.frombuffer(counts, f"u{counts[0]}", offset=1).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        buf, off = buffer_of(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        for lo, hi in pieces(off, BLOCK_BYTES):
            yield Block(buf[off[lo]: off[hi]], off[lo: hi + 1] - off[lo], langs[lo:hi])


def partition_bits(mass: int) -> int:
    return (max(MIN_PARTS, -(-mass // PART_MASS)) - 1).bit_length()


def survivors(texts: DataFrame, size: int, mass: int, min_count: int, filters: list, work: Work) -> DataFrame:
    """(part, keys) per partition of the hashes of phrases of ``size`` words that may be frequent; stored.

    ``mass`` is the number of words, which bounds the phrases of a size.
    """
    bits = partition_bits(mass)
    key_bits = 64 - bits

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def leave() -> pa.RecordBatch:
            part = (keys >> np.uint64(key_bits)).astype(np.int64)
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            rows = []
            for p, a, b in zip(part[at].tolist(), at.tolist(), [*at[1:].tolist(), len(part)], strict=True):
                k, c = packed(keys[a:b], counts[a:b], key_bits)
                rows += [(p, int(counts[a:b].sum()), None, None), (p, None, k, c)]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["part", "mass", "keys", "counts"])

        opened = [f.value for f in filters]
        for block in blocks(batches):
            *_, (_, g, ok) = block.grams(opened, size)
            k, c = np.unique(g[ok], return_counts=True)
            keys, counts = summed(np.concatenate([keys, k]), np.concatenate([counts, c]))
            if len(keys) > GATHER:
                yield leave()
                keys, counts = keys[:0], counts[:0]
        if len(keys):
            yield leave()

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masses: dict[int, int] = {}
        open_part, summary = None, None

        def close() -> Iterator[pa.RecordBatch]:
            if summary is not None and len(k := summary.frequent(min_count)):
                yield pa.RecordBatch.from_arrays([pa.array([open_part]), pa.array([k.tobytes()], pa.binary()), pa.array([len(k)])], names=["part", "keys", "n"])

        for batch in batches:
            for p, m, k, c in zip(*(batch.column(x).to_pylist() for x in ("part", "mass", "keys", "counts")), strict=True):
                if m is not None:  # a partition's masses come first
                    masses[p] = masses.get(p, 0) + m
                    continue
                if p != open_part:
                    yield from close()
                    open_part, summary = p, MisraGries(SLACK * masses.pop(p) // min_count + 1)
                summary.add(*unpacked(p, k, c, key_bits))
        yield from close()

    dealt = texts.mapInArrow(gather, "part long, mass long, keys binary, counts binary")
    met = dealt.repartition("part").sortWithinPartitions("part", F.col("mass").isNull())
    return work.store(met.mapInArrow(summarise, "part long, keys binary, n long"), f"survivors-{size}")


def filter_of(found: DataFrame, mass: int) -> Filter | None:
    """The bitmap of survivors, put together from the partitions' slices; None without any."""
    n = found.agg(F.sum("n")).first()[0]
    if not n:
        return None
    part_bits = partition_bits(mass)
    bits = max(part_bits + 3, 16, min(MAX_BITS, (n * BITS_EACH).bit_length()))
    size = 1 << (bits - part_bits - 3)  # bytes of a slice

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, k in zip(batch.column("part").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                at = (np.frombuffer(k, np.uint64) >> np.uint64(64 - bits)).astype(np.int64) - p * size * 8
                own = np.zeros(size * 8, np.uint8)
                own[at] = 1
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])

    data = np.zeros(1 << (bits - 3), np.uint8)
    for r in found.select("part", "keys").mapInArrow(slices, "part long, bits binary").collect():
        data[r["part"] * size: (r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return Filter(bits, data)


def counted(texts: DataFrame, filters: list, min_count: int) -> DataFrame:
    """(lang, phrase, size, a): exact counts of all phrases with ``min_count`` occurrences; size 0: words of the language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = [f.value for f in filters]
        # hashes in order, and for each its count and its place in the list of spellings
        keys, counts, place = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        spelled: list[tuple[str, str, int]] = []
        words: dict[str, int] = {}

        def leave() -> pa.RecordBatch:
            order = np.argsort(place)
            lang, phrase, size = zip(*spelled, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(phrase), pa.array(size, pa.int32()), pa.array(counts[order])], names=["lang", "phrase", "size", "a"])

        for block in blocks(batches):
            for code, n in enumerate(np.bincount(block.lang, minlength=len(block.langs)).tolist()):
                words[block.langs[code]] = words.get(block.langs[code], 0) + n
            for size, g, ok in block.grams(opened, len(opened)):
                at = np.flatnonzero(ok)
                k, i, c = np.unique(g[at], return_index=True, return_counts=True)
                i = at[i]
                where = np.searchsorted(keys, k)
                new = np.append(keys, np.uint64(0))[where] != k
                new |= where == len(keys)
                counts[where[~new]] += c[~new]
                for first in i[new].tolist():
                    spelled.append((block.langs[block.lang[first]], block.spelled(first, size), size))
                place = np.insert(place, where[new], np.arange(len(spelled) - int(new.sum()), len(spelled)))
                keys, counts = np.insert(keys, where[new], k[new]), np.insert(counts, where[new], c[new])
            if len(keys) > GATHER // 2:
                yield leave()
                keys, counts, place, spelled = keys[:0], counts[:0], place[:0], []
        if spelled:
            yield leave()
        if words:
            yield pa.RecordBatch.from_arrays([pa.array(list(words)), pa.nulls(len(words), pa.string()), pa.array([0] * len(words), pa.int32()), pa.array(list(words.values()), pa.int64())], names=["lang", "phrase", "size", "a"])

    part = texts.mapInArrow(count, "lang string, phrase string, size int, a long")
    return part.groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a")).where((F.col("size") == 0) | (F.col("a") >= min_count))


def collocations(docs: DataFrame, work: Work, min_count: int = 100, max_words: int = 5, absorb: int = 100,
                 lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every candidate that no longer one absorbs.

    Candidates have 2 to ``max_words`` words and ``a >= min_count`` occurrences.
    The score is the least over the cuts into first part and rest,
    ``floor(1000 * a * n / (l * r))``; ties go to the shorter first part. A
    candidate goes if a longer one that contains it has ``absorb`` percent of
    its occurrences or more.
    """
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sc = docs.sparkSession.sparkContext
    mass = int(texts.agg(F.sum((F.octet_length("text") + 1) / 2)).first()[0] or 0)  # at least the number of words
    filters: list = []
    for size in range(1, max_words + 1):
        found = survivors(texts, size, mass, min_count, filters, work)
        bitmap = filter_of(found, mass)
        work.drop(f"survivors-{size}")
        if bitmap is None:
            break
        filters.append(sc.broadcast(bitmap))
    all_counts = work.store(counted(texts, filters, min_count), "counts")
    counts, totals = all_counts.where("size > 0"), all_counts.where("size = 0").select("lang", F.col("a").alias("n"))
    candidates = counts.where("size > 1").withColumn("words", F.split("phrase", " "))
    return best_cuts(candidates, counts, totals, absorb)


def best_cuts(candidates: DataFrame, counts: DataFrame, totals: DataFrame, absorb: int) -> DataFrame:
    """Scores of the candidates from the counts of their parts, without the absorbed ones."""
    cut = candidates.select("lang", "phrase", "size", "a", F.explode(F.expr("""
        transform(sequence(1, size - 1), k -> struct(k, array_join(slice(words, 1, k), ' ') AS first, array_join(slice(words, k + 1, size - k), ' ') AS rest))""")).alias("x"))
    cut = cut.select("lang", "phrase", "size", "a", "x.*")
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    scored = (with_totals(cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]), totals)
              .withColumn("score", F.expr("(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))) div (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")))
    best = scored.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    inner = candidates.where("size > 2").select("lang", "a", F.explode(F.expr("""
        flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1), i -> array_join(slice(words, i, w), ' '))))""")).alias("phrase"))
    longest = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(longest, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {int(absorb)} * a")
    return kept.select("lang", "phrase", "size", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"), "n", F.col("m.score").alias("score"))


def with_totals(cut: DataFrame, totals: DataFrame, limit: int = MAX_BROADCAST, salts: int = 64) -> DataFrame:
    """Adds the language's number of words.

    Up to ``limit`` languages are broadcast, more are joined; a language's cuts
    are then dealt over ``salts`` tasks.
    """
    if totals.limit(limit + 1).count() <= limit:
        return cut.join(F.broadcast(totals), "lang")
    many = totals.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return cut.withColumn("_s", F.pmod(F.hash("phrase"), F.lit(salts))).join(many, ["lang", "_s"]).drop("_s")


def top_phrases(found: DataFrame, limit: int = 2000, salts: int = 64) -> DataFrame:
    """The first ``limit`` phrases of each language with their rank.

    Each language is first cut down in ``salts`` parts, so the last sort of a
    language has at most ``salts * limit`` rows.
    """
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    some = found.withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    some = some.withColumn("_r", F.row_number().over(W.partitionBy("lang", "_s").orderBy(*order))).where(F.col("_r") <= limit)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= limit)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
