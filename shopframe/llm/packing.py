"""Operator 6, best-fit packing by exact complements.

Documents become token ids (then one end id) and pieces of at most ``capacity``
ids. The plan works on the histogram of piece lengths, which has at most
``capacity`` entries whatever the corpus. The sums of one, two and three
available lengths are indexed by value. Lengths are taken from the longest;
while the index has a combination that fills the gap exactly, it is consumed
under its counts, and what has run out leaves the index. What is left is packed
best-fit, also by counts. The plan is a list of patterns (lengths in a
sequence, number of such sequences); pieces are numbered within their length in
Spark and look their place up in it.

A null text is empty; every document, also an empty one, has its end id, so at
least one piece. Repeated rows are packed one by one. An empty table gives no
rows; other columns are not read. Columns: ``row_key`` tells repeated rows of a
``doc_id`` apart where their texts differ.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, numbered
from .textwords import IS_WORD, buffer_of, pieces, span_hashes, worker_memory

CAPACITY = 2048
END_ID = 0
SPACES = b" \t\n\x0b\x0c\r"
#: pieces of one length that one task numbers
BUCKET_ROWS = 50_000
#: units that a worker remembers
REMEMBERED = 1 << 20
#: white space outside ASCII, where units and the tokenizer's own splits differ
OTHER_SPACE = re.compile("[" + "".join(map(chr, (0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))) + "]")


class Tokeniser:
    """Byte-level BPE ids of texts, word by word.

    The tokenizer's splits never join a word with white space that follows it,
    so a text's ids are those of its units (white space and the word after it).
    Each unit is encoded once per worker and remembered by its hash. Texts with
    other white space than ASCII's are encoded whole.
    """

    def __init__(self, spec: str):
        """From the JSON of a ``tokenizers`` file."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(spec)
        self.model.encode_special_tokens = True
        self.n_bytes = np.zeros(self.model.get_vocab_size(), np.int64)
        for token, i in self.model.get_vocab(with_added_tokens=False).items():
            self.n_bytes[i] = len(token)  # one character stands for one byte
        self.clear()

    def clear(self) -> None:
        self.keys, self.start, self.count, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, np.uint32)

    def _units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after another, and how many each has.

        Units are encoded many at a time, and told apart by the bytes of their
        tokens; one without white space in front gets a line feed for that.
        """
        blank = np.array([not u.strip(SPACES) for u in units])
        bare = np.array([u[0] not in SPACES for u in units])
        padded = [b"" if w else b"\n" + u if b else u for u, b, w in zip(units, bare, blank, strict=True)]
        size = np.cumsum([len(u) for u in padded])
        cuts = [0, *np.searchsorted(size, np.arange(8192, size[-1], 8192)).tolist(), len(padded)]
        texts = [b"".join(padded[a:b]).decode() for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.searchsorted(np.concatenate([[0], np.cumsum(self.n_bytes[ids])]), size)
        count = np.diff(ends, prepend=0)
        if bare.any():
            ids, count = np.delete(ids, (ends - count)[bare]), count - bare
        for i in np.flatnonzero(blank):  # white space at the end of a text
            own = self.whole(units[i].decode())
            ids, count[i] = np.insert(ids, int(count[:i].sum()), own), len(own)
        return ids, count

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows one after another, and the rows' offsets."""
        word = IS_WORD[buf]
        head = ~word
        head[1:] &= word[:-1]
        head[off[:-1][off[:-1] < len(buf)]] = True
        s = np.flatnonzero(head)
        row = np.searchsorted(off, s, "right") - 1
        e = np.append(s[1:], len(buf))
        key = span_hashes(buf, s, e)
        uniq, at, back = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.clear()
        new = ~self._has(uniq)
        if new.any():
            data = buf.tobytes()
            ids, count = self._units([data[s[i]: e[i]] for i in at[new]])
            self.start = np.append(self.start, len(self.ids) + np.cumsum(count) - count)
            self.count, self.ids, keys = np.append(self.count, count), np.append(self.ids, ids), np.append(self.keys, uniq[new])
            order = np.argsort(keys, kind="stable")
            self.keys, self.start, self.count = keys[order], self.start[order], self.count[order]
        place = np.searchsorted(self.keys, uniq)[back]
        n, start = self.count[place], self.start[place]
        end = np.cumsum(n)
        out = self.ids[np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - n), n)]
        per_row = np.bincount(row, n, minlength=len(off) - 1).astype(np.int64)
        return out, np.concatenate([[0], np.cumsum(per_row)])

    def _has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, row_key, piece, start, length, ids_crc32[, ids]): the pieces of every document.

    Only the first piece of a longer document may be shorter than ``capacity``.
    ``tokenizer`` is a file of the driver; its content is sent to the tasks.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    name = hashlib.sha256(spec.encode()).hexdigest()
    sent = docs.sparkSession.sparkContext.broadcast(spec)  # a vocabulary: a few MB whatever the corpus
    schema = "doc_id long, row_key long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_memory("tokenisers")
        if name not in kept:
            kept[name] = Tokeniser(sent.value)
        t = kept[name]
        for batch in batches:
            buf, off = buffer_of(batch.column("text"))
            for lo, hi in pieces(off):
                part, at = buf[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
                ids, ends = t.encode(part, at)
                rows: list[tuple] = []
                odd = set()
                text = part.tobytes().decode()
                if OTHER_SPACE.search(text):
                    odd = {i for i in range(hi - lo) if OTHER_SPACE.search(part[at[i]: at[i + 1]].tobytes().decode())}
                doc, key = batch.column("doc_id").slice(lo, hi - lo).to_pylist(), batch.column("row_key").slice(lo, hi - lo).to_pylist()
                for i in range(hi - lo):
                    own = ids[ends[i]: ends[i + 1]] if i not in odd else t.whole(part[at[i]: at[i + 1]].tobytes().decode())
                    own = np.append(own, np.uint32(END_ID)).astype("<u4")
                    cut = [0, *range((len(own) - 1) % capacity + 1, len(own) + 1, capacity)]
                    for p, (a, b) in enumerate(zip(cut, cut[1:], strict=False)):
                        rows.append((doc[i], key[i], p, a, b - a, zlib.crc32(own[a:b].tobytes()), own[a:b].astype(np.int32)))
                c = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][: 6 + with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(c, kinds, strict=False)], names=["doc_id", "row_key", "piece", "start", "length", "ids_crc32", "ids"][: 6 + with_ids])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text).alias("row_key"), text.alias("text")).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is packed; every length is used as often as ``counts`` says."""
    have = [counts.get(length, 0) for length in range(capacity + 1)]
    out: list[tuple[tuple[int, ...], int]] = []

    def take(combo: tuple[int, ...]) -> None:
        need = defaultdict(int)
        for length in combo:
            need[length] += 1
        times = min(have[length] // k for length, k in need.items())
        for length, k in need.items():
            have[length] -= k * times
        out.append((combo, times))

    if have[capacity]:
        take((capacity,))
    sums = SumIndex(have, capacity)
    for length in range(capacity - 1, 0, -1):
        while have[length] and (found := sums.complement(length)):
            take((length, *found))
    # best-fit of the rest: open bins by gap, each (pattern, times)
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in range(capacity, 0, -1):
        n = have[length]
        while n:
            gap = next((g for g in range(length, capacity) if bins.get(g)), None)
            if gap is None:
                fit = min(n, capacity // length)
                combo, times = (length,) * fit, n // fit
                n -= fit * times
                bins[capacity - length * fit].append((combo, times))
            else:
                combo, times = bins[gap].pop()
                put = min(n, times)
                if put < times:
                    bins[gap].append((combo, times - put))
                n -= put
                bins[gap - length].append(((*combo, length), put))
    return out + [b for g in sorted(bins) for b in bins[g]]


class SumIndex:
    """The available lengths by the sums of one, two and three of them.

    ``have`` is the caller's list of counts by length, which only fall. A sum's
    entry lists the smaller lengths of its pairs, or the third lengths beside an
    indexed pair; a combination leaves its entry when it is met and its counts
    have run out. There are at most capacity^2 / 4 pairs; entries become lists
    when their sum is first asked for.
    """

    def __init__(self, have: list[int], capacity: int):
        self.have, self.capacity = have, capacity
        self.lengths = np.flatnonzero(have[:capacity])
        i, j = np.triu_indices(len(self.lengths))
        total = self.lengths[i] + self.lengths[j]
        fits = total < capacity
        small, total = self.lengths[i[fits]], total[fits]
        # by sum, then by the smaller length from the largest: entries are used up from their end
        order = np.lexsort((-small, total))
        self.small = small[order].astype(np.int32)
        self.start = np.searchsorted(total[order], np.arange(capacity + 1))
        self.pairs: dict[int, list[int]] = {}
        self.thirds: dict[int, list[int]] = {}

    def complement(self, length: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill the gap beside one ``length``; the largest first."""
        have, gap = self.have, self.capacity - length
        have[length] -= 1
        try:
            if have[gap] > 0:
                return (gap,)
            if pair := self._pair(gap, (length,)):
                return pair
            thirds = self._thirds(gap)
            while thirds:
                third = thirds[-1]
                if have[third] > 0:
                    have[third] -= 1
                    pair = self._pair(gap - third, (length, third))
                    have[third] += 1
                    if pair:
                        return (third, *pair)
                thirds.pop()  # counts only fall, and no other length has this gap
            return None
        finally:
            have[length] += 1

    def _thirds(self, total: int) -> list[int]:
        """The entry of the sum of three: lengths beside which the rest is a sum of two."""
        if total not in self.thirds:
            third = self.lengths[self.lengths < total]
            rest = total - third
            self.thirds[total] = third[self.start[rest + 1] > self.start[rest]].tolist()
        return self.thirds[total]

    def _pair(self, total: int, taken: tuple[int, ...]) -> tuple[int, int] | None:
        """Two available lengths of that sum, the larger as large as can be; ``taken`` are held back for now."""
        if total not in self.pairs:
            self.pairs[total] = self.small[self.start[total]: self.start[total + 1]].tolist()
        entry, have = self.pairs[total], self.have
        for k in range(len(entry) - 1, -1, -1):
            a = entry[k]
            b = total - a
            if have[b] > 0 and have[a] > (a == b):
                return b, a
            if a not in taken and b not in taken:
                del entry[k]
        return None


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first numbers of its intervals, the sequence of each first number, and the offset there."""
    by: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    first = 0
    for combo, times in patterns:
        at = 0
        for length in combo:
            by[length].append((used[length], first, at))
            used[length] += times
            at += length
        first += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for k, v in by.items()}


def pack(docs: DataFrame, work: Work, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; tokens are made once and stored (ids only if asked for)."""
    spark = docs.sparkSession
    cut = work.store(token_pieces(docs, tokenizer, capacity, with_ids, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    table = spark.sparkContext.broadcast(places(plan(counts, capacity)))
    buckets = max(1, -(-max(counts.values(), default=0) // BUCKET_ROWS))
    rows = numbered(cut, ["length"], "xxhash64(row_key, piece)", "rank", buckets, ["row_key", "piece", "doc_id"])
    names = cut.columns
    schema = cut.schema.add("sequence_id", "long").add("offset", "long")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for v in np.unique(length).tolist():
                mine = length == v
                starts, first, at = table.value[v]
                i = np.searchsorted(starts, rank[mine], "right") - 1
                seq[mine], offset[mine] = first[i] + rank[mine] - starts[i], at[i]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(seq), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return rows.mapInArrow(look_up, schema)
