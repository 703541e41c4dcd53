"""Operator 1, LM scoring: interpolated modified Kneser-Ney.

Tokens are the lower-case (A-Z) words of a text and one end token; the first
word follows ``order - 1`` start tokens. Words are counted first and stored as
sorted arrays of 64-bit hashes; a word's place in them is its dense rank.
n-grams are counted in Spark as ranks packed into 64-bit numbers: tasks count
what they read into sorted runs, exchange these runs delta-coded by shard, and
merge them. The model is stored as sorted hash arrays in the shared folder:

* per shard and level k >= 2: ``gram``, hashes with adjusted counts, and
  ``ctx``, hashes with (sum of counts, contexts' numbers of grams with count
  1, 2 and 3 or more);
* per shard of words: raw counts and numbers of distinct left neighbours.

Workers memory-map these arrays, one file a shard and kind, and look a block of
documents up in them shard by shard. A shard follows the last word of the
context, which the contexts of all levels end with, so one exchange completes
the n-grams and the contexts of every level. Words so frequent that they could
fill a shard are dealt by the last word as well; the partial sums of contexts
that end with them are merged in a further exchange. The frequent words are at
most ``HOT_PARTS * shards`` by their definition; the driver holds them and the
number of words of each shard.

An array keeps 32 bits of a hash below those that its index of about sixteen
entries a step settles: an n-gram that was never seen is taken for another one
with a probability of about 4e-9. Hashes of n-grams that fit 64 bits of ranks
have no collision before that.

Discounts are those of Chen and Goodman, from the counts of counts of each
level (with 0.5, 1, 1.5 where a corpus is too small to have them). The lowest
level interpolates with a uniform distribution over the known tokens and one
unknown one, so every level sums to one.

A null text is empty, that is one end token. A null id counts as the empty
text for the split. Repeated rows count and are scored each. Without training
rows the score is that of the uniform distribution. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work
from .hasharrays import bundle, found, opened, table
from .store_files import put
from .textwords import buffer_of, mix, pieces, words_of, worker_memory

END = np.uint64(0xFEDCBA9876543210)
HOT_PARTS = 4
#: tokens that a task gathers before it hands their counts on, tokens of a shard, bytes of a block of texts
GATHER, SHARD_TOKENS, BLOCK_BYTES = 1 << 22, 3 << 20, 1 << 22
ROW = "shard int, kind string, data binary"
NUMBERS = ("total", "entries", "n1", "n2", "n3", "n4")
STATS = "shard int, kind string, " + ", ".join(f"{c} long" for c in NUMBERS)


def joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a context followed by a word."""
    return mix(context * np.uint64(0xD6E8FEB86659FD93) + word)


def token_rows(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the rows, each closed by an end token, and the rows' offsets."""
    h, _, _, first = words_of(buf, off, lower=True)
    n = len(off) - 1
    tokens = np.full(len(h) + n, END, np.uint64)
    row = np.repeat(np.arange(n), np.diff(first))
    tokens[np.arange(len(h)) + row] = h
    return tokens, first + np.arange(n + 1)


def columns(ranks: np.ndarray, first: np.ndarray, order: int, start: int) -> list[np.ndarray]:
    """The ``order - 1`` tokens before each token, from the farthest, and the token (``start`` before a row)."""
    place = np.arange(len(ranks)) - np.repeat(first[:-1], np.diff(first))
    out = [ranks]
    for t in range(1, order):
        b = np.full(len(ranks), start, np.uint64)
        b[t:] = ranks[: len(ranks) - t]
        b[place < t] = start
        out.insert(0, b)
    return out


@dataclass
class Packing:
    """Ranks of ``bits`` bits as 64-bit numbers, as many ranks in each as fit."""

    bits: int

    def numbers(self, cols: list[np.ndarray]) -> list[np.ndarray]:
        per, out = 64 // self.bits, []
        for i in range(0, len(cols), per):
            x = cols[i]
            for c in cols[i + 1: i + per]:
                x = (x << np.uint64(self.bits)) | c
            out.append(x)
        return out

    def columns(self, numbers: list[np.ndarray], n: int) -> list[np.ndarray]:
        per, mask = 64 // self.bits, np.uint64((1 << self.bits) - 1)
        place = [(i // per, min(per, n - i // per * per) - 1 - i % per) for i in range(n)]
        return [(numbers[k] >> np.uint64(shift * self.bits)) & mask for k, shift in place]

    def hashes(self, cols: list[np.ndarray]) -> np.ndarray:
        first, *rest = self.numbers(cols)
        h = mix(first + np.uint64(len(cols)))
        for x in rest:
            h = joined(h, x)
        return h


def new_rows(keys: list[np.ndarray]) -> np.ndarray:
    """Places of sorted tuples that differ from those before them."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def merge(keys: list[np.ndarray], values: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct tuples of keys in order, with the sums of their rows of values (without values: how often they occur)."""
    n = len(keys[0])
    if not n:
        return keys, np.zeros((0, 1 if values is None else values.shape[1]), np.int64)
    if values is None and len(keys) == 1:
        keys = [np.sort(keys[0])]
    else:
        order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
        keys = [k[order] for k in keys]
        values = None if values is None else values[order]
    at = new_rows(keys)
    sums = np.diff(np.append(at, n))[:, None] if values is None else np.add.reduceat(values, at)
    return [k[at] for k in keys], sums


def _squeezed(a: np.ndarray) -> bytes:
    """The bytes of 64-bit numbers, first all lowest ones, then the next: high bytes of small numbers vanish."""
    return pa.compress(np.ascontiguousarray(a.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes(), "zstd", asbytes=True)


def _unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, n * 8, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)


def packed(keys: list[np.ndarray], values: np.ndarray) -> bytes:
    """Sorted keys, the first one by its differences, and their rows of values."""
    parts = [_squeezed(a) for a in (np.diff(keys[0], prepend=np.uint64(0)), *keys[1:], *values.T)]
    return np.array([len(values), len(keys), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def unpacked(data: list[bytes], n_keys: int, width: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
    """All rows of several packed runs, one after another."""
    runs = []
    for d in data:
        n, _, *sizes = np.frombuffer(d, np.int64, 2 + n_keys + width).tolist()
        at = np.cumsum([8 * (2 + n_keys + width), *sizes]).tolist()
        cols = [_unsqueezed(d[a:b], n) for a, b in zip(at, at[1:], strict=False)]
        runs.append([np.cumsum(cols[0], dtype=np.uint64), *cols[1:]])
    cols = [np.concatenate(c) for c in zip(*runs, strict=True)]
    return cols[:n_keys], np.stack(cols[n_keys:], axis=1).astype(np.int64)


def by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shards and the places of their rows, in order."""
    order = np.argsort(shard.astype(np.uint16) if len(shard) and shard.max() < 1 << 16 else shard, kind="stable")
    at = new_rows([shard[order]]) if len(shard) else np.zeros(0, np.int64)
    for rows in np.split(order, at[1:]) if len(at) else ():
        yield int(shard[rows[0]]), rows


def dealt(kind: str, shard: np.ndarray, keys: list[np.ndarray], values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A packed row per shard."""
    for s, rows in by_shard(shard):
        yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([kind]), pa.array([packed([k[rows] for k in keys], values[rows])], pa.binary())], names=["shard", "kind", "data"])


@dataclass
class Split:
    """Which shard an n-gram belongs to: that of its context's last word, or of its last two words if that one is frequent."""

    shards: int
    hot: np.ndarray

    def by(self, key: np.ndarray) -> np.ndarray:
        return (mix(key + np.uint64(1)) % np.uint64(self.shards)).astype(np.int64)

    def frequent(self, word: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(word), bool)
        return self.hot[np.minimum(np.searchsorted(self.hot, word), len(self.hot) - 1)] == word

    def of(self, cols: list[np.ndarray]) -> np.ndarray:
        if len(cols) == 1:
            return self.by(cols[0])
        key, many = cols[-2].copy(), self.frequent(cols[-2])
        key[many] = joined(key[many], cols[-1][many])
        return self.by(key)


@dataclass
class Vocabulary:
    """Dense ranks of the stored words: a shard's words come after those of the shards before it."""

    folder: str
    split: Split
    bases: np.ndarray

    @property
    def known(self) -> int:
        return int(self.bases[-1])

    @property
    def start(self) -> int:
        return self.known

    @property
    def packing(self) -> Packing:
        return Packing((self.known + 1).bit_length())

    def ranks(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and training counts of tokens; an unknown one has the rank after the start token's."""
        word, back = np.unique(tokens, return_inverse=True)
        rank, count = np.full(len(word), self.known + 1, np.uint64), np.zeros(len(word), np.int64)
        for s, rows in by_shard(self.split.by(word)):
            if self.bases[s] < self.bases[s + 1]:
                have = _arrays(self.folder, f"word-{s}")
                i = np.minimum(np.searchsorted(have["hash"], word[rows]), len(have["hash"]) - 1)
                hit = have["hash"][i] == word[rows]
                rank[rows[hit]] = (i[hit] + self.bases[s]).astype(np.uint64)
                count[rows[hit]] = have["count"][i[hit]]
        return rank[back], count[back]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        buf, off = buffer_of(batch.column("text"))
        for lo, hi in pieces(off, BLOCK_BYTES):
            yield (batch, lo, hi, *token_rows(buf[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]))


def _gathered(keys: Iterator[list[np.ndarray]], deal) -> Iterator[pa.RecordBatch]:
    """Counts of key tuples, dealt now and then, so that memory stays bounded."""
    held, n = [], 0
    for k in keys:
        held.append(k)
        n += len(k[0])
        if n >= GATHER:
            yield from deal(*merge([np.concatenate(c) for c in zip(*held, strict=True)]))
            held, n = [], 0
    if n:
        yield from deal(*merge([np.concatenate(c) for c in zip(*held, strict=True)]))


def _count_words(split: Split):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(([tokens] for *_, tokens, _ in _blocks(batches)), lambda k, n: dealt("word", split.by(k[0]), k, n))
    return run


def _count_grams(order: int, words: Vocabulary, split: Split):
    """Counts of the n-grams of the highest level."""
    pack = words.packing

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for *_, tokens, first in _blocks(batches):
            yield pack.numbers(columns(words.ranks(tokens)[0], first, order, words.start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _gathered(keys(batches), lambda k, n: dealt("gram", split.of(pack.columns(k, order)), k, n))

    return run


def _numbers(values: np.ndarray) -> list[int]:
    """Sum, number, and numbers of values 1 to 4."""
    return [int(values.sum()), len(values), *[int((values == i).sum()) for i in range(1, 5)]]


def _stats(shard: int, found: dict[str, list[int]]) -> pa.Table:
    return pa.table([pa.array([shard] * len(found), pa.int32()), pa.array(list(found), pa.string()),
                     *[pa.array([n[i] for n in found.values()], pa.int64()) for i in range(len(NUMBERS))]], names=["shard", "kind", *NUMBERS])


def _words(folder: str):
    """Stores a shard of words with their counts, and hands on its statistics."""
    def run(rows: pa.Table) -> pa.Table:
        shard = int(rows.column("shard")[0].as_py())
        (word,), n = merge(*unpacked(rows.column("data").to_pylist(), 1))
        put(folder, f"word-{shard}", bundle({"hash": word, "count": n[:, 0].astype(np.min_scalar_type(int(n.max())))}))
        return _stats(shard, {"word": _numbers(n[:, 0])})
    return run


def _frequent(words: Vocabulary, least: float):
    """The ranks of the words that are more frequent than ``least``, for ids of shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.column("id").to_pylist():
                if words.bases[s] < words.bases[s + 1]:
                    many = np.flatnonzero(_arrays(words.folder, f"word-{s}")["count"] > least) + words.bases[s]
                    yield pa.RecordBatch.from_arrays([pa.array(many, pa.int64())], names=["rank"])
    return run


def _levels(order: int, pack: Packing, split: Split, folder: str):
    """Merges a shard's n-grams, stores those and the contexts of every level, and hands on what other shards complete."""
    def run(rows: pa.Table) -> pa.Table:
        shard = int(rows.column("shard")[0].as_py())
        keys, values = merge(*unpacked(rows.column("data").to_pylist(), -(-order // (64 // pack.bits))))
        out, store = [], {}
        for level in range(order, 1, -1):
            cols, n = pack.columns(keys, level), values[:, 0]
            store |= table(f"gram{level}", pack.hashes(cols), values)
            at = new_rows(cols[:-1])  # the n-grams of a context stand together
            many = np.add.reduceat(np.stack([n, n == 1, n == 2, n >= 3], axis=1).astype(np.int64), at)
            context = [c[at] for c in cols[:-1]]
            hot, h = split.frequent(context[-1]), pack.hashes(context)
            store |= table(f"ctx{level}", h[~hot], many[~hot])
            out += dealt(f"ctx{level}", split.by(h[hot]), [k[hot] for k in pack.numbers(context)], many[hot])
            out.append(pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([f"stats{level}"]), pa.array([np.array(_numbers(n), np.int64).tobytes()], pa.binary())], names=["shard", "kind", "data"]))
            keys, values = merge(pack.numbers(cols[1:]))
        out += dealt("low", split.by(keys[0]), keys, values)
        put(folder, f"gram-{shard}", bundle(store))
        return pa.Table.from_batches(out)
    return run


def _last(order: int, pack: Packing, folder: str):
    """Stores a shard's frequent contexts and words' numbers of left neighbours, and hands on all statistics."""
    def run(rows: pa.Table) -> pa.Table:
        shard, kind = int(rows.column("shard")[0].as_py()), np.array(rows.column("kind").to_pylist())
        data, store, stats = rows.column("data").to_pylist(), {}, {}
        of = lambda k: [data[i] for i in np.flatnonzero(kind == k)]
        for level in range(2, order + 1):
            if runs := of(f"ctx{level}"):
                keys, many = merge(*unpacked(runs, -(-(level - 1) // (64 // pack.bits)), 4))
                store |= table(f"ctx{level}", pack.hashes(pack.columns(keys, level - 1)), many)
            if runs := of(f"stats{level}"):
                stats[f"gram{level}"] = np.frombuffer(runs[0], np.int64).tolist()
        if runs := of("low"):
            (word,), n = merge(*unpacked(runs, 1))
            store |= table("low", pack.hashes([word]), n)
            stats["low"] = _numbers(n[:, 0])
        put(folder, f"last-{shard}", bundle(store))
        return _stats(shard, stats)
    return run


def _discounts(n: list[int]) -> np.ndarray:
    """D(0), D(1), D(2), D(3 and more) from the numbers of n-grams with count 1 to 4."""
    if min(n[:4]) <= 0:
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    d = [0.0, 1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return np.array([min(max(x, 0.0), float(i)) for i, x in enumerate(d)])


@dataclass
class Model:
    """What the workers need beside the stored arrays: a few numbers, the frequent words and the shards' sizes."""

    folder: str
    order: int
    split: Split
    words: Vocabulary
    tokens: int
    discounts: list[np.ndarray]
    low_stats: list[int]

    @property
    def known(self) -> int:
        return self.words.known

    def _look_up(self, kind: str, name: str, shard: np.ndarray, h: np.ndarray, width: int = 1) -> np.ndarray:
        """Stored numbers of hashes (zero where there is none)."""
        out = np.zeros((len(h), width), np.int64)
        for s, rows in by_shard(shard):
            if (have := _arrays(self.folder, f"{kind}-{s}")) is not None:
                out[rows] = found(have, name, h[rows], width)
        return out

    def score(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token: training count, and log10 of the model's probability."""
        pack = self.words.packing
        rank, seen = self.words.ranks(tokens)
        word, back = np.unique(rank, return_inverse=True)
        low = self._look_up("last", "low", self.split.by(word), pack.hashes([word]))[:, 0]
        d, (total, many, n1, n2, _n3, _n4) = self.discounts[0], self.low_stats
        if total:
            more = many - n1 - n2
            left = (d[1] * n1 + d[2] * n2 + d[3] * more) / total
            p = (low - d[np.minimum(low, 3)]) / total + left / (self.known + 1)
        else:
            p = np.full(len(word), 1 / (self.known + 1))
        p = p[back]
        cols = columns(rank, first, self.order, self.words.start)
        for level in range(2, self.order + 1):
            own = cols[self.order - level:]
            d, h, hot = self.discounts[level - 1], pack.hashes(own[:-1]), self.split.frequent(own[-2])
            sums = np.zeros((len(h), 4), np.int64)
            sums[hot] = self._look_up("last", f"ctx{level}", self.split.by(h[hot]), h[hot], 4)
            sums[~hot] = self._look_up("gram", f"ctx{level}", self.split.by(own[-2][~hot]), h[~hot], 4)
            total, n1, n2, n3 = sums.T
            n = self._look_up("gram", f"gram{level}", self.split.of(own), pack.hashes(own))[:, 0]
            whole = np.maximum(total, 1)
            mine = (n - d[np.minimum(n, 3)]) / whole + (d[1] * n1 + d[2] * n2 + d[3] * n3) / whole * p
            p = np.where(total > 0, mine, p)
        return seen, np.log10(p)


def _arrays(folder: str, name: str) -> dict[str, np.ndarray] | None:
    """The mapped arrays of a file; a worker keeps the last few hundred open."""
    maps = worker_memory("maps")
    if (folder, name) not in maps:
        if len(maps) >= 512:
            maps.pop(next(iter(maps)))
        try:
            maps[folder, name] = opened(folder, name)
        except FileNotFoundError:  # no row belongs to this shard
            maps[folder, name] = None
    return maps[folder, name]


def train(texts: DataFrame, work: Work, order: int = 2) -> Model:
    """Counts ``texts`` (a ``text`` column without nulls) and stores the model."""
    spark, folder = texts.sparkSession, work.path("model")
    size = texts.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    shards = max(4, -(-((size[0] or 0) // 6 + size[1]) // SHARD_TOKENS))
    split = Split(shards, np.zeros(0, np.uint64))
    texts = texts.select("text")
    stored = work.store(texts.mapInArrow(_count_words(split), ROW).groupBy("shard").applyInArrow(_words(folder), STATS), "words")
    sizes = np.zeros(shards + 1, np.int64)
    tokens = 0
    for r in stored.select("shard", "total", "entries").toLocalIterator():  # two numbers a shard
        sizes[r["shard"] + 1], tokens = r["entries"], tokens + r["total"]
    words = Vocabulary(folder, split, np.cumsum(sizes))
    least = tokens / (HOT_PARTS * shards)
    ids = spark.range(0, shards, 1, min(shards, 64))
    hot = [r[0] for r in ids.mapInArrow(_frequent(words, least), "rank long").toLocalIterator()]
    if size[1] > least:
        hot.append(words.start)
    dealer = Split(shards, np.sort(np.array(hot, np.uint64)))
    entries = texts.mapInArrow(_count_grams(order, words, dealer), ROW).groupBy("shard").applyInArrow(_levels(order, words.packing, dealer, folder), ROW)
    done = work.store(entries.groupBy("shard").applyInArrow(_last(order, words.packing, folder), STATS), "stats")
    sums = {r["kind"]: list(r)[1:] for r in done.groupBy("kind").agg(*[F.sum(c) for c in NUMBERS]).collect()}
    none = [0] * len(NUMBERS)
    kinds = ["low", *(f"gram{level}" for level in range(2, order + 1))]
    work.drop("words", "stats")
    return Model(folder, order, dealer, words, tokens, [_discounts(sums.get(k, none)[2:]) for k in kinds], sums.get("low", none))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, perplexity): one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, lo, hi, tokens, first in _blocks(batches):
            seen, logp = model.score(tokens, first)
            base = np.log10((seen + 0.1) / (model.tokens + 0.1 * (model.known + 1)))
            n, total = np.diff(first), np.add.reduceat(logp, first[:-1])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(n), pa.array(np.add.reduceat((seen > 0).astype(np.int64), first[:-1])),
                                              pa.array(np.add.reduceat(base, first[:-1])), pa.array(total), pa.array(10 ** (-total / n))],
                                             names=["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double, perplexity double")


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text has remainder 0 by 10."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0
