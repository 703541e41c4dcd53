"""Operator 12, token counts by rank-synchronous array merging.

A byte-level BPE vocabulary is read on the driver into three arrays (pairs in
order, their ranks, and by rank the symbols they make; one entry per merge) and broadcast.
A worker cuts texts into units (white space and the word after it), counts
each distinct unit once and remembers the count by the unit's hash. The
pre-tokens of new units are held together as one ragged array of symbols. In
each round, every sequence looks up the ranks of its adjacent pairs, finds its
own lowest rank, and merges all places of that pair from left to right; all
sequences do so at the same time. A sequence without a known pair leaves with
as many tokens as it has symbols.

A merge can only use symbols that bytes or merges of lower rank made (checked
when the vocabulary is read), so a sequence's ranks rise from round to round
and merging all places at once equals merging them one after another. Long
pre-tokens take as many rounds as they have different merges.

Special tokens of the vocabulary count as one token where they stand in a
text. Pre-tokens are those of the vocabulary's own split: contractions,
letters, digits and other signs, each with a space in front, and white space.
The split never joins a word with white space after it, so units can be counted
one by one; texts with white space outside ASCII are split as a whole.

A null or empty text has no bytes and no tokens. Every row is counted, repeated
ones too; a null id is passed on. A text of any length is counted whole by one
worker, in about 50 bytes per byte of it. An empty table gives no rows; columns
other than the two named are not read, whatever their names. There is no
shuffle.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textwords import IS_WORD, buffer_of, pieces, span_hashes, worker_memory

SCHEMA = "doc_id long, n_bytes long, n_tokens long"
#: units that a worker remembers at most
REMEMBERED = 1 << 20
NO_RANK = np.iinfo(np.int64).max
# Unicode's white space outside ASCII, and the split of the
# published vocabulary with that white space written out.
WIDE = "\x85\xa0  -     　"
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + r"\x09-\x0d\x20" + WIDE + r"\p{L}\p{N}]+"
         + r"|[\x09-\x0d\x20" + WIDE + r"]+(?![^\x09-\x0d\x20" + WIDE + r"])|[\x09-\x0d\x20" + WIDE + "]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others follow from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """Merges of a byte-level BPE: pairs in order with their ranks, and by rank the symbol that is made."""

    byte_id: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    specials: list[str] = field(default_factory=list)

    @classmethod
    def read(cls, text: str) -> Vocabulary:
        """From the JSON of a ``tokenizers`` file; anything but plain byte-level BPE is an error."""
        j = json.loads(text)
        model, pre = j["model"], j["pre_tokenizer"] or {}
        plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and not j["normalizer"] and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")))
        added = j.get("added_tokens") or []
        if not plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] or any(c.isspace() for c in t["content"]) for t in added):
            raise ValueError("only byte-level BPE without prefix space, normalizer, dropout or stripping special tokens is supported")
        ids = model["vocab"]
        byte_id = np.array([ids[c] for c in byte_symbols()], np.int64)
        born = dict.fromkeys(byte_id.tolist(), -1)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pairs, made = np.zeros(len(merges), np.int64), np.zeros(len(merges), np.int64)
        for r, (a, b) in enumerate(merges):
            x, y, z = ids[a], ids[b], ids[a + b]
            if x not in born or y not in born or z in born:
                raise ValueError("a merge uses a symbol before it is made, or makes one again")
            born[z] = r
            pairs[r], made[r] = x << 32 | y, z
        order = np.argsort(pairs)
        return cls(byte_id, pairs[order], order.astype(np.int64), made, [t["content"] for t in added])

    def surviving(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols of each pre-token after all merges."""
        out = np.array([len(t) for t in tokens], np.int64)
        symbols = self.byte_id[np.frombuffer(b"".join(tokens), np.uint8)]
        which = np.repeat(np.arange(len(tokens)), out)  # the sequence of each symbol
        rank = np.full(len(symbols), NO_RANK)  # of the pair that begins at each symbol
        self._look_up(rank, symbols, which, np.arange(len(symbols)))
        while len(symbols):
            head = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            size = np.diff(head, append=len(which))
            lowest = np.minimum.reduceat(rank, head)
            done = lowest == NO_RANK
            out[which[head[done]]] = size[done]
            at = np.flatnonzero((rank == np.repeat(lowest, size)) & (rank < NO_RANK))
            if not len(at):
                break
            # equal symbols in a row overlap: from the left, every other place
            begin = np.maximum.accumulate(np.where(np.append(True, np.diff(at) != 1), at, 0))
            at = at[(at - begin) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            stay = np.repeat(~done, size)
            stay[at + 1] = False
            symbols, which, rank = symbols[stay], which[stay], rank[stay]
            at = np.cumsum(stay)[at] - 1
            self._look_up(rank, symbols, which, np.concatenate([at, at[at > 0] - 1]))
        return out

    def _look_up(self, rank: np.ndarray, symbols: np.ndarray, which: np.ndarray, at: np.ndarray) -> None:
        """Sets the ranks of the pairs that begin at the given places."""
        rank[at] = NO_RANK
        at = at[at < len(symbols) - 1]
        at = at[which[at] == which[at + 1]]
        if len(self.pairs):
            key = symbols[at] << 32 | symbols[at + 1]
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            rank[at] = np.where(self.pairs[place] == key, self.ranks[place], NO_RANK)


class Counter:
    """Counts the tokens of texts, each distinct unit once."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(SPLIT)
        self.special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.specials, key=len, reverse=True)))) if vocabulary.specials else None
        self.wide = regex.compile(f"[{WIDE}]")
        self.clear()

    def clear(self) -> None:
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def of_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text, by its distinct pre-tokens."""
        seen: dict[str, int] = {}
        what, where, special = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = [text]
            if self.special and (n := len(self.special.findall(text))):
                special[i], parts = n, self.special.split(text)
            for part in parts:
                found = self.split.findall(part)
                what += [seen.setdefault(t, len(seen)) for t in found]
                where += [i] * len(found)
        n = self.vocabulary.surviving([t.encode() for t in seen])
        return special + np.bincount(np.array(where, np.int64), n[np.array(what, np.int64)], minlength=len(texts)).astype(np.int64)

    def of_rows(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Tokens of each row of a string column."""
        word = IS_WORD[buf]
        head = ~word
        head[1:] &= word[:-1]
        head[off[:-1][off[:-1] < len(buf)]] = True
        s = np.flatnonzero(head)
        e = np.append(s[1:], len(buf))
        key, at, back = np.unique(span_hashes(buf, s, e), return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.clear()
        place = np.searchsorted(self.keys, key)
        new = np.append(self.keys, np.uint64(0))[place] != key if len(self.keys) else np.ones(len(key), bool)
        new |= place == len(self.keys)
        data = buf.tobytes()
        if new.any():
            counts = self.of_texts([data[s[i]: e[i]].decode() for i in at[new]])
            self.counts = np.insert(self.counts, place[new], counts)
            self.keys = np.insert(self.keys, place[new], key[new])
        n = self.counts[np.searchsorted(self.keys, key)][back]
        row = np.searchsorted(off, s, "right") - 1
        out = np.bincount(row, n, minlength=len(off) - 1).astype(np.int64)
        if self.wide.search(data.decode()):
            texts = [(i, t) for i in range(len(off) - 1) if self.wide.search(t := data[off[i]: off[i + 1]].decode())]
            for i, t in texts:
                out[i] = self.of_texts([t])[0]
        return out


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row. The vocabulary's size is fixed, whatever the data."""
    shared, name = docs.sparkSession.sparkContext.broadcast(vocabulary), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_memory("token_counters")
        if name not in kept:
            kept.clear()
            kept[name] = Counter(shared.value)
        counter = kept[name]
        for batch in batches:
            buf, off = buffer_of(batch.column("text"))
            n = [counter.of_rows(buf[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]) for lo, hi in pieces(off)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(off)), pa.array(np.concatenate(n) if n else np.zeros(0, np.int64))], names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
