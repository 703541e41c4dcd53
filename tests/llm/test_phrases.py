"""Operator 11 against dictionaries of all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from shopframe.llm import phrases
from shopframe.llm.common import Work

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top, limit, absorb=100):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, top + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i: i + k])] += 1
    f = {g: a for g, a in f.items() if a >= least}
    longest = Counter()
    for (lang, g), a in f.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                longest[lang, g[i: i + k]] = max(longest[lang, g[i: i + k]], a)
    out = {}
    for (lang, g), a in f.items():
        if len(g) < 2 or longest[lang, g] * 100 >= absorb * a:
            continue
        score, _, le, r = min((1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), le, r))
    return sorted((lang, i + 1, g.decode(), -a, le, r, n[lang], -s) for lang, v in out.items() for i, (s, a, g, le, r) in enumerate(sorted(v)[:limit]))


def texts(seed, n=400):
    r = random.Random(seed)
    vocab = ["the", "The", "of", "a", "b", "é", "É", "日本", "x\x00y", "q" * 50] + [f"w{i}" for i in range(60)]
    fixed = ["a b c d e f", "de la  mer", "la\tmer", "w1 w2 w1 w2 w1"]
    rows = []
    for _ in range(n):
        t = ""
        for _ in range(r.randint(0, 40)):
            t += (r.choice(fixed) if r.random() < 0.3 else r.choice(vocab[: r.choice([4, 70])])) + r.choice([" "] * 8 + ["\t", "  ", ". ", ",", "\n", " ! ", "\x0b"])
        rows.append((r.choice(["en", "en", "en", "fr", None, "und", ""]), t))
    return rows + [("en", None), ("en", ""), ("en", " . "), (None, "a b " * 3000), *[rows[3]] * 30]


@pytest.mark.parametrize("seed, least, top, absorb", [(1, 20, 5, 100), (2, 5, 3, 100), (3, 40, 5, 80), (4, 100000, 5, 100)])
def test_collocations(spark, seed, least, top, absorb, monkeypatch):
    rows = texts(seed)
    if seed == 2:  # blocks and gathered rows split in many parts
        monkeypatch.setattr(phrases, "BLOCK_BYTES", 2000)
        monkeypatch.setattr(phrases, "GATHER", 100)
    if seed == 3:  # too many languages to broadcast
        monkeypatch.setattr(phrases.with_totals, "__defaults__", (2, 5))
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "lang string, text string, a string, n int, phrase string").repartition(6)
    got = phrases.top_phrases(phrases.collocations(docs, Work(spark, "t11"), least, top, absorb), 50, 3)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top, 50, absorb)


@pytest.mark.parametrize("seed", range(6))
def test_summary_keeps_the_frequent(seed):
    r = random.Random(seed)
    stream = [int(min(5000, r.paretovariate(0.6))) for _ in range(30_000)]
    least = r.choice([100, 300])
    s = phrases.MisraGries(len(stream) // least + 1)
    while stream_part := stream[: (n := r.randint(1, 9000))]:
        stream = stream[n:]
        s.add(*np.unique(np.array(stream_part, np.uint64), return_counts=True))
        s.merge()
        assert len(s.keys) <= s.capacity
    r = random.Random(seed)
    true = Counter(int(min(5000, r.paretovariate(0.6))) for _ in range(30_000))
    assert s.error < least
    kept = dict(zip(s.keys.tolist(), s.counts.tolist(), strict=True))
    assert all(true[k] - s.error <= c <= true[k] for k, c in kept.items())
    assert {k for k, c in true.items() if c >= least} <= set(s.frequent(least).tolist())


def test_packed_round_trip():
    r = np.random.default_rng(1)
    for n in (1, 2, 5000):
        keys = np.unique(r.integers(0, 2**58, n, dtype=np.uint64)) | np.uint64(5 << 58)
        counts = r.integers(1, 70_000, len(keys))
        k, c = phrases.unpacked(5, *phrases.packed(keys, counts, 58), 58)
        assert (k == keys).all() and (c == counts).all()


def test_nothing(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.top_phrases(phrases.collocations(none, Work(spark, "t11"))).collect() == []
