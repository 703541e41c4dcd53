"""Operators 2 and 4 against brute force, and their parts."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from shopframe.llm import anchors, fmindex, suffixes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(seqs, width):
    """Covered places of each sequence by windows that start more than once anywhere."""
    n = Counter(bytes(s[i:i + width]) if isinstance(s, bytes) else tuple(s[i:i + width]) for s in seqs for i in range(len(s) - width + 1))
    out = []
    for s in seqs:
        cover = [False] * len(s)
        for i in range(len(s) - width + 1):
            if n[bytes(s[i:i + width]) if isinstance(s, bytes) else tuple(s[i:i + width])] > 1:
                cover[i:i + width] = [True] * width
        out.append(cover)
    return out


def check(got, rows, split, join, width):
    seqs = [split((r[1] or "").encode()) for r in rows]
    want = {}
    for r, s, c in zip(rows, seqs, brute(seqs, width)):
        runs = sum(x and not (i and c[i - 1]) for i, x in enumerate(c))
        want[r[0]] = (len(s), sum(c), runs, hashlib.sha256(join([x for x, y in zip(s, c) if not y])).hexdigest())
    assert len(got) == len(rows)
    for g in got:
        assert (g["n"], g["n_removed"], g["n_spans"], g["kept_sha256"]) == want[g["doc_id"]], g
    assert sum(v[1] for v in want.values()) > 100


@pytest.mark.parametrize("width,gram,hot", [(35, 6, 4096), (35, 6, 1), (8, 3, 4096), (8, 3, 2)])
def test_words(docs, rows, work, monkeypatch, width, gram, hot):
    monkeypatch.setattr(anchors, "ANCHOR_SEGMENTS", hot)
    got = fmindex.substring_dedup(docs, work, width, gram, shard_symbols=2000).collect()
    check(got, rows, WORD.findall, b" ".join, width)


@pytest.mark.parametrize("width,gram,hot", [(400, 24, 4096), (60, 12, 4096), (60, 12, 2), (30, 8, 4096)])
def test_bytes(docs, rows, work, monkeypatch, width, gram, hot):
    monkeypatch.setattr(anchors, "ANCHOR_SEGMENTS", hot)
    monkeypatch.setattr(suffixes, "RUN_BYTES", 3000)
    short = [r for r in rows if len(r[1] or "") < 9000]
    got = suffixes.suffix_dedup(docs.where("length(text) < 9000 or text is null"), work, width, gram, shard_symbols=20000).collect()
    check(got, short, lambda b: b, bytes, width)


def test_segments_own_every_window_once():
    r = np.random.default_rng(1)
    for n in (0, 34, 35, 36, 500, 70000):
        sym = r.integers(0, 9, n).astype(np.uint64)
        start, count, place, _, _ = anchors.segments(sym, anchors.Kind(True, 35, 6, 1))
        assert count.sum() == max(0, n - 34) and (np.cumsum(count) - count == start).all()
        assert ((place >= count - 1) & (place <= 29)).all()


def test_window_weights():
    r = random.Random(4)
    seqs = [np.array([r.randrange(3) for _ in range(r.randint(5, 40))], np.uint64) for _ in range(50)]
    weights = np.array([r.randint(1, 3) for _ in seqs])
    n = Counter()
    for s, w in zip(seqs, weights):
        for i in range(len(s) - 4):
            n[tuple(s[i:i + 5])] += int(w)
    for s, got in zip(seqs, fmindex.window_weights(seqs, weights, 5)):
        assert got.tolist() == [n[tuple(s[i:i + 5])] for i in range(len(s) - 4)]


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7])
def test_merge_runs(k):
    r = random.Random(k)
    runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 200))) * r.choice([1, 1, 2]) for _ in range(r.randint(0, 60))) for _ in range(k)]
    runs += [list(runs[0])] if runs else []
    got = list(suffixes.merge_runs([suffixes.decode(*suffixes.front_code(x)) for x in runs])) if runs else []
    assert [s for _, s, _ in got] == sorted(s for x in runs for s in x)
    last = b""
    for _, s, n in got[0:]:
        assert n == suffixes.common(last, s, 0) or last == b""
        last = s


def test_empty(no_docs, work):
    assert fmindex.substring_dedup(no_docs, work).collect() == []
    assert suffixes.suffix_dedup(no_docs, work).collect() == []


def test_shards_count_windows_that_travel_alone(spark):
    from types import SimpleNamespace

    from shopframe.llm import anchors
    rows = spark.createDataFrame([(40, True), (40, False)], "windows int, alone boolean")
    assert anchors.shards_for(rows, SimpleNamespace(width=50, shard_symbols=100)) == -(-(40 * 50 + 40 + 50) // 100)
