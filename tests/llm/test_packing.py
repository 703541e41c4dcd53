"""Operator 6: the tokenizer itself, exact round trips, and every id in its place."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shopframe.llm import packing

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_units_equal_whole_texts(model, rows):
    with open(PATH, encoding="utf-8") as f:
        t = packing.Tokeniser(f.read())
    texts = [r[1] or "" for r in rows] + ["  lead", "trail  ", "a\n\n\nb  c", "don't I'll  'tis", "x\r\n y\t\tz", "12 3,4;;  --", "<|endoftext|>", " ", "日本 語  x", "é́ 🙂🙂 "]
    data = [x.encode() for x in texts]
    off = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    for _ in range(2):  # the second time from memory
        ids, ends = t.encode(np.frombuffer(b"".join(data), np.uint8), off)
        for i, x in enumerate(texts):
            if not packing.OTHER_SPACE.search(x):
                assert ids[ends[i]: ends[i + 1]].tolist() == model.encode(x, add_special_tokens=False).ids, x


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_length(seed):
    r = random.Random(seed)
    cap = r.choice([16, 64, 2048])
    counts = Counter(min(cap, max(1, int(r.lognormvariate(np.log(cap / 4), 1)))) for _ in range(r.choice([1, 50, 5000])))
    patterns = packing.plan(dict(counts), cap)
    used = Counter()
    for combo, times in patterns:
        assert times > 0 and sum(combo) <= cap
        for length in combo:
            used[length] += times
    assert used == counts
    total = sum(k * v for k, v in counts.items())
    assert sum(t for _, t in patterns) <= max(-(-total // cap) * 1.1, sum(v for k, v in counts.items() if 2 * k > cap) + 1, 1) + 1


def fills(have, length, cap):
    """All ways to fill the gap beside one ``length``, by number of lengths and then the largest first."""
    left = Counter({k: v for k, v in have.items() if v > 0}) - Counter([length])
    gap, some = cap - length, sorted(left, reverse=True)
    ways = [(gap,)] + [(a, gap - a) for a in some if gap - a <= a] + [(c, *p) for c in some for p in sorted(((gap - c - b, b) for b in some if 2 * b <= gap - c), reverse=True)]
    return [w for w in ways if min(w) > 0 and not Counter(w) - left]


@pytest.mark.parametrize("seed", range(8))
def test_index_of_sums_finds_what_a_search_of_all_fills_finds(seed):
    r = random.Random(seed)
    cap = r.choice([12, 30, 48])
    have = [0] + [r.choice([0, 0, 1, 2, 3]) for _ in range(cap)]
    index = packing.SumIndex(have, cap)
    for length in range(cap - 1, 0, -1):
        while have[length]:
            want = fills(dict(enumerate(have)), length, cap)
            got = index.complement(length)
            assert got == (want[0] if want else None)
            if got is None:
                break
            combo = Counter((length, *got))
            times = min(have[k] // n for k, n in combo.items())
            for k, n in combo.items():
                have[k] -= n * times


@pytest.mark.parametrize("capacity", [32, 2048])
def test_pack(docs, rows, work, model, capacity):
    got = packing.pack(docs, work, PATH, capacity, with_ids=True).collect()
    want = Counter()
    for r in rows:
        ids = model.encode(r[1] or "", add_special_tokens=False).ids + [0]
        cut = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        for p, (a, b) in enumerate(zip(cut, cut[1:])):
            want[(r[0], p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), tuple(ids[a:b]))] += 1
    assert Counter((g["doc_id"], g["piece"], g["start"], g["length"], g["ids_crc32"], tuple(g["ids"])) for g in got) == want
    sequences = defaultdict(list)
    for g in got:
        sequences[g["sequence_id"]].append((g["offset"], g["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(g["length"] for g in got)
    assert len(sequences) <= 1.05 * total / capacity + 2


def test_empty(no_docs, work):
    assert packing.pack(no_docs, work, PATH).collect() == []
