"""Operator 1 against a direct Kneser-Ney on dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from shopframe.llm import hasharrays, lm, queries, store_files

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def toks(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [*WORD.findall(low), "</s>END"]


def disc(values):
    n = [sum(v == i for v in values) for i in range(1, 5)]
    if min(n) <= 0:
        return [0, .5, 1, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [0] + [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0), i) for i in (1, 2, 3)]


class Brute:
    def __init__(self, texts, order):
        self.order, self.levels = order, {}
        self.words = Counter(w for t in texts for w in toks(t))
        grams = Counter()
        for t in texts:
            s = ["<s>"] * (order - 1) + toks(t)
            grams.update(tuple(s[i:i + order]) for i in range(len(s) - order + 1))
        for k in range(order, 0, -1):
            ctx = defaultdict(Counter)
            for g, n in grams.items():
                ctx[g[:-1]][g[-1]] = n
            self.levels[k] = (ctx, disc(list(grams.values())))
            grams = Counter(g[1:] for g in grams)

    def p(self, ctx, w):
        p = 1 / (len(self.words) + 1)
        for k in range(1, self.order + 1):
            c, d = self.levels[k]
            own = c.get(tuple(ctx[len(ctx) - k + 1:]) if k > 1 else ())
            if own:
                total = sum(own.values())
                p = (own[w] - d[min(own[w], 3)]) / total + sum(d[min(n, 3)] for n in own.values()) / total * p
        return p


@pytest.mark.parametrize("order", [2, 3])
def test_score(docs, rows, work, order, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_TOKENS", 3000)
    monkeypatch.setattr(lm, "HOT_PARTS", 40)
    train = [r[1] for r in rows if zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 10]
    t = docs.where(~lm.held_out()).select(lm.F.coalesce("text", lm.F.lit("")).alias("text"))
    model = lm.train(t, work, order)
    assert model.split.shards > 4 and len(model.split.hot)
    got = lm.score(docs, model).collect()
    assert len(got) == len(rows)
    brute = Brute(train, order)
    total, v = sum(brute.words.values()), len(brute.words)
    assert (model.tokens, model.known) == (total, v)
    by_id = {r[0]: r[1] for r in rows}
    for g in got:
        if g["n_tokens"] > 2000:
            continue
        w = toks(by_id[g["doc_id"]])
        assert g["n_tokens"] == len(w) and g["n_known"] == sum(x in brute.words for x in w)
        assert g["base_score"] == pytest.approx(sum(math.log10((brute.words[x] + .1) / (total + .1 * (v + 1))) for x in w))
        s = ["<s>"] * (order - 1) + w
        want = sum(math.log10(brute.p(s[i:i + order - 1], x)) for i, x in enumerate(w))
        assert g["score"] == pytest.approx(want, rel=1e-9), by_id[g["doc_id"]]


def test_sums_to_one(rows):
    b = Brute([r[1] for r in rows[:60]], 2)
    assert sum(b.p(["a"], w) for w in [*b.words, "unknown"]) == pytest.approx(1)


def test_nothing_to_learn_from(no_docs, docs, work):
    model = lm.train(no_docs.select("text"), work)
    got = lm.score(docs, model).collect()
    assert all(g["n_known"] == 0 and g["score"] == 0 for g in got)
    assert lm.score(no_docs, model).collect() == []


def test_registered_query_uses_two_words_of_context(spark, tmp_path):
    texts = ["a b c", "a b c", "x b d", "x b d", "a b c e", "x b d e", *["b c b d"] * 3]
    rows = [(i, t) for i, t in enumerate(texts * 4)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["score"] for r in queries.op1_kneser_ney(spark, str(tmp_path)).collect()}
    brute = Brute([t for i, t in rows if zlib.crc32(str(i).encode()) % 10], 3)
    assert len(got) == len(rows)
    for i, t in rows:
        s = ["<s>", "<s>", *toks(t)]
        assert got[i] == pytest.approx(sum(math.log10(brute.p(s[j - 2:j], s[j])) for j in range(2, len(s))), rel=1e-9)


@pytest.mark.parametrize("bits", [7, 21, 22, 33])
def test_packed_ranks(bits):
    r = np.random.default_rng(bits)
    cols = [r.integers(0, min(1 << bits, 50), 4000).astype(np.uint64) for _ in range(3)]
    cols[0][:9] = (1 << bits) - 1
    pack = lm.Packing(bits)
    keys = pack.numbers(cols)
    assert len(keys) == (1 if bits <= 21 else 2 if bits <= 32 else 3)
    assert all((a == b).all() for a, b in zip(pack.columns(keys, 3), cols, strict=True))
    want = Counter(zip(*(c.tolist() for c in cols), strict=True))
    k, n = lm.merge(keys)
    runs = [lm.packed([x[i::2] for x in k], n[i::2]) for i in range(2)]  # two sorted runs
    k, n = lm.merge(*lm.unpacked(runs, len(keys)))
    got = pack.columns(k, 3)
    assert dict(zip(zip(*(c.tolist() for c in got), strict=True), n[:, 0].tolist(), strict=True)) == want
    assert sorted(want) == list(zip(*(c.tolist() for c in got), strict=True))


@pytest.mark.parametrize("n", [0, 1, 40, 30000])
def test_hash_arrays(n, tmp_path):
    r = np.random.default_rng(n)
    h = np.unique(r.integers(0, 2**64, n, dtype=np.uint64))
    values = r.integers(0, 40, (len(h), 4))  # far more rows than one byte tells apart
    values[: len(h) // 2] = 1
    values[len(h) // 3: len(h) // 3 + 1] = 10**12
    order = r.permutation(len(h))
    store_files.put(str(tmp_path), "x", hasharrays.bundle(hasharrays.table("t", h[order], values[order]) | hasharrays.table("empty", h[:0], values[:0])))
    arrays = hasharrays.opened(str(tmp_path), "x")
    assert (hasharrays.found(arrays, "t", h, 4) == values).all()
    assert not hasharrays.found(arrays, "t", h + np.uint64(1 << 40), 4).any()
    assert not hasharrays.found(arrays, "empty", h, 4).any()
