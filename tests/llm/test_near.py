"""Operators 9 and 10 against all pairs, connected components, and the signature's properties."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shopframe.llm import embeddings, minhash
from shopframe.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def union(nodes, edges):
    p = {n: n for n in nodes}

    def find(x):
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark, work):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 300)] + [(r.randrange(400, 500), r.randrange(400, 500)) for _ in range(60)] + [(3, 3), (2, 1), (1, 2)]
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long"), work).collect()}
    assert got == union(nodes, [e for e in edges if e[0] != e[1]])


def shingles(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_docs(rows):
    sets = {(r[0], i): shingles(r[1]) for i, r in enumerate(rows)}
    keys = sorted(sets, key=lambda k: (k[0] is None, k[0] or 0, k[1]))
    edges = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1:] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    place = {k: i for i, k in enumerate(keys)}
    comp = union(range(len(keys)), [(place[a], place[b]) for a, b in edges] + [(place[a], place[b]) for a in keys for b in keys if a[0] is not None and a[0] == b[0]])
    return {k: (len(sets[k]), keys[comp[place[k]]][0]) for k in keys}


@pytest.mark.parametrize("block", [1024, 3])
def test_documents(docs, rows, work, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "GROUP", 2)
    got = minhash.near_duplicates(docs, work).collect()
    want = Counter((k[0], *v) for k, v in brute_docs(rows).items())
    assert Counter((g["doc_id"], g["n_shingles"], g["component_id"]) for g in got) == want
    assert all(g["kept"] == (g["doc_id"] == g["component_id"]) for g in got)
    assert len({g["component_id"] for g in got}) < len(rows) - 5


def test_rows_without_an_id_link(spark, work):
    """The only link between two documents is a row without an id; rows without an id alone have no component."""
    r = random.Random(11)
    base = [f"w{r.randrange(9**9)}" for _ in range(100)]
    other = [f"v{r.randrange(9**9)}" for _ in range(100)]
    changed = lambda w, *at: " ".join("new" + str(i) if i in at else x for i, x in enumerate(w))
    rows = [(5, changed(base, 0, 1, 2, 3, 4, 5, 6, 7)), (None, changed(base)), (2, changed(base, *range(92, 100))),
            (None, changed(other)), (None, changed(other, 0)), (None, None), (7, "")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), work).collect()
    want = brute_docs(rows)
    assert want[(5, 0)][1] == want[(None, 1)][1] == 2
    assert Counter((g["doc_id"], g["n_shingles"], g["component_id"]) for g in got) == Counter((k[0], *v) for k, v in want.items())


def test_links_beside_the_centre(spark, work):
    """A chain of variants: neighbours link, ends do not, whoever is the smallest."""
    r = random.Random(5)
    base = [f"w{r.randrange(9**9)}" for _ in range(200)]
    rows, t = [], list(base)
    for i in range(12):
        rows.append((r.randrange(10**6), " ".join(t)))
        for _ in range(5):
            t[r.randrange(len(t))] = f"n{r.randrange(9**9)}"
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), work).collect()
    want = {k[0]: v[1] for k, v in brute_docs(rows).items()}
    assert {g["doc_id"]: g["component_id"] for g in got} == want


def test_blocks_confirm_whatever_the_signatures_say():
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 60, 100, np.uint64)
    sets = [np.unique(x) for x in (base, np.append(base[:90], r.integers(0, 1 << 60, 8, np.uint64)), np.append(base[:80], r.integers(0, 1 << 60, 20, np.uint64)), r.integers(0, 1 << 60, 100, np.uint64))]
    n = len(sets)
    table = pa.table({"block": [0] * n, "lo": [0] * n, "hi": [0] * n, "rep": [10, 11, 12, 13], "comp": [10, 11, 12, 13], "n_shingles": [len(x) for x in sets],
                      "sig": [r.bytes(minhash.SLOTS) for _ in sets], "shingles": [x.tobytes() for x in sets]})
    got = {tuple(x.values()) for x in minhash._block(table).to_pylist()}
    want = union(range(n), [(i, j) for i in range(n) for j in range(i) if minhash.similar(sets[i], sets[j])])
    assert union(range(n), [(a - 10, b - 10) for a, b in got]) == want and len(got) == 1


def test_superminhash_estimates_jaccard():
    r = np.random.default_rng(3)
    x = r.integers(0, 2**63, 4000).astype(np.uint64)
    for n, shared in ((40, 30), (400, 300), (2000, 1000), (5, 4)):
        a, b = np.unique(x[:n]), np.unique(np.concatenate([x[:shared], x[n: 2 * n - shared]]))
        sig = minhash.super_minhash(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        j = shared / (2 * n - shared)
        assert abs((sig[0] == sig[1]).mean() - j) < 4 * math.sqrt(j * (1 - j) / minhash.SLOTS) + 0.01
        assert (sig < minhash.SLOTS).all()
    assert np.isinf(minhash.super_minhash(x[:0], np.array([0, 0]))).all()


def test_empty(no_docs, spark, work):
    assert minhash.near_duplicates(no_docs, work).collect() == []
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"), work).collect() == []


def brute_vectors(rows):
    ok = []
    for i, (vid, v, label) in enumerate(rows):
        if label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            ok.append((i, np.array(v, np.float32).astype(np.float64), label))
    n, edges = Counter(), []
    for x in range(len(ok)):
        for y in range(x + 1, len(ok)):
            (i, v, a), (j, w, b) = ok[x], ok[y]
            if a == b and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= 0.98:
                edges.append((i, j))
                n[i] += 1
                n[j] += 1
    comp = union(range(len(rows)), edges)
    names = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            names[comp[i]].append(r[0])
    return Counter((r[0], n[i], min(names[comp[i]], default=None)) for i, r in enumerate(rows))


@pytest.mark.parametrize("leaf", [256, 8])
def test_vectors(spark, work, monkeypatch, leaf):
    monkeypatch.setattr(embeddings, "LEAF", leaf)
    r = np.random.default_rng(8)
    rows, centres = [], r.standard_normal((25, 16))
    for i in range(300):
        c = centres[r.integers(25)]
        rows.append((i, (c + r.standard_normal(16) * r.choice([0.02, 0.1, 0.5])).astype(np.float32).tolist(), int(r.integers(2))))
    rows += [(i, rows[0][1], rows[0][2]) for i in range(1000, 1030)] + [rows[3], rows[3]]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [None] + [1.0] * 15, 1), (2005, rows[0][1], None),
             (2006, [1e-30] * 16, 1), (2007, [1e30] * 16, 1), (2008, [1.0, 2.0], 1), (2009, [2.0, 4.0], 1), (None, rows[5][1], rows[5][2]), (None, [3.0, -1.0], 0), (2010, [-0.0] * 15 + [1.0], 0), (2011, [0.0] * 15 + [1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as cid", "'x' as leaf").repartition(3)
    got = embeddings.near_vectors(df, work).collect()
    assert Counter((g["vec_id"], g["n_links"], g["component_id"]) for g in got) == brute_vectors(rows)
