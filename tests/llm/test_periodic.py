"""Operator 13 against a direct search for runs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from shopframe.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least=6, times=4):
    out, seen = [], set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, times * q) and (i, n) not in seen:
                seen.add((i, n))
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda x: (x[0], x[2]))


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("least, times", [(6, 4), (1, 3), (10, 5)])
def test_runs(seed, least, times):
    r = random.Random(seed)
    for _ in range(60):
        docs = []
        for _ in range(r.randint(0, 5)):
            w = []
            for _ in range(r.randint(0, 5)):
                x = [r.randint(0, r.choice([1, 2, 9])) for _ in range(r.randint(1, 9))] * r.randint(1, 12)
                w += x[: r.randint(0, len(x))]
            docs.append(w)
        first = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = list(zip(*[c.tolist() for c in periodic.runs_of(np.array([x for d in docs for x in d], np.uint64), first, least, times)], strict=True))
        assert got == [(i, *x) for i, d in enumerate(docs) for x in brute(d, least, times)]


def expected(rows):
    out = []
    for row in rows:
        w, doc = WORD.findall(row[1] or ""), row[0]
        n = len(w)
        if doc is not None and n and (h := zlib.crc32(str(doc).encode())) % 10 == 0:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = brute(w)
        gone = {i for s, k, q in runs for i in range(s + q, s + k)}
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out.append((doc, len(runs), *(top if top else (None, None, None)), top and 1000 * top[1] // top[2],
                    sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=repr)


def test_documents(docs, rows):
    got = periodic.digests(periodic.periodic_runs(docs, reorder=periodic.planted_order))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = expected(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(x[1] > 0 for x in want) > 5


def test_collapsed_text(spark):
    d = spark.createDataFrame([(1, "a b c d\ne  f e f e f e f g"), (2, None), (3, "x x x x x x y"), (None, "z " * 6)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(d).collect()}
    assert got == {1: (13, [(4, 8, 2)], "a b c d e f g"), 2: (0, [], ""), 3: (7, [(0, 6, 1)], "x y"), None: (6, [(0, 6, 1)], "z")}


def test_empty(no_docs):
    assert periodic.digests(periodic.periodic_runs(no_docs)).collect() == []
