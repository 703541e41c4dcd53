"""The pipeline's stages against the brute-force versions of their operators."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline

from .test_native import brute_base, brute_stats, words
from .test_near import brute_docs

public = pytest.importorskip("public_tokenizers")


def quality(rows):
    norm = lambda x: " ".join(words("".join(c.lower() if "A" <= c <= "Z" else c for c in x)))
    per_host = defaultdict(set)
    for r in rows:
        per_host[r[3]].add(r[1] or "")
    often = {}
    for host, texts in per_host.items():
        n = Counter(h for t in texts for h in {norm(x) for x in t.split("\n") if words(x)})
        often[host] = {h for h, c in n.items() if c > 20 and c > 0.01 * len(texts)}
    out = []
    for r in rows:
        s = brute_stats(r[1])
        lost = [x for x in (r[1] or "").split("\n") if words(x) and norm(x) in often[r[3]]]
        if s[0] >= 50 and 100 * s[4] <= 50 * s[0] and 2 * sum(len(words(x)) for x in lost) <= s[0]:
            t = "\n".join(x for x in r[1].split("\n") if x not in lost) if lost else r[1]
            out.append((r[0], t, r[2], r[3], len(t) if lost else r[4]))
    return out


def near(rows):
    comp = brute_docs(rows)
    seen, out = set(), []
    for i, r in enumerate(rows):
        if r[0] is None or (comp[(r[0], i)][1] == r[0] and r[0] not in seen):
            seen.add(r[0])
            out.append(r)
    return out


def mask(t):
    out, at = "", 0
    for s, _, e in brute_base(t):
        if s >= at:
            out += t[at:s] + "[SECRET]"
        at = max(at, e)
    return out + t[at:]


def mixed(rows):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, left = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, set(names)
    while True:
        rest, w = sum(sizes.values()) - sum(3 * sizes[s] for s in names if s not in left), sum(weight[s] for s in left)
        over = {s for s in left if rest * weight[s] / w > 3 * sizes[s]}
        if not over:
            break
        left -= over
    out = []
    for r in rows:
        rate = (rest * weight[r[3]] / w if r[3] in left else 3 * sizes[r[3]]) / sizes[r[3]]
        draw = int(hashlib.md5(f"mix:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:12], 16) / 16**12
        out += [r] * (int(rate) + (draw < rate - int(rate)))
    return out


def pieces(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    n = Counter()
    for r in rows:
        ids = t.encode(r[1], add_special_tokens=False).ids + [0]
        cut = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        n.update((r[0], p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for p, (a, b) in enumerate(zip(cut, cut[1:])))
    return n


def test_pipeline(spark, rows, tmp_path):
    rows = [r[:5] for r in rows]
    line = "license line with some seven more words"
    rows = [(r[0], r[1] + "\n" + line, *r[2:]) if r[1] and i % 5 and len(r[1]) > 200 and i > 10 else r for i, r in enumerate(rows)]
    rows += [(5000 + i, rows[40 + i][1].upper() + f"\npassword = hunter{i}hunter2 and {'0123456789abcdef' * 2}", "en", "s9", 1) for i in range(6)]
    rows += [(6000 + i, " ".join(f"q{i}z{j}" for j in range(70)) + f"\napi_key: abcdEFGH{i}9 AKIAABCDEFGHIJKL{i}MNOP", "en", "s9", 1) for i in range(3)]
    folder = os.path.join(tmp_path, "sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    kept = quality(rows)
    assert any(len(k[1]) != len(r[1]) for k in kept for r in rows if r[0] == k[0] is not None)
    one = near(kept)
    assert len(one) < len(kept) < len(rows)
    clean = [(r[0], mask(r[1]), *r[2:]) for r in one]
    assert any("[SECRET]" in r[1] for r in clean)
    want = pieces(mixed(clean))
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter((g["doc_id"], g["piece"], g["start"], g["length"], g["ids_crc32"]) for g in got) == want
    assert max(Counter(g["sequence_id"] for g in got).values()) > 1
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for stage, expected in zip(corpus_pipeline.STAGES, (kept, one, clean, mixed(clean))):
        docs = stage[1](spark, docs, folder)
        assert docs.columns == corpus_pipeline.COLUMNS
        assert Counter((r[0], r[1], r[3]) for r in docs.collect()) == Counter((r[0], r[1], r[3]) for r in expected), stage[0]
        docs = spark.createDataFrame(docs.collect(), docs.schema)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_masks_values_of_one_owner(spark):
    """Copies of a text under another source, or many texts of one source, make no value an example."""
    token = "ghp_{}Zk3PqR8sT1vWx5YzB7cD9eF2gH4jK6mN8p".format
    rows = [(1, f"copied {token('a')}", "s1"), (2, f"copied {token('a')}", "s2"), (3, f"only here {token('a')}", "s2")]
    rows += [(10 + i, f"text {i} of one owner {token('b')}", "s3") for i in range(6)]
    rows += [(20, f"nobody's {token('c')}", None), (21, f"also nobody's {token('c')}", None)]
    rows += [(30 + i, f"example {i} {token('d')}", f"s{i}") for i in range(3)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.secret_scan(spark, docs, "").collect()}
    assert got == {i: t if i >= 30 else t[:t.index("ghp_")] + "[SECRET]" for i, t, _ in rows}


def test_rows_with_clashing_ids_are_documents_of_their_own(spark):
    text = lambda k: " ".join(f"{k}{j}" for j in range(60))
    rows = [(1, text("a"), "s2"), (1, text("a"), "s1"), (1, text("b"), "s1"), (1, text("c"), "s1"), (2, text("c") + " more", "s1"),
            (3, text("d"), "s1"), (4, text("d"), "s1"), (5, text("e"), "s1"), (None, text("f"), "s1")]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    first = [(r[0], r[1].split(" ")[0][0], r[3]) for r in got]
    assert len(got) == 6 and (1, "a", "s1") in first and (1, "b", "s1") in first
    assert sorted(x[1] for x in first) == list("abcdef") and {x[0] for x in first if x[1] in "de"} == {3, 5}
