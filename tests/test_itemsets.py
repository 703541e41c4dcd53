"""Itemsets by bitmaps, rules by grown consequents, containment joins; against brute force."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopframe.functions import itemsets as its
from shopframe.operators import rules as r


def brute(sets, least, top, by=lambda g: g):
    n, c = Counter(), Counter()
    for g, items in sets:
        n[g] += 1
        for k in range(1, top + 1):
            for x in itertools.combinations(sorted(set(items)), k):
                c[g, x] += 1
    return {(g, x): a for (g, x), a in c.items() if a / n[g] >= least}, n


def baskets(seed, n=900):
    q = random.Random(seed)
    out = []
    for _ in range(n):
        g = q.choice(["x", "x", "x", "y", None])
        k = q.random()
        items = {q.choice("abcdefgh") for _ in range(q.randint(0, 6))} if k < 0.8 else {f"i{q.randint(0, 40)}" for _ in range(q.randint(1, 25))}
        out.append((g, sorted(items)))
    return out + [("y", ["a", "b", "c"])] * 70 + [("z", [])]


def frame(spark, sets):
    return spark.createDataFrame(sets, "g string, items array<string>").repartition(4)


@pytest.mark.parametrize("seed, least, top, rows, items", [(1, 0.02, 3, 1 << 15, 1 << 20), (2, 0.05, 4, 50, 1 << 20), (3, 0.01, 3, 7, 40)])
def test_itemsets(spark, seed, least, top, rows, items, monkeypatch):
    monkeypatch.setattr(its, "CHUNK_ROWS", rows)
    monkeypatch.setattr(its, "CHUNK_ITEMS", items)
    monkeypatch.setattr(its, "GROUP_ITEMS", 900)  # several groups a segment
    sets = baskets(seed)
    want, n = brute(sets, least, top)
    got = {(x.g, tuple(x["items"])): (x["count"], x.support) for x in r.frequent_itemsets(frame(spark, sets), least, top, ["g"], method="bitmap").collect()}
    assert got == {k: (a, a / n[k[0]]) for k, a in want.items()}
    whole, m = brute([(0, i) for _, i in sets], least, 3)
    got = {tuple(x["items"]): x["count"] for x in r.frequent_itemsets(frame(spark, sets).drop("g"), least).collect()}
    assert got == {k: a for (_, k), a in whole.items()}


def test_any_length_equals_fpgrowth(spark):
    sets = frame(spark, [s for s in baskets(5, 300) if s[1]])
    a, b = ({(x.g, tuple(x["items"])): x["count"] for x in r.frequent_itemsets(sets, 0.05, None, ["g"], method=m).collect()} for m in ("bitmap", "fpgrowth"))
    assert a == b and max(len(k[1]) for k in a) > 3


def test_long_basket(spark):
    """A basket of 20,000 products beside small ones."""
    q = random.Random(1)
    small = [sorted(q.sample(range(20_000), 4)) for _ in range(50)] + [[1, 2, 3]] * 12
    sets = spark.createDataFrame([(list(range(20_000)),)] + [(s,) for s in small], "items array<int>")
    got = {tuple(x["items"]): x["count"] for x in r.frequent_itemsets(sets, 0.15, 3).collect()}
    want, _ = brute([(0, s) for s in small], 0, 3)
    full = {k: a + 1 for (_, k), a in want.items() if (a + 1) / 63 >= 0.15}
    assert got == full and (1, 2, 3) in got


@pytest.mark.parametrize("seed", range(4))
def test_chunk_supports(seed):
    g = np.random.default_rng(seed)
    n, k = 200, 30
    grid = g.random((n, k)) < np.concatenate([np.full(15, 0.3), np.full(15, 0.01)])
    weight = g.integers(1, [2, 9, 1000, 3][seed], n)
    row, item = np.nonzero(grid)
    c = its.Chunk(row, item, weight, k)
    assert c.is_dense.any() and (~c.is_dense).any()
    for items in [[0], [20], [0, 1], [0, 20], [20, 21], [3, 4, 5], [16, 0, 25]]:
        more = np.array([x for x in range(k) if x not in items])
        assert c.extensions(items, more).tolist() == [int(weight[grid[:, [*items, m]].all(1)].sum()) for m in more]


METRICS = [("confidence", 0.4), ("lift", 1.05), ("leverage", 0.002), ("conviction", 1.02), ("support", 0.05), ("lift", 0.0), ("leverage", -1.0)]


@pytest.mark.parametrize("metric, least", METRICS)
def test_rules(spark, metric, least):
    sets = baskets(7, 500)
    counts, n = brute(sets, 0.03, 4)
    want = {}
    for (g, x), a in counts.items():
        for k in range(1, len(x)):
            for con in itertools.combinations(x, k):
                ant = tuple(i for i in x if i not in con)
                s, sa, sc = a / n[g], counts[g, ant] / n[g], counts[g, con] / n[g]
                v = {"confidence": s / sa, "lift": s / sa / sc, "leverage": s - sa * sc, "support": s, "conviction": (1 - sc) / (1 - s / sa) if s < sa else None}
                if v[metric] is not None and v[metric] >= least:
                    want[g, ant, con] = v["lift"]
    f = r.frequent_itemsets(frame(spark, sets), 0.03, 4, ["g"], method="bitmap")
    got = {(x.g, tuple(x.antecedent), tuple(x.consequent)): x.lift for x in r.association_rules(f, metric, least, ["g"]).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    assert any(k[0] is None for k in got)  # the null segment keeps its rules


def test_set_of_35_items(spark):
    """Only what can pass is grown: 2^35 splits are never listed."""
    items = [f"i{i:02d}" for i in range(35)]
    rows = [(items, 0.3)]
    for x in items:  # i00 and i01 follow from the others, the rest do not
        rows.append(([x], 0.9))
        rows.append(([y for y in items if y != x], 0.31 if x in items[:2] else 0.9))
    rows.append((items[2:], 0.32))
    rows.append((items[:2], 0.5))
    f = spark.createDataFrame(rows, "items array<string>, support double")
    got = {(len(x.antecedent), tuple(x.consequent)) for x in r.association_rules(f, "confidence", 0.9).collect()}
    assert got == {(34, ("i00",)), (34, ("i01",)), (33, ("i00", "i01")), (33, ("i00",)), (33, ("i01",))}  # the last two: of the sets of 34


def test_recommend_is_a_containment_join(spark):
    q = random.Random(2)
    items = list("abcdefgh")
    rows = [(g, sorted(a), c, 0.1, 0.5, float(lift)) for g in ("x", None) for a, c, lift in
            [({"a"}, ["b"], 2), ({"a", "c"}, ["b", "d"], 3), ({"d", "e", "f"}, ["g"], 5), ({"h"}, ["a"], 2), ({"c"}, ["e"], 2), ({"b"}, ["h", "c"], 1.5)]]
    rules = spark.createDataFrame(rows, "g string, antecedent array<string>, consequent array<string>, support double, confidence double, lift double")
    sets = [(i, q.choice(["x", None, "other"]), sorted(q.sample(items, q.randint(0, 6)))) for i in range(120)]
    b = spark.createDataFrame(sets, "customer_id long, g string, items array<string>")
    got = {(x.customer_id, x["rank"]): (x.recommend, tuple(x.from_items), x.lift) for x in r.recommend(rules, b, by=["g"], top_k=3).collect()}
    want = {}
    for i, g, own in sets:
        hits = {}
        for g2, ant, con, _, _, lift in rows:
            if g2 == g and set(ant) <= set(own):
                for c in con:
                    if c not in own:
                        hits[c] = min(hits.get(c, (9, "")), (-lift, "|".join(ant), c, tuple(ant)))
        for k, h in enumerate(sorted(hits.values())[:3]):
            want[i, k + 1] = (h[2], h[3], -h[0])
    assert got == want and len(want) > 50
    plan = r.recommend(rules, b, by=["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Cartesian" not in plan


def test_null_segment_matrix(spark):
    sets = spark.createDataFrame([(g, x) for g in ("x", None) for x in (["a", "b"], ["a", "b"], ["a"], ["c"])], "g string, items array<string>")
    m = r.lift_matrix(sets, ["g"]).groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum("lift").alias("s")).collect()
    assert len(m) == 2 and m[0].n == m[1].n and m[0].s == m[1].s
    top = r.mine_app(sets, ["g"], 0.1, 0.1, 2)
    assert {x.g for x in top.collect()} == {"x", None}
