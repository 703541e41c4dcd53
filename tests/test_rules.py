"""Rule mining against brute-force enumeration, and metric identities."""

import itertools

from shopframe.operators import rules as r


BASKETS = [["a", "b", "c"], ["a", "b"], ["a", "c"], ["b", "c"], ["a", "b", "c", "d"], ["d", "e"], ["a", "d"],
           ["a", "b", "d"], ["c", "e"], ["a", "b", "c"]]


def _sets(spark, baskets, seg=None):
    rows = [(seg, sorted(set(b))) for b in baskets] if seg else [(sorted(set(b)),) for b in baskets]
    schema = "seg string, items array<string>" if seg else "items array<string>"
    return spark.createDataFrame(rows, schema)


def _brute(baskets, ms, max_len=3):
    n = len(baskets)
    items = sorted({i for b in baskets for i in b})
    out = {}
    for k in range(1, max_len + 1):
        for combo in itertools.combinations(items, k):
            c = sum(1 for b in baskets if set(combo) <= set(b))
            if c / n >= ms:
                out[combo] = c / n
    return out


def test_itemsets_match_brute_force(spark):
    got = {tuple(x["items"]): x["support"] for x in r.frequent_itemsets(_sets(spark, BASKETS), 0.2, 3).collect()}
    assert got == _brute(BASKETS, 0.2)


def test_fpgrowth_path_matches_levelwise(spark):
    s = _sets(spark, BASKETS)
    a = {tuple(x["items"]): x["support"] for x in r.frequent_itemsets(s, 0.2, 3, method="levelwise").collect()}
    b = {tuple(x["items"]): x["support"] for x in r.frequent_itemsets(s, 0.2, 3, method="fpgrowth").collect()}
    assert a == b


def test_segmented_fpgrowth(spark):
    rows = [("x", sorted(set(b))) for b in BASKETS] + [("y", ["a", "b"])] * 5
    s = spark.createDataFrame(rows, "seg string, items array<string>")
    got = {(x["seg"], tuple(x["items"])) for x in r.frequent_itemsets(s, 0.5, None, by=["seg"]).collect()}
    assert ("y", ("a", "b")) in got and ("x", ("a",)) in got


def test_rules_identities_and_multi_item_consequents(spark):
    fi = r.frequent_itemsets(_sets(spark, BASKETS), 0.1, 3)
    sup = {tuple(x["items"]): x["support"] for x in fi.collect()}
    rules = r.association_rules(fi, "confidence", 0.0).collect()
    assert any(len(x["consequent"]) == 2 for x in rules)
    for x in rules:
        ant, con = tuple(x["antecedent"]), tuple(x["consequent"])
        full = tuple(sorted(ant + con))
        assert abs(x["support"] - sup[full]) < 1e-12
        assert abs(x["confidence"] - sup[full] / sup[ant]) < 1e-12
        assert abs(x["lift"] - x["confidence"] / sup[con]) < 1e-12


def test_min_baskets_gate(spark):
    few = _sets(spark, BASKETS[:5] * 9 + BASKETS[:4], seg="s")  # 49 baskets
    assert r.mine_app(few, ["seg"]).count() == 0
    enough = _sets(spark, BASKETS * 5, seg="s")  # 50 baskets
    assert r.mine_app(enough, ["seg"]).count() > 0


def test_recommend_skips_owned_and_duplicates(spark):
    rules = spark.createDataFrame([
        (0, ["a"], ["b", "c"], 0.3, 0.6, 2.0), (0, ["a"], ["c"], 0.3, 0.5, 1.5), (0, ["z"], ["y"], 0.1, 0.9, 5.0)],
        "cluster_id int, antecedent array<string>, consequent array<string>, support double, confidence double, "
        "lift double")
    baskets = spark.createDataFrame([(1, 0, ["a", "b"])], "customer_id long, cluster_id int, items array<string>")
    out = [(x["rank"], x["recommend"]) for x in r.recommend(rules, baskets).orderBy("rank").collect()]
    assert out == [(1, "c")]
