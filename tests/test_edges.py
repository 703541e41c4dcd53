"""Hand-made frames for edge cases: ties, nulls, empty inputs, zero division, skew."""

import datetime as dt

from pyspark.sql import functions as F

from shopframe.functions.baskets import first_by, item_sets, pair_counts, patterns
from shopframe.functions.exprs import rnd
from shopframe.functions.prefix import row_numbers, running_total
from shopframe.operators import features as f
from shopframe.operators import olap, prediction as p, quality as q, survey as v
from shopframe.plans.retail import sessionize

D = dt.datetime


def test_first_order_tie_break_by_order_id(spark):
    oi = spark.createDataFrame([(1, 20, D(2020, 1, 1), "Complete", 5.0), (1, 10, D(2020, 1, 1), "Complete", 7.0),
                                (1, 30, D(2019, 1, 1), "Cancelled", 1.0)],
                               "user_id long, order_id long, created_at timestamp_ntz, status string, sale_price double")
    fo = v.first_orders_by_min_time(oi).collect()
    assert [(r.user_id, r.order_id) for r in fo] == [(1, 10)]  # cancelled order ignored, tie -> smaller id


def test_first_by_hot_key(spark):
    rows = [(1, i, D(2020, 1, 1) + dt.timedelta(minutes=i)) for i in range(5000)] + [(2, 7, D(2021, 1, 1))]
    df = spark.createDataFrame(rows, "k long, id long, ts timestamp_ntz")
    out = {r.k: r.id for r in first_by(df, "k", ["ts", "id"], []).collect()}
    assert out == {1: 0, 2: 7}


def test_sessionize_matches_brute_force_across_days(spark):
    import random
    rnd_ = random.Random(3)
    rows, eid = [], 0
    for u in range(4):
        t = D(2024, 1, 1)
        for _ in range(300 if u == 0 else 20):  # user 0 is hot
            t += dt.timedelta(hours=rnd_.choice([0.1, 1, 5, 13, 30]))
            rows.append((eid, t, u))
            eid += 1
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, uid long")
    runs = [{r.event_id: (r.session_start, r.sequence_number) for r in sessionize(df, bucket=b).collect()}
            for b in ("hour", "minute", "year")]  # many buckets, one a row, one a user
    got = runs[0]
    assert runs[1] == got and runs[2] == got
    # brute force
    exp = {}
    for u in range(4):
        evs = sorted([r for r in rows if r[2] == u], key=lambda r: (r[1], r[0]))
        start, seq, prev = None, 0, None
        for e in evs:
            if prev is None or (e[1] - prev).total_seconds() > 12 * 3600:
                start, seq = e[1], 0
            seq += 1
            exp[e[0]] = (start, seq)
            prev = e[1]
    assert got == exp


def test_pairs_from_patterns_equal_self_join(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "b"), (3, "a"), (3, "b"), (4, "c")],
                               "o long, item string")
    pc = {(r.a, r.b): r.n for r in pair_counts(patterns(item_sets(df, "o", "item", 2))).collect()}
    assert pc == {("a", "b"): 3, ("a", "c"): 1, ("b", "c"): 1}


def test_empty_basket_set(spark):
    df = spark.createDataFrame([], "o long, item string")
    assert pair_counts(patterns(item_sets(df, "o", "item", 2))).count() == 0


def test_running_total_and_row_numbers(spark):
    df = spark.range(0, 1000).withColumn("v", F.col("id") % 7)
    rt = {r.id: r.running for r in running_total(df, ["id"], "v", "running", 5).collect()}
    acc, exp = 0, {}
    for i in range(1000):
        acc += i % 7
        exp[i] = acc
    assert rt == exp
    rn = sorted(r.row_id for r in row_numbers(df, ["v", "id"], "row_id", 3).collect())
    assert rn == list(range(1, 1001))


def test_auc_equals_pair_count_with_ties(spark):
    data = [(1, 0.9), (0, 0.9), (1, 0.7), (0, 0.3), (1, 0.3), (0, 0.1), (1, 0.8), (0, 0.8)]
    df = spark.createDataFrame(data, "label int, score double")
    got = p.auc(df, "label", "score").first()["auc"]
    pos = [s for l, s in data if l == 1]
    neg = [s for l, s in data if l == 0]
    exp = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg) / (len(pos) * len(neg))
    assert abs(got - exp) < 1e-12


def test_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, score double")
    assert p.auc(df, "label", "score").first()["auc"] is None


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (0, 0)], "label int, prediction int")
    rep = {r["class"]: r for r in p.classification_report(df).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0 and rep["1"]["f1"] == 0.0
    assert abs(rep["accuracy"]["precision"] - 1 / 3) < 1e-12


def test_rnd_half_up_is_engine_stable(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (-0.5,), (0.125,)], "x double")
    got = [r[0] for r in df.select(rnd("x", 2)).collect()]
    assert got == [2.68, 1.01, -0.5, 0.13]


def test_summarise_null_group_and_non_numbers(spark):
    df = spark.createDataFrame([(None, "1.5"), ("a", "x"), ("a", "2")], "g string, v string")
    out = {r.group: (r.row_count, r.sum_value) for r in olap.summarise(df, "g", "v").collect()}
    assert out == {"(null)": (1, 1.5), "a": (2, 2.0)}


def test_slice_contains_case_insensitive(spark):
    df = spark.createDataFrame([("Hanoi",), ("HUE",), (None,)], "city string")
    assert olap.slice_contains(df, "city", "h").count() == 2
    assert olap.slice_contains(df, "city", "  ").count() == 3


def test_reconcile_unavailable_source(spark):
    dw = q.constant(spark, 3.0)
    r = q.reconcile("x", dw, None).first()
    assert r.is_match is None
    assert q.reconcile("y", dw, q.constant(spark, 3.005)).first().is_match is True


def test_negative_values_and_nulls(spark):
    df = spark.createDataFrame([(1, -1.0), (None, 2.0), (3, 1.0)], "k long, qty double")
    assert q.negative_values(df, ["qty"]).first().v == 1.0
    assert q.critical_nulls(df, ["k"]).first().v == 1.0


def test_fill_features_null_age_and_recency(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, 40, 5, 0.5), (3, 20, 7, 0.1)],
                               "customer_id long, age int, recency_days int, pct_online double") \
        .withColumn("avg_price", F.lit(None).cast("double"))
    out = {r.customer_id: r for r in f.fill_features(df).collect()}
    assert out[1].age == 30 and out[1].recency_days == 9999 and out[1].pct_online == 0.0


def test_cart_abandon_zero_carts(spark):
    s = spark.createDataFrame([(1, "s1", 3, 0, 0, 2)], "user_id long, session_id string, session_depth int, "
                                                     "has_purchase int, has_cart int, products_viewed long")
    assert f.user_behaviour(s).first().cart_abandon_rate == 0.0


def test_label_encode_unknown_and_order(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "g string")
    out = {r.g: r.g_enc for r in f.label_encode(df, ["g"]).collect()}
    assert out == {"Unknown": 0, "a": 1, "b": 2}


def test_unknown_category_scores_as_zeros(spark):
    train = spark.createDataFrame([("x", 1), ("y", 0), ("x", 1), ("y", 0)], "c string, label int")
    m = p.context_pipeline(["c"], "label").fit(train)
    out = p.score_contexts(m, spark.createDataFrame([("zzz",)], "c string")).first()
    assert out.prediction in (0.0, 1.0)


def test_empty_string_timestamps(spark):
    from shopframe.functions.exprs import ts_or_null
    df = spark.createDataFrame([("",), ("2024-01-02 03:04:05",), (None,)], "t string")
    got = [r[0] for r in df.select(ts_or_null("t")).collect()]
    assert got[0] is None and got[2] is None and got[1] is not None


def test_row_numbers_within_groups_hot_group(spark):
    rows = [("hot", i) for i in range(3000)] + [("a", i) for i in range(5)] + [("b", i) for i in range(7)]
    df = spark.createDataFrame(rows, "g string, k long")
    out = row_numbers(df, ["k"], "n", 6, by=["g"]).collect()
    got = {}
    for r in out:
        got.setdefault(r.g, []).append((r.k, r.n))
    for g, pairs in got.items():
        pairs.sort()
        assert [n for _, n in pairs] == list(range(1, len(pairs) + 1)), g
