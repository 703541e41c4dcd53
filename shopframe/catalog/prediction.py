"""Registered prediction-layer queries.

Deterministic pieces (split, weights, AUC, ROC, report, confusion, balance)
use a rule score (first-order size) so DuckDB can check them exactly. Model
training queries (forest, tree, logistic, boosting, multiclass, pipelines,
incremental forest) have no SQL twin and are checked on rows only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shopframe.catalog.base import register
from shopframe.functions.exprs import draw_sql, rnd, rnd_sql as R
from shopframe.operators import clustering as cl
from shopframe.operators import features as f
from shopframe.operators import prediction as p
from shopframe.plans.oracle import with_views as W
from shopframe.session import Work, materialize

NC = "status != 'Cancelled'"
WILL_BUY = ["recency_days", "frequency", "monetary", "avg_price", "pct_online", "pct_ladieswear", "pct_divided",
            "pct_menswear", "pct_baby", "pct_sport"]


def V(t, name):
    return t.view(name)


def _repeat(t):
    """user_id, score = first order size, label = repeat buyer (non-cancelled orders)."""
    oi, pp = V(t, "order_items"), V(t, "products")
    fo = f.first_order_features(oi, pp, by_item=True).select("user_id", F.col("first_order_num_items").alias("score"))
    return fo.join(f.repeat_buyer_label(oi), "user_id").withColumnRenamed("is_repeat_buyer", "label")


_REPEAT_SQL = f"""SELECT fo.user_id, fo.score, l.label FROM (
  SELECT x.user_id, COUNT(*) AS score FROM (SELECT user_id, order_id FROM (SELECT user_id, order_id,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY created_at, order_id) AS rn FROM order_items WHERE {NC}) a
    WHERE rn = 1) x JOIN order_items oi ON x.order_id = oi.order_id AND x.user_id = oi.user_id
    JOIN products pr ON oi.product_id = pr.id GROUP BY x.user_id) fo
JOIN (SELECT user_id, CASE WHEN COUNT(DISTINCT order_id) >= 2 THEN 1 ELSE 0 END AS label FROM order_items
      WHERE {NC} GROUP BY user_id) l ON fo.user_id = l.user_id"""
RV = ["order_items", "products"]

register("pred_stratified_split", W(RV, f"""
SELECT user_id, label, CASE WHEN rn <= n - FLOOR(0.2 * n + 0.5) THEN 'train' ELSE 'test' END AS split FROM (
  SELECT user_id, label, COUNT(*) OVER (PARTITION BY label) AS n,
         ROW_NUMBER() OVER (PARTITION BY label ORDER BY {draw_sql('user_id', 42)}, user_id) AS rn FROM rep) x""",
    [("rep", _REPEAT_SQL)]))(
    lambda t: p.stratified_split(_repeat(t), "label", "user_id").select("user_id", "label", "split"))

register("pred_balanced_weights", W(RV, f"""
SELECT rep.user_id, rep.label, {R('w.weight', 9)} AS weight FROM rep JOIN (
  SELECT label, CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / (COUNT(*) OVER () * COUNT(*)) AS weight FROM rep GROUP BY label) w
  ON rep.label = w.label""", [("rep", _REPEAT_SQL)]))(
    lambda t: p.balanced_weights(_repeat(t), "label").select("user_id", "label", rnd("weight", 9).alias("weight")))

register("pred_pos_weight", W(RV, f"""
SELECT {R('CAST(COUNT(*) FILTER (WHERE label = 0) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE label = 1), 0)', 9)} AS pos_weight
FROM rep""", [("rep", _REPEAT_SQL)]))(
    lambda t: p.pos_weight(_repeat(t), "label").select(rnd("pos_weight", 9).alias("pos_weight")))

register("pred_auc_first_order_size", W(RV, f"""
SELECT {R('SUM(pc * (qcum - qc + qc / 2.0)) / NULLIF(SUM(pc) * SUM(qc), 0)', 9)} AS auc, CAST(SUM(pc) AS BIGINT) AS n_pos, CAST(SUM(qc) AS BIGINT) AS n_neg
FROM (SELECT score, pc, qc, SUM(qc) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS qcum FROM (
  SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pc, COUNT(*) FILTER (WHERE label != 1) AS qc FROM rep
  GROUP BY score) a) b""", [("rep", _REPEAT_SQL)]))(
    lambda t: p.auc(_repeat(t), "label", "score").select(rnd("auc", 9).alias("auc"), "n_pos", "n_neg"))

register("pred_roc_first_order_size", W(RV, f"""
SELECT score AS threshold, {R('fp / NULLIF((SELECT COUNT(*) FILTER (WHERE label != 1) FROM rep), 0)', 9)} AS fpr,
       {R('tp / NULLIF((SELECT COUNT(*) FILTER (WHERE label = 1) FROM rep), 0)', 9)} AS tpr
FROM (SELECT score, SUM(pc) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             SUM(qc) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp
      FROM (SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pc, COUNT(*) FILTER (WHERE label != 1) AS qc
            FROM rep GROUP BY score) a) b""", [("rep", _REPEAT_SQL)]))(
    lambda t: p.roc_points(_repeat(t), "label", "score").select(
        "threshold", rnd("fpr", 9).alias("fpr"), rnd("tpr", 9).alias("tpr")))

_PRED = "CASE WHEN score >= 4 THEN 1 ELSE 0 END"


def _ruled(t):
    return _repeat(t).withColumn("prediction", F.when(F.col("score") >= 4, 1).otherwise(0))


register("pred_confusion_matrix", W(RV, f"SELECT label, {_PRED} AS prediction, COUNT(*) AS n FROM rep GROUP BY 1, 2",
                                    [("rep", _REPEAT_SQL)]))(lambda t: p.confusion_matrix(_ruled(t)))

_REPORT = f"""
WITH cm AS (SELECT label, {_PRED} AS pred, COUNT(*) AS n FROM rep GROUP BY 1, 2),
cls AS (SELECT label AS c FROM cm UNION SELECT pred FROM cm),
per AS (SELECT cls.c, COALESCE((SELECT SUM(n) FROM cm WHERE label = cls.c AND pred = cls.c), 0) AS tp,
               COALESCE((SELECT SUM(n) FROM cm WHERE label = cls.c), 0) AS support,
               COALESCE((SELECT SUM(n) FROM cm WHERE pred = cls.c), 0) AS predicted FROM cls),
m AS (SELECT c, tp, support, CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
             CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM per),
m2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
       FROM m)
SELECT CAST(c AS VARCHAR) AS class, precision, recall, f1, CAST(support AS BIGINT) AS support FROM m2
UNION ALL SELECT 'accuracy', SUM(tp) / SUM(support), SUM(tp) / SUM(support), SUM(tp) / SUM(support),
       CAST(SUM(support) AS BIGINT) FROM m2
UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1), CAST(SUM(support) AS BIGINT) FROM m2
UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
       SUM(f1 * support) / SUM(support), CAST(SUM(support) AS BIGINT) FROM m2"""
register("pred_classification_report", W(RV, f"""
SELECT class, {R('precision', 9)} AS precision, {R('recall', 9)} AS recall, {R('f1', 9)} AS f1, support
FROM ({_REPORT}) z""",
    [("rep", _REPEAT_SQL)]))(
    lambda t: p.classification_report(_ruled(t)).select(
        "class", rnd("precision", 9).alias("precision"), rnd("recall", 9).alias("recall"), rnd("f1", 9).alias("f1"),
        F.col("support").cast("long").alias("support")))

register("pred_label_balance", W(RV, f"""
SELECT label, COUNT(*) AS n, {R('100.0 * COUNT(*) / SUM(COUNT(*)) OVER ()')} AS pct FROM rep GROUP BY 1""",
    [("rep", _REPEAT_SQL)]))(lambda t: p.label_balance(_repeat(t), "label"))


# ---------------------------------------------------------------- trained models (rows-only checks)

def _will_buy_data(t):
    ds = f.purchase_dataset(V(t, "transactions"), V(t, "articles"), V(t, "fashion_customers"))
    ds = p.stratified_split(ds, "will_buy", "customer_id")
    return p.training_copy(p.assemble(p.balanced_weights(ds, "will_buy"), WILL_BUY), "customer_id")


def _metrics_rows(t, fits):
    """Fit each learner on train, AUC on train and test (exact P11), recall at 0.5 on test."""
    data = _will_buy_data(t)
    train, test = data.filter("split = 'train'"), data.filter("split = 'test'")
    rows = []
    for name, fit in fits:
        m = fit(train)
        res = []
        for part in (train, test):
            s = p.positive_probability(m.transform(part))
            res.append(p.auc(s, "will_buy", "score").first()["auc"])
        st = p.positive_probability(m.transform(test))
        rec = st.agg(F.try_divide(F.count_if((F.col("will_buy") == 1) & (F.col("score") >= 0.5)),
                                  F.count_if(F.col("will_buy") == 1)).alias("r")).first()["r"]
        rows.append((name, float(res[0] or 0.0), float(res[1] or 0.0), float(rec or 0.0)))
    return p.auc_gate(p.compare_models(rows, t.spark).withColumnRenamed("auc_test", "auc"), 0.55, 0.85) \
        .withColumnRenamed("auc", "auc_test")


register("pred_compare_will_buy_models")(lambda t: _metrics_rows(t, [
    ("logistic", lambda d: p.train_logistic(d, "will_buy", "weight")),
    ("tree_depth3", lambda d: p.train_tree(d, "will_buy", 3, 50, "weight")),
    ("forest_100x8", lambda d: p.train_forest(d, "will_buy", 100, 8, 1.0, "weight")),
    ("boosted_100x6", lambda d: p.train_boosted(d, "will_buy", 100, 6, 0.1, "weight"))]))


@register("pred_forest_will_buy_scores")
def _p20(t):
    data = _will_buy_data(t)
    m = p.train_forest(data.filter("split = 'train'"), "will_buy", 200, 8, 0.4, "weight")
    feats = f.fill_features(f.customer_features(V(t, "transactions"), V(t, "articles"), V(t, "fashion_customers"),
                                                f.latest_cutoff(V(t, "transactions"))))
    return p.score_will_buy(m, feats, WILL_BUY)


@register("pred_feature_importance")
def _p16(t):
    data = _will_buy_data(t)
    m = p.train_forest(data.filter("split = 'train'"), "will_buy", 200, 8, 0.4, "weight")
    return p.feature_importance(m, WILL_BUY, t.spark)


@register("pred_tree_rules_repeat")
def _p4(t):
    from pyspark.ml.classification import DecisionTreeClassifier
    ds = f.repeat_dataset(V(t, "order_items"), V(t, "products"), V(t, "shop_sessions"), V(t, "users"))
    pipe = p.tabular_pipeline(["first_order_value", "first_order_num_items", "first_order_num_categories",
                               "first_session_depth", "first_session_products_viewed", "first_session_carted",
                               "first_session_purchased", "age"],
                              ["gender", "country", "first_traffic_source"],
                              DecisionTreeClassifier(
                                  labelCol="is_repeat_buyer", maxDepth=4, minInstancesPerNode=50, seed=42,
                                  maxBins=64))
    m = pipe.fit(materialize(f.impute(ds, median_cols=["age"])))
    tree = m.stages[-1]
    return t.spark.createDataFrame([(tree.depth, tree.numNodes, tree.toDebugString)],
                                   "depth int, num_nodes int, rules string")


@register("pred_tier_model_ovr_auc")
def _p7(t):
    from pyspark.ml.classification import RandomForestClassifier
    sales = f.product_sales(V(t, "products"), V(t, "order_items"))
    tiers = cl.product_tiers(f.product_margin(V(t, "products"))).join(sales, "product_id")
    ix = tiers.withColumn("tier_label", F.when(F.col("price_tier") == "Budget", 0)
                          .when(F.col("price_tier") == "Mid-range", 1).otherwise(2))
    pipe = p.tabular_pipeline(["num_sold"], ["category", "department"],
                              RandomForestClassifier(
                                  labelCol="tier_label", numTrees=100, maxDepth=6, seed=42, maxBins=64))
    split = materialize(p.stratified_split(ix, "tier_label", "product_id"))
    m = pipe.fit(split.filter("split = 'train'"))
    return p.macro_ovr_auc(m.transform(split.filter("split = 'test'")), "tier_label")


@register("pred_context_model_scores")
def _p9(t):
    fo, tm, cu = V(t, "fact_order"), V(t, "dim_time"), V(t, "dim_customer")
    ctx = fo.join(tm.select("time_id", "quarter", "weekday"), "time_id") \
        .join(cu.select("customer_id", "state"), "customer_id") \
        .select(F.col("state"), F.col("quarter").cast("string").alias("quarter"), "weekday", "channel",
                (F.col("amount") > 50000).cast("int").alias("label"))
    ctx = materialize(ctx)
    m = p.context_pipeline(["state", "quarter", "weekday", "channel"], "label").fit(ctx)
    contexts = ctx.select("state", "quarter", "weekday", "channel").distinct()
    return p.score_contexts(m, contexts)


@register("pred_extend_forest")
def _p19(t):
    data = _will_buy_data(t)
    train = data.filter("split = 'train'")
    ens = p.ForestEnsemble().extend(train, "will_buy", 20, max_depth=8, weight="weight")
    ens = ens.extend(train, "will_buy", 20, max_depth=8, weight="weight", seed=7)
    s = ens.score(data.filter("split = 'test'"))
    return p.auc(s, "will_buy", "score").withColumn("n_trees", F.lit(ens.n_trees))


@register("pred_return_model")
def _p8_returns(t):
    from pyspark.ml.classification import GBTClassifier
    work = Work(t.spark, "return-model")
    num, cat = ["sale_price", "age"], ["category", "department", "gender", "country", "traffic_source"]
    # only what the learner reads, joined once for the age's median and for the split; a stored step a join,
    # so that the shuffle files of all joins are not there at once
    oi = work.store(V(t, "order_items").select("order_id", "line_no", "user_id", "product_id", "sale_price", "status"), "items")
    ds = f.return_dataset(oi, V(t, "products"), V(t, "users")).select("order_id", "line_no", *num, *cat, "is_returned")
    ds = work.store(ds, "rows")
    work.drop("items")
    ds = f.impute(ds, median_cols=["age"], text_cols=["gender", "country", "traffic_source"])
    split = p.stratified_split(ds, "is_returned", "order_id", store=lambda df: work.store(df, "ordered"))
    split = p.training_copy(split, "order_id", "line_no", rows=p.BOOSTED_ROWS, work=work, spent=["rows", "ordered"])
    pipe = p.tabular_pipeline(num, cat,
                              GBTClassifier(labelCol="is_returned", maxIter=50, maxDepth=5, stepSize=0.1, seed=42,
                                            maxBins=64))
    m = pipe.fit(split.filter("split = 'train'"))
    s = p.positive_probability(m.transform(split.filter("split = 'test'")))
    return p.auc_gate(p.auc(s, "is_returned", "score"))


@register("pred_lookalike_model")
def _p8_lookalike(t):
    from pyspark.ml.classification import RandomForestClassifier
    from shopframe.operators import clustering as cl
    r9 = f.rfm_behaviour_9_fixed(V(t, "order_items"), V(t, "shop_sessions")).dropna()
    seg = cl.segments(r9, f.RFM9, 4, 42, "monetary", ["Dormant", "Occasional", "Promising", "VIP"])
    ds = f.lookalike_dataset(V(t, "order_items"), V(t, "products"), V(t, "shop_sessions"), V(t, "users"),
                             seg.select("user_id", "is_vip"))
    ds = f.impute(ds, median_cols=["age"], text_cols=["gender", "country", "first_traffic_source"])
    ds = p.balanced_weights(ds, "is_vip")
    split = p.training_copy(p.stratified_split(ds, "is_vip", "user_id"), "user_id")
    pipe = p.tabular_pipeline(["first_order_num_items", "first_order_num_categories", "first_session_depth",
                               "first_session_products_viewed", "first_session_carted", "age"],
                              ["gender", "country", "first_traffic_source"],
                              RandomForestClassifier(labelCol="is_vip", weightCol="weight", numTrees=200, maxDepth=8,
                                                     seed=42, maxBins=64))
    m = pipe.fit(split.filter("split = 'train'"))
    s = p.positive_probability(m.transform(split.filter("split = 'test'")))
    return p.auc_gate(p.auc(s, "is_vip", "score"))


@register("pred_vip_model")
def _p8_vip(t):
    """VIP (top-quartile spend) from first-order / first-session / profile features; tree + forest."""
    from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
    oi = V(t, "order_items")
    vip = f.vip_by_percentile(oi).select("user_id", F.lit(1).alias("v"))
    labels = oi.select("user_id").distinct().join(vip, "user_id", "left") \
        .select("user_id", F.coalesce("v", F.lit(0)).alias("is_vip"))
    ds = f.vip_dataset(oi, V(t, "products"), V(t, "shop_sessions"), V(t, "users"), labels)
    ds = f.impute(ds, median_cols=["age"], text_cols=["gender", "country", "traffic_source", "first_order_department"])
    split = p.training_copy(p.stratified_split(p.balanced_weights(ds, "is_vip"), "is_vip", "user_id"), "user_id")
    num = ["first_order_num_items", "first_order_num_categories", "first_session_depth",
           "first_session_products_viewed", "age"]
    cat = ["gender", "country", "traffic_source", "first_order_department"]
    rows = []
    for name, learner in [
            ("tree_depth5", DecisionTreeClassifier(labelCol="is_vip", weightCol="weight", maxDepth=5,
                                                   minInstancesPerNode=200, seed=42, maxBins=64)),
            ("forest_200x8", RandomForestClassifier(labelCol="is_vip", weightCol="weight", numTrees=200, maxDepth=8,
                                                    seed=42, maxBins=64))]:
        m = p.tabular_pipeline(num, cat, learner).fit(split.filter("split = 'train'"))
        s = p.positive_probability(m.transform(split.filter("split = 'test'")))
        rows.append(p.auc(s, "is_vip", "score").withColumn("model", F.lit(name)))
    return p.auc_gate(rows[0].unionByName(rows[1]))
