"""Registered queries of operators whose usual input is a fitted model or a file.

Scores, clusters and segments are rules over the given tables here, so that
every step after the fit has an exact oracle; sinks are written and read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopframe.catalog.base import register
from shopframe.catalog.rules import TIER_HI, TIER_LO, _prod_sets, _PROD_ITEMS, _register_rules, rules_out
from shopframe.functions.exprs import draw_sql, rnd, rnd_sql as R
from shopframe.operators import clustering as cl
from shopframe.operators import etl as e
from shopframe.operators import features as f
from shopframe.operators import ingest as ing
from shopframe.operators import prediction as p
from shopframe.operators import rules as r
from shopframe.operators import survey as v
from shopframe.plans.oracle import with_views as W
from shopframe.session import checkpoint_dir, materialize
from shopframe.sources import sinks

NC = "status != 'Cancelled'"


def V(t, name):
    return t.view(name)


def _folder(t, name: str) -> str:
    return f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- S3, S5, E24, I3, V31

@register("sink_chunked_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders""")
def _s3(t):
    path = _folder(t, "chunks")
    df = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    sinks.export_chunked(df, path, rows=10_000)
    return t.spark.read.schema(df.schema).option("header", True).csv(path)


@register("sink_csv_roundtrip", """
SELECT c_mktsegment, COUNT(*) AS n, MIN(c_name) AS first_name FROM customer GROUP BY c_mktsegment""")
def _s5(t):
    path = _folder(t, "csv")
    df = t["customer"].groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.min("c_name").alias("first_name"))
    sinks.export_csv(df, path)
    return t.spark.read.schema(df.schema).option("header", True).csv(path)


@register("etl_run_log", """
SELECT job, 'SUCCESS' AS status, CAST(n AS BIGINT) AS n_rows FROM (
  SELECT 'LOAD_CUSTOMER' AS job, COUNT(*) AS n FROM customer UNION ALL SELECT 'LOAD_PART', COUNT(*) FROM part
  UNION ALL SELECT 'LOAD_ORDERS', COUNT(*) FROM orders
  UNION ALL SELECT 'RUN_ALL', (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM part) + (SELECT COUNT(*) FROM orders))""")
def _e24(t):
    path = _folder(t, "load")

    def load(name):
        def run():
            sinks.replace_table(t[name], f"{path}/{name}")
            return sinks.read_current(t.spark, f"{path}/{name}").count()
        return run
    log = e.run_all_with_log(t.spark, [(n.upper(), load(n)) for n in ("customer", "part", "orders")], f"{path}/log")
    return log.select("job", "status", "n_rows")


@register("ingest_append_batch", W(["transactions"], """
SELECT t_dat, customer_id, article_id, price, sales_channel_id FROM transactions"""))
def _i3(t):
    """All transactions, appended twice under one batch id: the second time replaces the first.
    They are joined once and cached for both."""
    path = _folder(t, "append")
    batch = V(t, "transactions").select("t_dat", "customer_id", F.col("article_id").cast("string").alias("article_id"), "price", "sales_channel_id").persist()
    try:
        for _ in range(2):
            ing.append_transactions(batch, V(t, "fashion_customers"), V(t, "articles"), path, batch_id="all")
    finally:
        batch.unpersist()
    back = T.StructType([x if x.name != "article_id" else T.StructField("article_id", T.LongType()) for x in batch.schema])
    return t.spark.read.schema(back).parquet(f"{path}/ingest_batch=all")


register("survey_describe_orders", """
SELECT CAST(ROW_NUMBER() OVER () AS INTEGER) AS ordinal_position, column_name,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' ELSE 'timestamp_ntz' END AS data_type,
       (SELECT COUNT(*) FROM orders) AS n_rows
FROM (DESCRIBE orders)""")(
    lambda t: v.describe_table(t["orders"]).crossJoin(t["orders"].agg(F.count(F.lit(1)).alias("n_rows")))
    .select("ordinal_position", "column_name", "data_type", "n_rows"))


# ---------------------------------------------------------------- C8, C9, C12 with given clusters

_SOLD = f"""SELECT pr.id AS product_id, pr.category, pr.department, pr.retail_price, pr.retail_price - pr.cost AS margin_amount, s.n AS sales_volume,
  CAST(pr.id % 6 AS INTEGER) AS cluster_id
  FROM products pr JOIN (SELECT product_id, COUNT(*) AS n FROM order_items WHERE {NC} GROUP BY ALL) s ON s.product_id = pr.id
  WHERE pr.retail_price > 0 AND pr.cost > 0"""


def _sold(t):
    m = f.product_margin(V(t, "products")).join(f.product_sales(V(t, "products"), V(t, "order_items")).withColumnRenamed("num_sold", "sales_volume"), "product_id")
    return m.filter(F.col("sales_volume") > 0).withColumn("cluster_id", (F.col("product_id") % 6).cast("int"))


# against the median of the six clusters' means: the mean of the third and fourth
_SEGMENTED = """SELECT s.*, CASE WHEN margin_amount > x AND sales_volume > y THEN 'Stars' WHEN sales_volume > y THEN 'Cash Cows'
    WHEN margin_amount > x THEN 'Question Marks' ELSE 'Dogs' END AS segment
  FROM sold s, (SELECT list_aggregate(list_sort(list(mx))[3:4], 'avg') AS x, list_aggregate(list_sort(list(my))[3:4], 'avg') AS y
    FROM (SELECT AVG(margin_amount) AS mx, AVG(sales_volume) AS my FROM sold GROUP BY cluster_id))"""
PV = ["products", "order_items"]

register("cluster_portfolio_given", W(PV, f"""
SELECT segment, COUNT(*) AS num_products, {R('SUM(margin_amount) / COUNT(*)', 6)} AS avg_margin, {R('SUM(sales_volume) / COUNT(*)', 6)} AS avg_volume,
       {R('SUM(margin_amount * sales_volume)')} AS total_profit
FROM segmented GROUP BY segment""", [("sold", _SOLD), ("segmented", _SEGMENTED)]))(
    lambda t: cl.portfolio_summary(cl.portfolio_segment(_sold(t))).select(
        "segment", "num_products", rnd("avg_margin", 6).alias("avg_margin"), rnd("avg_volume", 6).alias("avg_volume"), rnd("total_profit").alias("total_profit")))

_TIER = f"CASE WHEN retail_price < {TIER_LO} THEN 'Budget' WHEN retail_price <= {TIER_HI} THEN 'Mid-range' ELSE 'Premium' END"


def _price_tiers(t):
    rp = F.col("retail_price")
    return f.product_margin(V(t, "products")).withColumn(
        "price_tier", F.when(rp < TIER_LO, "Budget").when(rp <= TIER_HI, "Mid-range").otherwise("Premium"))


register("cluster_tier_summary_given", W(["products"], f"""
SELECT {_TIER} AS price_tier, COUNT(*) AS num_products, {R('AVG(retail_price)', 6)} AS avg_price, {R('AVG(cost)', 6)} AS avg_cost,
       {R('AVG((retail_price - cost) / retail_price)', 4)} AS avg_margin_pct FROM products WHERE cost > 0 AND retail_price > 0 GROUP BY 1"""))(
    lambda t: cl.tier_summary(_price_tiers(t)).select("price_tier", "num_products", rnd("avg_price", 6).alias("avg_price"),
                                                      rnd("avg_cost", 6).alias("avg_cost"), rnd("avg_margin_pct", 4).alias("avg_margin_pct")))

register("cluster_top_categories_given", W(["products"], f"""
SELECT price_tier, category, COUNT(*) AS num_products FROM (
  SELECT {_TIER} AS price_tier, category, DENSE_RANK() OVER (ORDER BY total DESC, category) AS place
  FROM (SELECT *, COUNT(*) OVER (PARTITION BY category) AS total FROM products WHERE cost > 0 AND retail_price > 0))
WHERE place <= 8 GROUP BY ALL"""))(lambda t: cl.top_categories_per_tier(_price_tiers(t)))


# ---------------------------------------------------------------- F32, A10, A11

_LABELLED = f"""SELECT 'all' AS seg, CAST(oi.order_id AS VARCHAR) AS bid, s.category || ' (' || s.segment || ')' AS item
FROM order_items oi JOIN segmented s ON s.product_id = oi.product_id WHERE oi.{NC}
QUALIFY COUNT(DISTINCT s.category || s.segment) OVER (PARTITION BY oi.order_id) > 1"""


def _labelled_sets(t):
    seg = cl.portfolio_segment(_sold(t)).select("product_id", "segment")
    return f.category_segment_labels(V(t, "order_items"), V(t, "products"), seg)


register("feat_category_segment_labels", W(PV, f"""
SELECT CAST(bid AS BIGINT) AS order_id, string_agg(item, '|' ORDER BY item) AS items_key FROM (SELECT DISTINCT bid, item FROM ({_LABELLED})) GROUP BY bid""",
    [("sold", _SOLD), ("segmented", _SEGMENTED)]))(
    lambda t: _labelled_sets(t).select("order_id", F.array_join("items", "|").alias("items_key")))

_register_rules("rules_profit_given_segments", PV, _LABELLED,
                lambda t: rules_out(r.profit_rules(_labelled_sets(t), 0.0005, 0.5), ranked=True), pre_ctes=[("sold", _SOLD), ("segmented", _SEGMENTED)],
                min_support=0.0005, metric="lift", threshold=0.5, top=10,
                extra="AND len(list_filter(con, lambda x: x LIKE '%(Stars)' OR x LIKE '%(Question Marks)')) > 0")

# the report's support of .002 finds no product pair in the small tables
_register_rules("rules_niche_products_low_support", ["fact_order"], _PROD_ITEMS,
                lambda t: rules_out(r.niche_product_rules(_prod_sets(t), 0.0001, 0.02), ranked=True),
                min_support=0.0001, metric="confidence", threshold=0.02, top=5)


# ---------------------------------------------------------------- F35, P13, P17, P18

@register("feat_one_hot_gender", W(["users"], """
SELECT id, CASE gender WHEN 'F' THEN '1.0|0.0' WHEN 'M' THEN '0.0|1.0' ELSE '0.0|0.0' END AS gender_vec FROM users"""))
def _f35(t):
    from pyspark.ml.functions import vector_to_array
    users = V(t, "users").select("id", "gender")
    out = f.one_hot_pipeline(["gender"]).fit(users).transform(users)
    return out.select("id", F.array_join(vector_to_array("gender_vec").cast("array<string>"), "|").alias("gender_vec"))


def _rank_auc(label: str, score: str, source: str) -> str:
    """Area under the curve from mid-ranks."""
    return f"""SELECT (SUM(mid) FILTER (WHERE y) - COUNT(*) FILTER (WHERE y) * (COUNT(*) FILTER (WHERE y) + 1) / 2.0)
      / (COUNT(*) FILTER (WHERE y) * COUNT(*) FILTER (WHERE NOT y))
    FROM (SELECT y, RANK() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0 AS mid
          FROM (SELECT {label} AS y, {score} AS s FROM {source}))"""


_PROBS = {0: "1.0 / volume", 1: "volume % 7 + 0.0", 2: "(product_id * 37) % 101 + volume / 1000.0"}
_TIERED = f"""SELECT s.product_id, s.sales_volume AS volume,
  CASE {_TIER} WHEN 'Budget' THEN 0 WHEN 'Mid-range' THEN 1 ELSE 2 END AS label FROM sold s"""


def _scored_tiers(t):
    rp, n = F.col("retail_price"), F.col("sales_volume").cast("double")
    return _sold(t).select(
        F.when(rp < TIER_LO, 0).when(rp <= TIER_HI, 1).otherwise(2).alias("label"),
        F.array(F.lit(1.0) / n, (F.col("sales_volume") % 7).cast("double"), (F.col("product_id") * 37 % 101) + n / 1000.0).alias("probability"))


_OVR = " UNION ALL ".join(f"SELECT '{c}' AS class, ({_rank_auc(f'label = {c}', s, 'tiered')}) AS auc" for c, s in _PROBS.items())
register("pred_macro_ovr_auc_given", W(PV, f"""
SELECT class, {R('auc', 9)} AS auc, passed FROM (
  SELECT class, auc, CAST(NULL AS BOOLEAN) AS passed FROM ovr UNION ALL SELECT 'macro', AVG(auc), AVG(auc) > 0.7 FROM ovr)""",
    [("sold", _SOLD), ("tiered", _TIERED), ("ovr", _OVR)]))(
    lambda t: p.macro_ovr_auc(_scored_tiers(t), "label").select("class", rnd("auc", 9).alias("auc"), "passed"))

# two scores of a product (its sales, a digest of its id) against the label "in the budget tier"
_HALVES = f"""SELECT *, CASE WHEN rn <= n - FLOOR(0.2 * n + 0.5) THEN 'train' ELSE 'test' END AS part FROM (
  SELECT product_id, CAST(label = 0 AS INTEGER) AS label, volume, product_id * 37 % 101 AS digest, COUNT(*) OVER (PARTITION BY label = 0) AS n,
         ROW_NUMBER() OVER (PARTITION BY label = 0 ORDER BY {draw_sql('product_id', 42)}, product_id) AS rn FROM tiered)"""
_RULES = {"volume": 25, "digest": 50}


@register("pred_compare_given_scores", W(PV, f"""
SELECT model, {R('auc_train', 9)} AS auc_train, {R('auc_test', 9)} AS auc_test, {R('recall', 9)} AS recall,
       {R('auc_train - auc_test', 9)} AS gap, auc_test = MAX(auc_test) OVER () AS is_best,
       IF(auc_test > 0.55 AND auc_test < 0.85, 'PASS', 'FAIL') AS gate
FROM ({' UNION ALL '.join(f"""SELECT '{m}' AS model, ({_rank_auc('label = 1', m, "(SELECT * FROM halves WHERE part = 'train')")}) AS auc_train,
  ({_rank_auc('label = 1', m, "(SELECT * FROM halves WHERE part = 'test')")}) AS auc_test,
  (SELECT COUNT(*) FILTER (WHERE {m} >= {least}) / COUNT(*) FROM halves WHERE part = 'test' AND label = 1) AS recall""" for m, least in _RULES.items())})""",
    [("sold", _SOLD), ("tiered", _TIERED), ("halves", _HALVES)]))
def _p17(t):
    d = _sold(t).select("product_id", (F.col("retail_price") < TIER_LO).cast("int").alias("label"), F.col("sales_volume").alias("volume"), (F.col("product_id") * 37 % 101).alias("digest"))
    split = materialize(p.stratified_split(d, "label", "product_id"))
    rows = []
    for name, least in _RULES.items():
        auc = [p.auc(split.filter(F.col("split") == part), "label", name).first()["auc"] for part in ("train", "test")]
        recall = split.filter("split = 'test' and label = 1").agg(F.avg((F.col(name) >= least).cast("double"))).first()[0]
        rows.append((name, float(auc[0]), float(auc[1]), float(recall)))
    out = p.auc_gate(p.compare_models(rows, t.spark).withColumn("auc", F.col("auc_test")))
    return out.select("model", *[rnd(c, 9).alias(c) for c in ("auc_train", "auc_test", "recall", "gap")], "is_best", "gate")
