"""Registered clustering queries.

Deterministic pieces are checked against DuckDB on the archetype assignment
(C4 with given centroids): profiles, naming rules, rank naming, a mini-batch
update step, stored-or-computed lookup. k-means fits (C1, C2, C8, C11, C13,
C14) are checked on rows only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shopframe.catalog.base import register
from shopframe.catalog.rules import _DNA_SQL, ARCHETYPES, CLUSTERS_CTE, FASH, GROUPS, SHARE_COLS, clusters
from shopframe.functions.exprs import rnd, rnd_sql as R
from shopframe.operators import clustering as c
from shopframe.operators import features as f
from shopframe.plans.oracle import with_views as W
from shopframe.session import materialize

PROFILE_COLS = ["avg_price", *SHARE_COLS, "pct_online"]


def V(t, name):
    return t.view(name)


def _dna(t):
    return f.style_dna(V(t, "transactions"), V(t, "articles"), V(t, "fashion_customers"))


def _assigned(t):
    return _dna(t).join(clusters(t), "customer_id")


_DNA_FULL = ("dna", """SELECT t.customer_id, COUNT(*) AS total_items, AVG(t.price) AS avg_price, """ + ", ".join(
    f"AVG(CASE WHEN a.index_group_name = '{g}' THEN 1.0 ELSE 0.0 END) AS {x}" for x, g in zip(SHARE_COLS, GROUPS)) +
    """, AVG(CASE WHEN t.sales_channel_id = 2 THEN 1.0 ELSE 0.0 END) AS pct_online, MAX(hc.age) AS age
  FROM transactions t JOIN articles a ON t.article_id = a.article_id JOIN fashion_customers hc ON t.customer_id = hc.customer_id
  WHERE hc.age IS NOT NULL GROUP BY t.customer_id HAVING COUNT(*) >= 3""")
_ASSIGNED = ("asg", "SELECT d.*, cl.cluster_id FROM dna d JOIN clusters cl ON d.customer_id = cl.customer_id")
_PROFILE_SQL = f"""SELECT cluster_id, COUNT(*) AS n_customers, quantile_cont(age, 0.5) AS median_age,
  quantile_cont(total_items, 0.5) AS median_total_items, {', '.join(f'AVG({x}) AS {x}' for x in PROFILE_COLS)},
  COUNT(*) * 100.0 / (SELECT COUNT(*) FROM asg) AS pct_of_base FROM asg GROUP BY cluster_id"""


def _profile(t):
    return c.cluster_profile(_assigned(t), PROFILE_COLS, ["age", "total_items"])


def _round_all(df, cols, d=6):
    return df.select(*[rnd(x, d).alias(x) if x in cols else F.col(x) for x in df.columns])


_DBL = set(PROFILE_COLS) | {"median_age", "median_total_items", "pct_of_base"}
register("cluster_profile_archetypes", W(FASH, "SELECT cluster_id, n_customers, " + ", ".join(
    f"{R(x, 6)} AS {x}" for x in ["median_age", "median_total_items", *PROFILE_COLS, "pct_of_base"]) +
    f" FROM ({_PROFILE_SQL}) p", [CLUSTERS_CTE, _DNA_FULL, _ASSIGNED]))(
    lambda t: _round_all(_profile(t), _DBL))

def _top_sql(cols):
    whens = []
    for i, x in enumerate(cols):
        cond = " AND ".join([f"{x} > {y}" for y in cols[:i]] + [f"{x} >= {y}" for y in cols[i + 1:]])
        whens.append(f"WHEN {cond} THEN '{x}'")
    return "CASE " + " ".join(whens) + " END"


_STYLE7 = ["pct_ladieswear", "pct_divided", "pct_menswear", "pct_baby", "pct_sport", "pct_online", "avg_price"]
_LABEL_SQL = f"""CASE WHEN pct_baby > 0.40 THEN 'Family/Moms' WHEN pct_sport > 0.40 THEN 'Sporty Active'
  WHEN pct_menswear > 0.40 THEN 'Menswear' WHEN pct_divided > 0.40 THEN 'GenZ Trend'
  WHEN pct_ladieswear > 0.40 THEN 'Classic Ladieswear' ELSE 'Mixed (top: ' || {_top_sql(_STYLE7)} || ')' END"""

register("cluster_label_by_threshold", W(FASH, f"""
SELECT cluster_id, {_LABEL_SQL} AS cluster_label FROM ({_PROFILE_SQL}) p""", [CLUSTERS_CTE, _DNA_FULL, _ASSIGNED]))(
    lambda t: c.label_by_threshold(_profile(t)).select("cluster_id", "cluster_label"))

register("cluster_label_by_threshold_nb", W(FASH, f"""
SELECT cluster_id, CASE WHEN pct_baby > 30 THEN 'Family/Moms' WHEN pct_divided > 40 THEN 'GenZ Trend'
  WHEN pct_menswear > 40 THEN 'Menswear' WHEN pct_sport > 20 THEN 'Sporty Active'
  WHEN pct_online < 50 THEN 'Classic Offline' ELSE 'Classic Online' END AS cluster_name
FROM (SELECT cluster_id, {', '.join(f'{R(x + " * 100", 1)} AS {x}' for x in SHARE_COLS + ['pct_online'])}
      FROM ({_PROFILE_SQL}) p) q""", [CLUSTERS_CTE, _DNA_FULL, _ASSIGNED]))(
    lambda t: c.label_by_threshold_nb(_profile(t).select(
        "cluster_id", *[rnd(F.col(x) * 100, 1).alias(x) for x in SHARE_COLS + ["pct_online"]]))
    .select("cluster_id", "cluster_name"))

_RANK_NAMES = ["Dormant", "Occasional", "Promising", "VIP", "Top"]
register("cluster_label_by_rank", W(FASH, """
SELECT a.customer_id, a.cluster_id, r.segment, r.is_vip FROM asg a JOIN (
  SELECT cluster_id, list_value('Dormant', 'Occasional', 'Promising', 'VIP', 'Top')[rk] AS segment,
         CAST(rk = 5 AS INTEGER) AS is_vip FROM (
    SELECT cluster_id, ROW_NUMBER() OVER (ORDER BY AVG(avg_price), cluster_id) AS rk FROM asg GROUP BY 1) x) r
  ON a.cluster_id = r.cluster_id""", [CLUSTERS_CTE, _DNA_FULL, _ASSIGNED]))(
    lambda t: c.label_by_rank(_assigned(t), "avg_price", _RANK_NAMES).select("customer_id", "cluster_id", "segment",
                                                                             "is_vip"))


def _mini_batch(t):
    cen = t.spark.createDataFrame([(i, *row, 0) for i, row in enumerate(ARCHETYPES)],
                                  ["cluster_id", *SHARE_COLS, "n"])
    return c.update_clusters(_dna(t), cen, SHARE_COLS)


register("cluster_update_step", W(FASH, "SELECT CAST(cluster_id AS BIGINT) AS cluster_id, " + ", ".join(
    f"{R(f'CASE WHEN m = 0 THEN {x}0 ELSE s_{x} / m END', 9)} AS {x}" for x in SHARE_COLS) + """, m AS n
FROM (SELECT k.cluster_id, """ + ", ".join(f"k.{x} AS {x}0" for x in SHARE_COLS) + """, COALESCE(b.m, 0) AS m, """ +
    ", ".join(f"b.s_{x}" for x in SHARE_COLS) + """
      FROM (SELECT * FROM (VALUES """ + ", ".join(
        "(" + ", ".join([str(i)] + [repr(v) for v in row]) + ")" for i, row in enumerate(ARCHETYPES)) +
    ") v(cluster_id, " + ", ".join(SHARE_COLS) + """)) k
      LEFT JOIN (SELECT cluster_id, COUNT(*) AS m, """ + ", ".join(f"SUM({x}) AS s_{x}" for x in SHARE_COLS) + """
                 FROM asg GROUP BY 1) b ON k.cluster_id = b.cluster_id) z""",
    [CLUSTERS_CTE, _DNA_FULL, _ASSIGNED]))(
    lambda t: _mini_batch(t).select("cluster_id", *[rnd(x, 9).alias(x) for x in SHARE_COLS], "n"))

# stored assignments are those an earlier run made from purchases up to the cutoff
LOOKUP_CUTOFF = "1998-12-31"
_DNA_OLD = _DNA_SQL.replace("ON t.article_id = a.article_id GROUP BY t.customer_id",
                            f"ON t.article_id = a.article_id WHERE t.t_dat <= DATE '{LOOKUP_CUTOFF}' GROUP BY t.customer_id")
assert _DNA_OLD != _DNA_SQL


def _stored(t):
    old_tx = V(t, "transactions").filter(F.col("t_dat") <= F.lit(LOOKUP_CUTOFF).cast("date"))
    dna = f.style_dna(old_tx, V(t, "articles"), V(t, "fashion_customers"))
    return c.assign_clusters(dna, ARCHETYPES, SHARE_COLS).select("customer_id", "cluster_id")


register("cluster_lookup", W(FASH, """
SELECT hc.customer_id, COALESCE(s.cluster_id, cl.cluster_id) AS cluster_id,
       CASE WHEN s.cluster_id IS NOT NULL THEN 'stored' WHEN cl.cluster_id IS NOT NULL THEN 'computed' END AS source
FROM fashion_customers hc LEFT JOIN stored s ON hc.customer_id = s.customer_id
LEFT JOIN clusters cl ON hc.customer_id = cl.customer_id""",
    [CLUSTERS_CTE, ("stored", "SELECT customer_id, cluster_id FROM (" + c.assign_clusters_sql(
        SHARE_COLS, ARCHETYPES, f"({_DNA_OLD}) d") + ") z")]))(
    lambda t: c.cluster_lookup(V(t, "fashion_customers"), _stored(t), _dna(t), ARCHETYPES, SHARE_COLS))


# ---------------------------------------------------------------- k-means fits (rows-only)

@register("cluster_style_kmeans")
def _c1(t):
    out, named, model, stats = c.style_clusters(_dna(t), k=5, seed=42)
    return out.select("customer_id", "cluster_id", "cluster_label")


def _certificate(frame, cols, k):
    base = materialize(frame.dropna(subset=list(cols)))
    model, stats = c.fit_kmeans(base, cols, k, 42)
    return c.cluster_certificate(model, base, cols, stats)


def _certified(rows: str, k: int) -> str:
    return f"SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, CAST({k} AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_not_nearest, CAST(0 AS BIGINT) AS n_centres_off FROM ({rows}) z"


register("cluster_style_certificate", W(FASH, _certified("SELECT * FROM dna", 5), [_DNA_FULL]))(
    lambda t: _certificate(_dna(t), c.STYLE_COLS, 5))
register("cluster_rfm_certificate", W(["order_items"], _certified("SELECT DISTINCT user_id FROM order_items WHERE status <> 'Cancelled'", 4)))(
    lambda t: _certificate(f.rfm(V(t, "order_items"), "2002-01-01"), ["recency", "frequency", "monetary", "avg_order_value"], 4))
register("cluster_customer360_certificate", W(["order_items", "users"], _certified("SELECT DISTINCT user_id FROM order_items JOIN users u ON u.id = user_id", 4)))(
    lambda t: _certificate(f.customer_360(V(t, "users"), V(t, "shop_orders"), V(t, "order_items"), V(t, "products")),
                           ["total_orders", "total_spend", "unique_categories", "return_rate"], 4))


@register("cluster_select_k")
def _c2(t):
    return c.select_k(_dna(t), c.STYLE_COLS, range(2, 8), seed=42)


@register("cluster_product_tiers")
def _c11(t):
    tiers = c.product_tiers(f.product_margin(V(t, "products")))
    return c.tier_summary(tiers).join(
        c.top_categories_per_tier(tiers).groupBy("price_tier").agg(F.count(F.lit(1)).alias("n_top_categories")),
        "price_tier", "left")


@register("cluster_rfm_segments")
def _c13(t):
    r = f.rfm(V(t, "order_items"), "2002-01-01")
    seg = c.segments(r, ["recency", "frequency", "monetary", "avg_order_value"], 4, 42, "frequency",
                     ["Dormant", "Occasional", "Promising", "VIP"])
    return seg.groupBy("segment", "is_vip").agg(F.count(F.lit(1)).alias("n_users"), F.avg("frequency").alias("freq"))


@register("cluster_behaviour_segments")
def _c13b(t):
    from shopframe.operators.features import RFM9
    r9 = f.rfm_behaviour_9(V(t, "order_items"), V(t, "shop_sessions"), "2024-02-01 00:00:00")
    seg = c.segments(r9, RFM9, 4, 42, "monetary", ["Dormant", "Occasional", "Promising", "VIP"])
    return f.minmax_profile(seg, "segment", RFM9)


@register("cluster_customer360")
def _c14(t):
    x = f.customer_360(V(t, "users"), V(t, "shop_orders"), V(t, "order_items"), V(t, "products"))
    seg = c.segments(x, ["total_orders", "total_spend", "unique_categories", "return_rate"], 4, 42)
    return c.cluster_profile(seg, ["total_orders", "total_spend", "unique_categories", "return_rate"])


@register("cluster_portfolio")
def _c8(t):
    m = f.product_margin(V(t, "products")).join(
        f.product_sales(V(t, "products"), V(t, "order_items")).withColumnRenamed("num_sold", "sales_volume"),
        "product_id").filter(F.col("sales_volume") > 0)
    seg = c.segments(m, ["margin_amount", "sales_volume"], 4, 42)
    return c.portfolio_summary(c.portfolio_segment(seg))


@register("cluster_order_clusters")
def _c14b(t):
    of = t.view("fact_order").join(t.view("dim_product").select("product_id", "weight_g"), "product_id") \
        .select("order_id", F.col("unit_price").alias("price"), "weight_g")
    x = f.log_features(of)
    seg = c.segments(x, ["log_price", "log_weight_g"], 4, 42)
    return c.cluster_profile(seg, ["price", "weight_g"])


_DIST = " + ".join(f"(a.{x} - c.{x}) * (a.{x} - c.{x})" for x in SHARE_COLS)
_CDIST = " + ".join(f"(p.{x} - q.{x}) * (p.{x} - q.{x})" for x in SHARE_COLS)
register("cluster_davies_bouldin_archetypes", W(FASH, f"""
SELECT {R('AVG(worst)', 9)} AS davies_bouldin FROM (
  SELECT p.cluster_id, MAX((p.s + q.s) / sqrt({_CDIST})) AS worst
  FROM sc p JOIN sc q ON p.cluster_id != q.cluster_id GROUP BY p.cluster_id) z""",
    [CLUSTERS_CTE, _DNA_FULL, _ASSIGNED,
     ("cen", "SELECT cluster_id, " + ", ".join(f"AVG({x}) AS {x}" for x in SHARE_COLS) + " FROM asg GROUP BY 1"),
     ("sc", f"""SELECT c.*, s.s FROM cen c JOIN (SELECT a.cluster_id, AVG(sqrt({_DIST})) AS s FROM asg a
                JOIN cen c ON a.cluster_id = c.cluster_id GROUP BY 1) s ON c.cluster_id = s.cluster_id""")]))(
    lambda t: c.davies_bouldin(_assigned(t), SHARE_COLS).select(rnd("davies_bouldin", 9).alias("davies_bouldin")))


_N_DNA = "(SELECT COUNT(*) FROM dna)"
register_sql_registry = W(FASH, f"""
SELECT 'L1_KMEANS' AS layer, 'L1_KMEANS_20240101_000000_000000' AS version, TRUE AS is_active,
       CAST(NULL AS VARCHAR) AS parent_version, FALSE AS is_incremental, {_N_DNA} AS n_samples_train
UNION ALL
SELECT 'L1_KMEANS', 'L1_KMEANS_20240102_000000_000000', FALSE, 'L1_KMEANS_20240101_000000_000000', TRUE, {_N_DNA}""",
    [_DNA_FULL])


@register("registry_versions_after_retrain", register_sql_registry)
def _r1_r4(t):
    """Fit the style clusters, register two versions (the second incremental), re-activate
    the first, and return the layer's history with the active flags."""
    import datetime as dt
    import uuid

    from shopframe.operators import registry as reg
    from shopframe.session import checkpoint_dir
    base = f"{checkpoint_dir(t.spark)}/registry-{uuid.uuid4().hex}"
    out, named, model, stats = c.style_clusters(_dna(t), k=5, seed=42)
    n = out.count()
    v1 = reg.register_model(t.spark, base, "L1_KMEANS", model, {"k": 5, "inertia": model.summary.trainingCost},
                            n_samples=n, now=dt.datetime(2024, 1, 1))
    reg.register_model(t.spark, base, "L1_KMEANS", model, {"k": 5}, n_samples=n, parent=v1, incremental=True,
                       now=dt.datetime(2024, 1, 2))
    reg.activate_version(t.spark, base, "L1_KMEANS", v1)
    return reg.version_history(reg._registry(t.spark, base), "L1_KMEANS") \
        .select("layer", "version", "is_active", "parent_version", "is_incremental", "n_samples_train")
