"""Registered rule-mining queries (A1-A16, C4) with brute-force DuckDB oracles.

Segments: customers are assigned to the nearest of five style archetypes
(C4 with given centroids: all purchases in one index group), which is
deterministic and therefore checkable. The oracle enumerates itemsets up to
three items with self joins and writes out every antecedent/consequent split.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shopframe.catalog.base import register
from shopframe.functions.exprs import rnd, rnd_sql as R
from shopframe.operators import clustering as c
from shopframe.operators import features as f
from shopframe.operators import rules as r
from shopframe.plans.oracle import with_views as W

NC = "status != 'Cancelled'"
SHARE_COLS = ["pct_ladieswear", "pct_divided", "pct_menswear", "pct_baby", "pct_sport"]
# fixed values: one archetype per index group (share 1 in that group, 0 elsewhere)
ARCHETYPES = [[1.0 if i == j else 0.0 for j in range(5)] for i in range(5)]
GROUPS = ["Ladieswear", "Divided", "Menswear", "Baby/Children", "Sport"]
TIER_LO, TIER_HI = 930, 967


def V(t, name):
    return t.view(name)


# ---------------------------------------------------------------- segments (C4)

def clusters(t):
    dna = f.style_dna(V(t, "transactions"), V(t, "articles"), V(t, "fashion_customers"))
    return c.assign_clusters(dna, ARCHETYPES, SHARE_COLS).select("customer_id", "cluster_id")


_DNA_SQL = "SELECT cs.customer_id, " + ", ".join(f"cs.{x}" for x in SHARE_COLS) + """
FROM (SELECT t.customer_id, COUNT(*) AS n, """ + ", ".join(
    f"CAST(SUM(CASE WHEN a.index_group_name = '{g}' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS {x}"
    for x, g in zip(SHARE_COLS, GROUPS)) + """
      FROM transactions t JOIN articles a ON t.article_id = a.article_id GROUP BY t.customer_id HAVING COUNT(*) >= 3) cs
JOIN fashion_customers hc ON cs.customer_id = hc.customer_id WHERE hc.age IS NOT NULL"""
CLUSTERS_CTE = ("clusters", "SELECT customer_id, cluster_id FROM (" +
                c.assign_clusters_sql(SHARE_COLS, ARCHETYPES, f"({_DNA_SQL}) dna") + ") q")
FASH = ["transactions", "articles", "fashion_customers"]

register("cluster_assign_archetypes", W(FASH, "SELECT * FROM clusters", [CLUSTERS_CTE]))(clusters)


# ---------------------------------------------------------------- brute-force rule oracle

def rules_sql(items_sql: str, min_support: float, metric: str, threshold: float, *, seg: str | None = None,
              min_baskets: int = 0, extra: str = "", top: int | None = None, order: str = "lift",
              p: str = "", max_len: int | None = 3) -> tuple:
    """CTEs computing rules from ``items_sql`` rows (seg, bid, item); returns (ctes, final select).

    ``p`` prefixes the CTE names so two rule sets can live in one statement.
    ``max_len=None`` enumerates every subset of every basket with bit masks
    (exact for any itemset length; baskets must be small).
    """
    order_sql = f"{R('lift', 9)} DESC" if order == "lift" else f"{R('lift', 9)} DESC, {R('confidence', 9)} DESC"
    ctes = [
        (f"{p}bi", f"SELECT DISTINCT seg, bid, item FROM ({items_sql}) x"),
        (f"{p}nb", f"SELECT seg, COUNT(DISTINCT bid) AS n FROM {p}bi GROUP BY seg "
                   f"HAVING COUNT(DISTINCT bid) >= {min_baskets}"),
        (f"{p}b", f"SELECT bi.* FROM {p}bi bi JOIN {p}nb nb ON bi.seg = nb.seg"),
        (f"{p}cnt", f"""SELECT seg, [item] AS items, COUNT(*) AS c FROM {p}b GROUP BY seg, item
  UNION ALL SELECT x.seg, [x.item, y.item], COUNT(*) FROM {p}b x JOIN {p}b y ON x.seg = y.seg AND x.bid = y.bid
    AND x.item < y.item GROUP BY x.seg, x.item, y.item
  UNION ALL SELECT x.seg, [x.item, y.item, z.item], COUNT(*) FROM {p}b x JOIN {p}b y ON x.seg = y.seg
    AND x.bid = y.bid AND x.item < y.item JOIN {p}b z ON x.seg = z.seg AND x.bid = z.bid AND y.item < z.item
    GROUP BY x.seg, x.item, y.item, z.item"""),
        (f"{p}fi", f"SELECT cnt.seg, cnt.items, cnt.c / nb.n AS support FROM {p}cnt cnt JOIN {p}nb nb "
                   f"ON cnt.seg = nb.seg WHERE cnt.c / nb.n >= {min_support}"),
        (f"{p}sp", f"""SELECT seg, support, [items[1]] AS ant, [items[2]] AS con FROM {p}fi WHERE len(items) = 2
  UNION ALL SELECT seg, support, [items[2]], [items[1]] FROM {p}fi WHERE len(items) = 2
  UNION ALL SELECT seg, support, [items[1]], [items[2], items[3]] FROM {p}fi WHERE len(items) = 3
  UNION ALL SELECT seg, support, [items[2]], [items[1], items[3]] FROM {p}fi WHERE len(items) = 3
  UNION ALL SELECT seg, support, [items[3]], [items[1], items[2]] FROM {p}fi WHERE len(items) = 3
  UNION ALL SELECT seg, support, [items[1], items[2]], [items[3]] FROM {p}fi WHERE len(items) = 3
  UNION ALL SELECT seg, support, [items[1], items[3]], [items[2]] FROM {p}fi WHERE len(items) = 3
  UNION ALL SELECT seg, support, [items[2], items[3]], [items[1]] FROM {p}fi WHERE len(items) = 3"""),
        (f"{p}rl", f"""SELECT sp.seg, sp.ant, sp.con, sp.support, a.support AS antecedent_support,
    c.support AS consequent_support, sp.support / a.support AS confidence,
    (sp.support / a.support) / c.support AS lift
  FROM {p}sp sp JOIN {p}fi a ON a.seg = sp.seg AND a.items = sp.ant JOIN {p}fi c ON c.seg = sp.seg
    AND c.items = sp.con"""),
        (f"{p}rk", f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY seg ORDER BY {order_sql}, array_to_string(ant, '|'),
    array_to_string(con, '|')) AS rank FROM {p}rl WHERE {metric} >= {threshold} {extra}"""),
    ]
    if max_len is None:
        bit = "lambda x, i: ((m >> (i - 1)) & 1) = 1"
        nbit = "lambda x, i: ((m >> (i - 1)) & 1) = 0"
        ctes[3] = (f"{p}cnt", f"""SELECT seg, s AS items, COUNT(*) AS c FROM (
    SELECT bl.seg, list_filter(bl.items, {bit}) AS s FROM (SELECT seg, bid, list_sort(list(item)) AS items
      FROM {p}b GROUP BY seg, bid) bl, LATERAL (SELECT unnest(range(1, CAST(pow(2, len(bl.items)) AS BIGINT))) AS m) g) z
    GROUP BY seg, s""")
        ctes[5] = (f"{p}sp", f"""SELECT seg, support, list_filter(items, {bit}) AS ant, list_filter(items, {nbit}) AS con
    FROM {p}fi, LATERAL (SELECT unnest(range(1, CAST(pow(2, len(items)) AS BIGINT) - 1)) AS m) g WHERE len(items) >= 2""")
    final = f"""SELECT {'seg AS ' + seg + ', ' if seg else ''}array_to_string(ant, '|') AS antecedent_key,
  array_to_string(con, '|') AS consequent_key, {R('support', 6)} AS support, {R('confidence', 6)} AS confidence,
  {R('lift', 6)} AS lift{', CAST(rank AS INTEGER) AS rank' if top else ''} FROM {p}rk{f' WHERE rank <= {top}' if top else ''}"""
    return ctes, final


def rules_out(rules_df, by=(), ranked=False, extra=()):
    cols = [*by, r.rule_key("antecedent").alias("antecedent_key"), r.rule_key("consequent").alias("consequent_key"),
            rnd("support", 6).alias("support"), rnd("confidence", 6).alias("confidence"), rnd("lift", 6).alias("lift")]
    if ranked:
        cols.append("rank")
    return rules_df.select(*cols, *extra)


def _register_rules(name, views, items_sql, build, pre_ctes=(), **kw):
    ctes, final = rules_sql(items_sql, **kw)
    register(name, W(views, final, list(pre_ctes) + ctes))(build)


# ---------------------------------------------------------------- baskets (SQL row form: seg, bid, item)

_DAY_ITEMS = """SELECT cl.cluster_id AS seg, CAST(t.customer_id AS VARCHAR) || '-' || CAST(t.t_dat AS VARCHAR) AS bid,
       a.product_group_name AS item
FROM transactions t JOIN articles a ON t.article_id = a.article_id JOIN clusters cl ON t.customer_id = cl.customer_id
WHERE (t.customer_id, t.t_dat) IN (SELECT t2.customer_id, t2.t_dat FROM transactions t2
       JOIN articles a2 ON t2.article_id = a2.article_id GROUP BY 1, 2 HAVING COUNT(DISTINCT a2.product_group_name) >= 2)"""


def _day_sets(t):
    return f.baskets(V(t, "transactions"), V(t, "articles"), clusters(t))


_register_rules("rules_app_per_cluster", FASH, _DAY_ITEMS,
                lambda t: rules_out(r.mine_app(_day_sets(t), ["cluster_id"]), ["cluster_id"], True),
                pre_ctes=[CLUSTERS_CTE], min_support=0.01, metric="confidence", threshold=0.2, seg="cluster_id",
                min_baskets=50, extra="AND lift > 1.0", top=50)

_ctes, _final = rules_sql(_DAY_ITEMS, 0.01, "confidence", 0.2, seg="cluster_id", min_baskets=50,
                          extra="AND lift > 1.0", top=50)
register("rules_app_counts", W(FASH, f"SELECT cluster_id, COUNT(*) AS n_rules FROM ({_final}) z GROUP BY 1",
                               [CLUSTERS_CTE] + _ctes))(
    lambda t: r.rules_count(r.mine_app(_day_sets(t), ["cluster_id"]), ["cluster_id"]))

_register_rules("rules_notebook_per_cluster", FASH, _DAY_ITEMS,
                lambda t: rules_out(r.mine_notebook(_day_sets(t), ["cluster_id"]), ["cluster_id"], True),
                pre_ctes=[CLUSTERS_CTE], min_support=0.01, metric="lift", threshold=1.2, seg="cluster_id",
                min_baskets=100, top=5, order="lift_conf", max_len=None)

_VIP = f"""SELECT s.user_id FROM (SELECT user_id, SUM(sale_price) AS sp FROM order_items WHERE {NC} GROUP BY 1) s
  WHERE s.sp > (SELECT quantile_cont(sp, 0.75) FROM (SELECT user_id, SUM(sale_price) AS sp FROM order_items
                WHERE {NC} GROUP BY 1) q)"""
_VIP_ITEMS = f"""SELECT 'all' AS seg, CAST(oi.user_id AS VARCHAR) AS bid, p.category AS item
FROM order_items oi JOIN products p ON oi.product_id = p.id WHERE oi.{NC} AND p.category IS NOT NULL
  AND oi.user_id IN ({_VIP}) AND oi.user_id IN (SELECT oi2.user_id FROM order_items oi2 JOIN products p2
  ON oi2.product_id = p2.id WHERE oi2.{NC} AND p2.category IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT p2.category) >= 2)"""


def _vip_sets(t):
    oi, p = V(t, "order_items"), V(t, "products")
    return f.user_category_baskets(oi, p, f.vip_by_percentile(oi))


def _vip_sql():
    kw = dict(metric="lift", threshold=1.0, extra="AND lift > 1.0 AND confidence >= 0.05")
    c1, f1 = rules_sql(_VIP_ITEMS, 0.01, **kw)
    c2, f2 = rules_sql(_VIP_ITEMS, 0.005, p="fb_", **kw)
    body = f"SELECT *, CAST(0.01 AS DOUBLE) AS min_support_used FROM ({f1}) a UNION ALL " \
           f"SELECT *, CAST(0.005 AS DOUBLE) FROM ({f2}) b WHERE NOT EXISTS (SELECT 1 FROM ({f1}) c)"
    return W(["order_items", "products"], body, c1 + c2)


register("rules_vip", _vip_sql())(lambda t: rules_out(r.rules_vip(_vip_sets(t)), extra=["min_support_used"]))

_DEPT_ITEMS = f"""SELECT p.department AS seg, CAST(oi.order_id AS VARCHAR) AS bid, p.category AS item
FROM order_items oi JOIN products p ON oi.product_id = p.id WHERE oi.{NC} AND (oi.order_id, p.department) IN (
  SELECT oi2.order_id, p2.department FROM order_items oi2 JOIN products p2 ON oi2.product_id = p2.id WHERE oi2.{NC}
  GROUP BY 1, 2 HAVING COUNT(DISTINCT p2.category) >= 2)"""


def _dept_sets(t):
    oi, p = V(t, "order_items"), V(t, "products")
    j = oi.filter(F.col("status") != "Cancelled").join(
        p.select(F.col("id").alias("product_id"), "department", "category"), "product_id")
    from shopframe.functions.baskets import item_sets
    return item_sets(j, ["department", "order_id"], "category", min_size=2)


_register_rules("rules_per_department", ["order_items", "products"], _DEPT_ITEMS,
                lambda t: rules_out(r.rules_by_segment(_dept_sets(t), ["department"], 0.005, "lift", 1.0, 50, 8),
                                    ["department"], True),
                min_support=0.005, metric="lift", threshold=1.0, seg="department", min_baskets=50, top=8)

_TIER_ITEMS = f"""SELECT mt.majority_tier AS seg, CAST(oi.order_id AS VARCHAR) AS bid, p.category AS item
FROM order_items oi JOIN products p ON oi.product_id = p.id JOIN (
  SELECT order_id, price_tier AS majority_tier FROM (
    SELECT order_id, price_tier, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY COUNT(*) DESC, price_tier) AS rn
    FROM (SELECT oi3.order_id, CASE WHEN p3.retail_price < {TIER_LO} THEN 'Budget' WHEN p3.retail_price <= {TIER_HI}
                 THEN 'Mid-range' ELSE 'Premium' END AS price_tier
          FROM order_items oi3 JOIN products p3 ON oi3.product_id = p3.id WHERE oi3.{NC}) x
    GROUP BY order_id, price_tier) y WHERE rn = 1) mt ON oi.order_id = mt.order_id
WHERE oi.{NC} AND oi.order_id IN (SELECT oi2.order_id FROM order_items oi2 JOIN products p2 ON oi2.product_id = p2.id
  WHERE oi2.{NC} GROUP BY 1 HAVING COUNT(DISTINCT p2.category) >= 2)"""


def _tier_sets(t):
    oi, p = V(t, "order_items"), V(t, "products")
    rp = F.col("retail_price")
    tiers = p.select(F.col("id").alias("product_id"),
                     F.when(rp < TIER_LO, "Budget").when(rp <= TIER_HI, "Mid-range").otherwise("Premium")
                     .alias("price_tier"))
    mt = f.majority_tier(oi, tiers)
    j = oi.filter(F.col("status") != "Cancelled").join(mt, "order_id") \
        .join(p.select(F.col("id").alias("product_id"), "category"), "product_id")
    from shopframe.functions.baskets import item_sets
    return item_sets(j, ["majority_tier", "order_id"], "category", min_size=2)


_register_rules("rules_per_tier", ["order_items", "products"], _TIER_ITEMS,
                lambda t: rules_out(r.rules_by_segment(_tier_sets(t), ["majority_tier"], 0.015, "lift", 1.0, 50, 5),
                                    ["majority_tier"], True),
                min_support=0.015, metric="lift", threshold=1.0, seg="majority_tier", min_baskets=50, top=5)

_RET_ITEMS = """SELECT 'all' AS seg, CAST(oi.order_id AS VARCHAR) AS bid, p.category AS item
FROM order_items oi JOIN products p ON oi.product_id = p.id WHERE oi.status = 'Returned' AND oi.order_id IN (
  SELECT oi2.order_id FROM order_items oi2 JOIN products p2 ON oi2.product_id = p2.id WHERE oi2.status = 'Returned'
  GROUP BY 1 HAVING COUNT(DISTINCT p2.category) >= 2)"""
_register_rules("rules_returns", ["order_items", "products"], _RET_ITEMS,
                lambda t: rules_out(r.rules_by_segment(f.returned_baskets(V(t, "order_items"), V(t, "products")),
                                                       [], 0.005, "lift", 1.0)),
                min_support=0.005, metric="lift", threshold=1.0)

_PROD_ITEMS = """SELECT 'all' AS seg, CAST(order_id AS VARCHAR) AS bid, CAST(product_id AS VARCHAR) AS item
FROM fact_order WHERE order_id IN (SELECT order_id FROM fact_order GROUP BY 1 HAVING COUNT(DISTINCT product_id) >= 2)"""


def _prod_sets(t):
    from shopframe.functions.baskets import item_sets
    return item_sets(V(t, "fact_order"), "order_id", F.col("product_id").cast("string"), min_size=2)


_register_rules("rules_niche_products", ["fact_order"], _PROD_ITEMS,
                lambda t: rules_out(r.niche_product_rules(_prod_sets(t)), ranked=True),
                min_support=0.002, metric="confidence", threshold=0.1, top=5)

_ALL_CAT_ITEMS = f"""SELECT 'all' AS seg, CAST(oi.order_id AS VARCHAR) AS bid, p.category AS item
FROM order_items oi JOIN products p ON oi.product_id = p.id WHERE oi.{NC} AND oi.order_id IN (
  SELECT oi2.order_id FROM order_items oi2 JOIN products p2 ON oi2.product_id = p2.id WHERE oi2.{NC}
  GROUP BY 1 HAVING COUNT(DISTINCT p2.category) >= 2)"""


def _cat_sets(t):
    return f.order_category_baskets(V(t, "order_items"), V(t, "products"))


register("rules_lift_matrix", W(["order_items", "products"], f"""
SELECT a, b, {R('lift', 6)} AS lift FROM (
  SELECT p.a, p.b, CAST(p.n_ab AS DOUBLE) * nb.n / (CAST(sa.c AS DOUBLE) * sb.c) AS lift
  FROM (SELECT x.item AS a, y.item AS b, COUNT(*) AS n_ab FROM bi x JOIN bi y ON x.bid = y.bid AND x.item != y.item
        GROUP BY 1, 2) p
  JOIN (SELECT item, COUNT(*) AS c FROM bi GROUP BY 1) sa ON p.a = sa.item
  JOIN (SELECT item, COUNT(*) AS c FROM bi GROUP BY 1) sb ON p.b = sb.item
  CROSS JOIN (SELECT COUNT(DISTINCT bid) AS n FROM bi) nb
  UNION ALL SELECT item, item, 1.0 FROM (SELECT DISTINCT item FROM bi) d) z""",
    [("bi", f"SELECT DISTINCT bid, item FROM ({_ALL_CAT_ITEMS}) x")]))(
    lambda t: r.lift_matrix(_cat_sets(t)).select("a", "b", rnd("lift", 6).alias("lift")))

register("rules_item_support", W(["order_items", "products"], f"""
SELECT item, COUNT(*) AS n, {R('COUNT(*) / (SELECT COUNT(DISTINCT bid) FROM bi)', 6)} AS support FROM bi GROUP BY 1""",
    [("bi", f"SELECT DISTINCT bid, item FROM ({_ALL_CAT_ITEMS}) x")]))(
    lambda t: r.item_support(_cat_sets(t)).select("item", "n", rnd("support", 6).alias("support")))

register("rules_matrix_density", W(["order_items", "products"], f"""
SELECT COUNT(DISTINCT bid) AS n_baskets, COUNT(*) AS n_filled, COUNT(DISTINCT item) AS n_items,
       {R('COUNT(*) / (COUNT(DISTINCT bid) * COUNT(DISTINCT item))', 6)} AS density FROM bi""",
    [("bi", f"SELECT DISTINCT bid, item FROM ({_ALL_CAT_ITEMS}) x")]))(
    lambda t: r.matrix_density(_cat_sets(t)).select("n_baskets", "n_filled", "n_items",
                                                    rnd(F.col("density"), 6).alias("density")))

_RECENT = """SELECT t.customer_id, a.product_group_name AS item
FROM transactions t JOIN articles a ON t.article_id = a.article_id
JOIN (SELECT customer_id, MAX(t_dat) AS last FROM transactions GROUP BY 1) l ON t.customer_id = l.customer_id
WHERE t.t_dat >= l.last - 30"""
register("rules_recent_basket", W(["transactions", "articles"], f"""
SELECT customer_id, array_to_string(list_sort(list(DISTINCT item)), '|') AS items_key FROM ({_RECENT}) x GROUP BY 1"""))(
    lambda t: r.recent_basket(V(t, "transactions"), V(t, "articles"))
    .select("customer_id", F.array_join("items", "|").alias("items_key")))

_rc, _rf = rules_sql(_DAY_ITEMS, 0.01, "confidence", 0.2, seg="cluster_id", min_baskets=50, extra="AND lift > 1.0", top=50)
_RULES_RAW = _rf.replace("array_to_string(ant, '|') AS antecedent_key", "ant AS antecedent_arr, array_to_string(ant, '|') AS antecedent_key") \
    .replace("array_to_string(con, '|') AS consequent_key", "con AS consequent_arr, array_to_string(con, '|') AS consequent_key") \
    .replace(f"{R('lift', 6)} AS lift", "lift AS raw_lift, " + R('lift', 6) + " AS lift")
register("rules_recommend_all", W(FASH, f"""
SELECT customer_id, cluster_id, CAST(rank2 AS INTEGER) AS rank, recommend, from_key AS from_items, support, confidence, lift FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY {R('raw_lift', 9)} DESC, from_key, recommend) AS rank2
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id, recommend ORDER BY {R('raw_lift', 9)} DESC, from_key) AS r1
        FROM (SELECT rb.customer_id, ru.cluster_id, unnest(ru.consequent_arr) AS recommend, ru.antecedent_key AS from_key,
                     ru.support, ru.confidence, ru.lift, ru.raw_lift, rb.items
              FROM rb JOIN clusters cl ON rb.customer_id = cl.customer_id
              JOIN rules ru ON ru.cluster_id = cl.cluster_id
              WHERE list_has_all(rb.items, ru.antecedent_arr)) e
        WHERE NOT list_contains(items, recommend)) f WHERE r1 = 1) g WHERE rank2 <= 5""",
    [CLUSTERS_CTE] + _rc + [("rules", _RULES_RAW),
                            ("rb", f"SELECT customer_id, list(DISTINCT item) AS items FROM ({_RECENT}) x GROUP BY 1")]))(
    lambda t: r.recommend_all(V(t, "transactions"), V(t, "articles"), clusters(t),
                              r.mine_app(_day_sets(t), ["cluster_id"]))
    .select("customer_id", "cluster_id", "rank", "recommend", F.array_join("from_items", "|").alias("from_items"),
            rnd("support", 6).alias("support"), rnd("confidence", 6).alias("confidence"), rnd("lift", 6).alias("lift")))


# ---------------------------------------------------------------- A11 (rows only: segments come from k-means)

@register("rules_profit")
def _a11(t):
    from shopframe.operators import clustering as cl
    oi, p = V(t, "order_items"), V(t, "products")
    m = f.product_margin(p).join(f.product_sales(p, oi).withColumnRenamed("num_sold", "sales_volume"), "product_id") \
        .filter(F.col("sales_volume") > 0)
    seg = cl.portfolio_segment(cl.segments(m, ["margin_amount", "sales_volume"], 4, 42))
    sets = f.category_segment_labels(oi, p, seg.select("product_id", "segment"))
    return rules_out(r.profit_rules(sets), ranked=True)
