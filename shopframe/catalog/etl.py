"""Registered ETL queries (E1-E22) with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopframe.catalog.base import register
from shopframe.functions.exprs import draw_sql, padded_sql, rnd, rnd_sql as R
from shopframe.operators import etl as e
from shopframe.plans.oracle import with_views as W
from shopframe.session import materialize

SRC_ORDERS = ("src_orders", """SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_unique_id, n.n_name AS city,
  r.r_name AS state, o.o_orderdate AS ts
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
SRC_ITEMS = ("src_items", "SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice / l_quantity AS price "
                          "FROM lineitem")
SRC_PRODUCTS = ("src_products", """SELECT p_partkey AS product_id, lower(p_type) AS category_name,
  CAST(p_size * 100.0 AS DOUBLE) AS weight_g, p_size AS length_cm, p_size % 7 + 1 AS height_cm,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size % 5 + 10 END AS width_cm FROM part""")
SRC_TRANSLATION = ("src_translation", """SELECT DISTINCT lower(p_type) AS category_name,
  upper(substr(lower(p_type), 1, 1)) || substr(lower(p_type), 2) AS category_name_english
  FROM part WHERE lower(p_type) != 'standard'""")
TOP30 = ("top30", """SELECT city, state, COUNT(*) AS n_orders FROM src_orders GROUP BY 1, 2
  ORDER BY n_orders DESC, city, state LIMIT 30""")
TOP10 = ("top10", """SELECT city, state FROM src_orders GROUP BY 1, 2 ORDER BY COUNT(*) DESC, city, state LIMIT 10""")


def S(*ctes):
    return list(ctes)


def _orders(t):
    return e.source_orders(t)


register("etl_orders_with_customer", W([], "SELECT * FROM src_orders", S(SRC_ORDERS)))(
    lambda t: e.orders_with_customer(_orders(t)))

register("etl_top_cities", W([], "SELECT * FROM top30", S(SRC_ORDERS, TOP30)))(lambda t: e.top_cities(_orders(t), 30))

register("etl_restrict_to_cities", W([], """
SELECT o.* FROM src_orders o WHERE (o.city, o.state) IN (SELECT city, state FROM top10)""", S(SRC_ORDERS, TOP10)))(
    lambda t: e.restrict_to_cities(_orders(t), e.top_cities(_orders(t), 10)))

register("etl_items_of_orders", W([], """
SELECT i.* FROM src_items i WHERE i.order_id IN (SELECT order_id FROM src_orders o
  WHERE (o.city, o.state) IN (SELECT city, state FROM top10))""", S(SRC_ORDERS, SRC_ITEMS, TOP10)))(
    lambda t: e.items_of_orders(e.source_items(t), e.restrict_to_cities(_orders(t), e.top_cities(_orders(t), 10))))

register("etl_ghost_orders", W([], """
SELECT (SELECT COUNT(*) FROM src_orders WHERE order_id IN (SELECT order_id FROM src_items)) AS n_kept,
       (SELECT COUNT(*) FROM src_orders WHERE order_id NOT IN (SELECT order_id FROM src_items)) AS n_dropped""",
    S(SRC_ORDERS, SRC_ITEMS)))(
    lambda t: (lambda kd: kd[0].agg(F.count(F.lit(1)).alias("n_kept")).crossJoin(kd[1]))(
        e.drop_ghost_orders(_orders(t), e.source_items(t))))

register("etl_first_record_per_customer", W([], """
SELECT customer_unique_id, ts, order_id, city, state FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id ORDER BY ts, order_id) AS rn FROM src_orders) x
WHERE rn = 1""", S(SRC_ORDERS)))(lambda t: e.first_record_per_customer(_orders(t)))

_ALLOC = ("alloc", """SELECT city, state, n_orders, n_stores FROM (
  SELECT *, 1 + base + CASE WHEN r <= lft THEN 1 ELSE 0 END AS n_stores FROM (
    SELECT *, ROW_NUMBER() OVER (ORDER BY frac DESC, n_orders DESC, city, state) AS r,
           (SELECT MAX(extra) - SUM(base) FROM q) AS lft FROM q) y) z""")
_Q = ("q", """SELECT city, state, n_orders, extra, FLOOR(quota) AS base, quota - FLOOR(quota) AS frac FROM (
  SELECT city, state, n_orders, extra, extra * n_orders / tot AS quota FROM (
    SELECT top30.*, (SELECT SUM(n_orders) FROM top30) AS tot,
           GREATEST(100 - (SELECT COUNT(*) FROM top30), 0) AS extra FROM top30) a) b""")
register("etl_allocate_stores", W([], """
SELECT city, state, n_orders, CAST(n_stores AS BIGINT) AS n_stores, CAST(s.store_no AS INTEGER) AS store_no
FROM alloc, LATERAL (SELECT unnest(range(1, CAST(n_stores AS BIGINT) + 1)) AS store_no) s""",
    S(SRC_ORDERS, TOP30, _Q, _ALLOC)))(
    lambda t: e.allocate_stores(e.top_cities(_orders(t), 30), 100).withColumn("n_stores", F.col("n_stores").cast("long")))

_OF = ("of", """SELECT o.*, f.max_weight, f.avg_price FROM src_orders o LEFT JOIN (
  SELECT i.order_id, MAX(p.weight_g) AS max_weight, AVG(i.price) AS avg_price FROM src_items i
  LEFT JOIN src_products p ON i.product_id = p.product_id GROUP BY i.order_id) f ON o.order_id = f.order_id""")
register("etl_order_features", W([], f"""
SELECT order_id, customer_unique_id, city, state, ts, max_weight, {R('avg_price', 6)} AS avg_price FROM of""",
    S(SRC_ORDERS, SRC_ITEMS, SRC_PRODUCTS, _OF)))(
    lambda t: e.order_features(_orders(t), e.source_items(t), e.source_products(t)).withColumn(
        "avg_price", rnd("avg_price", 6)))


def _d(salt):
    return draw_sql("order_id", salt)


register("etl_shift_order_dates", W([], f"""
SELECT order_id, ts, CASE WHEN max_weight IS NULL THEN ts WHEN move2 THEN
         make_timestamp(year(t1), CASE WHEN {_d(24)} < 0.5 THEN 11 ELSE 12 END,
                        CAST(FLOOR({_d(25)} * 28) + 1 AS INTEGER), hour(t1), minute(t1), second(t1))
       ELSE t1 END AS shifted_ts
FROM (SELECT *, CASE WHEN max_weight < 1000 AND wd < 5 AND {_d(21)} < 0.60
                     THEN ts + to_days(CAST((CASE WHEN {_d(22)} < 0.5 THEN 5 ELSE 6 END) - wd AS INTEGER)) ELSE ts END AS t1,
             (max_weight < 1000 AND avg_price >= 100 AND {_d(23)} < 0.50) AS move2
      FROM (SELECT *, isodow(ts) - 1 AS wd FROM of) a) b""", S(SRC_ORDERS, SRC_ITEMS, SRC_PRODUCTS, _OF)))(
    lambda t: e.shift_order_dates(e.order_features(_orders(t), e.source_items(t), e.source_products(t)))
    .select("order_id", "ts", "shifted_ts"))

register("etl_city_keys", W([], """
SELECT city, state, CAST(ROW_NUMBER() OVER (ORDER BY city, state) AS BIGINT) AS city_sk
FROM (SELECT DISTINCT city, state FROM src_orders) x""", S(SRC_ORDERS)))(
    lambda t: e.surrogate_keys(_orders(t), ["city", "state"], "city_sk"))

register("etl_product_keys", W([], """
SELECT product_id, CAST(ROW_NUMBER() OVER (ORDER BY product_id) AS BIGINT) AS product_sk
FROM (SELECT DISTINCT product_id FROM src_items) x""", S(SRC_ITEMS)))(
    lambda t: e.surrogate_keys(e.source_items(t), "product_id", "product_sk"))

register("etl_median_price", W([], f"""
SELECT product_id, {R('quantile_cont(price, 0.5)', 6)} AS median_price FROM src_items GROUP BY 1""", S(SRC_ITEMS)))(
    lambda t: e.median_price(e.source_items(t)).withColumn(
        "median_price", rnd("median_price", 6)))

register("etl_dim_product", W([], f"""
SELECT p.product_id,
       COALESCE(tr.category_name_english, p.category_name, 'unknown') || ' #' ||
         {padded_sql("ROW_NUMBER() OVER (PARTITION BY COALESCE(tr.category_name_english, p.category_name, 'unknown') ORDER BY p.product_id)", 4)} AS description,
       CAST(COALESCE(CAST(p.length_cm AS INTEGER), 0) AS VARCHAR) || 'x' || CAST(COALESCE(CAST(p.height_cm AS INTEGER), 0)
         AS VARCHAR) || 'x' || CAST(COALESCE(CAST(p.width_cm AS INTEGER), 0) AS VARCHAR) || ' cm' AS size,
       COALESCE(CAST(p.weight_g AS INTEGER), 0) AS weight_g, COALESCE({R('m.mp', 2)}, 0.0) AS price
FROM src_products p LEFT JOIN src_translation tr ON p.category_name = tr.category_name
LEFT JOIN (SELECT product_id, quantile_cont(price, 0.5) AS mp FROM src_items GROUP BY 1) m ON p.product_id = m.product_id""",
    S(SRC_PRODUCTS, SRC_TRANSLATION, SRC_ITEMS)))(
    lambda t: e.dim_product_etl(e.source_products(t), e.source_translation(t), e.source_items(t)))

register("etl_first_order_date", W([], """
SELECT customer_unique_id, MIN(ts) AS first_order_ts FROM src_orders GROUP BY 1""", S(SRC_ORDERS)))(
    lambda t: e.first_order_date(_orders(t)))


def _city_keys(t):
    return e.surrogate_keys(e.restrict_to_cities(_orders(t), e.top_cities(_orders(t), 10)), ["city", "state"], "city_sk")


_CK10 = ("ck10", """SELECT city, state, CAST(ROW_NUMBER() OVER (ORDER BY city, state) AS BIGINT) AS city_sk FROM top10""")
_FIRST = ("firstrec", """SELECT customer_unique_id, city, state FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id ORDER BY ts, order_id) AS rn FROM src_orders) x
  WHERE rn = 1""")
register("etl_dim_customer_base", W([], """
SELECT f.customer_unique_id, k.city_sk, m.first_order_ts FROM firstrec f
JOIN (SELECT customer_unique_id, MIN(ts) AS first_order_ts FROM src_orders GROUP BY 1) m
  ON f.customer_unique_id = m.customer_unique_id
JOIN ck10 k ON f.city = k.city AND f.state = k.state""", S(SRC_ORDERS, TOP10, _CK10, _FIRST)))(
    lambda t: e.dim_customer_base(e.first_record_per_customer(_orders(t)), _orders(t), _city_keys(t))[0])

register("etl_customers_lost", W([], """
SELECT COUNT(*) AS n_lost FROM firstrec f WHERE (f.city, f.state) NOT IN (SELECT city, state FROM ck10)""",
    S(SRC_ORDERS, TOP10, _CK10, _FIRST)))(
    lambda t: e.dim_customer_base(e.first_record_per_customer(_orders(t)), _orders(t), _city_keys(t))[1])


def _subtype_tables(t):
    base, _ = e.dim_customer_base(e.first_record_per_customer(_orders(t)), _orders(t), _city_keys(t))
    return e.subtype_tables(base, t.view("customer_subtypes"))


_BASE = ("cbase", """SELECT f.customer_unique_id, k.city_sk, m.first_order_ts FROM firstrec f
  JOIN (SELECT customer_unique_id, MIN(ts) AS first_order_ts FROM src_orders GROUP BY 1) m
    ON f.customer_unique_id = m.customer_unique_id JOIN ck10 k ON f.city = k.city AND f.state = k.state""")
register("etl_tourist_table", W(["customer_subtypes"], """
SELECT b.customer_unique_id, 'Guide ' || lpad(CAST(b.customer_unique_id % 20 + 1 AS VARCHAR), 2, '0') AS guide,
       b.first_order_ts AS since
FROM cbase b JOIN customer_subtypes s ON b.customer_unique_id = s.customer_id WHERE s.is_tourist""",
    S(SRC_ORDERS, TOP10, _CK10, _FIRST, _BASE)))(lambda t: _subtype_tables(t)[0])
register("etl_postal_table", W(["customer_subtypes"], """
SELECT b.customer_unique_id, 'PO Box ' || CAST(1000 + b.customer_unique_id % 9000 AS VARCHAR) AS postal_address
FROM cbase b JOIN customer_subtypes s ON b.customer_unique_id = s.customer_id WHERE s.is_postal""",
    S(SRC_ORDERS, TOP10, _CK10, _FIRST, _BASE)))(lambda t: _subtype_tables(t)[1])


def _stores(t):
    a = materialize(e.allocate_stores(e.top_cities(_orders(t), 30), 100))
    return materialize(e.surrogate_keys(a, ["city", "state", "store_no"], "store_sk"))


def _inventory(t):
    prods = materialize(e.surrogate_keys(e.source_items(t), "product_id", "product_sk"))
    return e.store_inventory(_stores(t).select("store_sk"), prods)


_STORES = ("stores", """SELECT CAST(ROW_NUMBER() OVER (ORDER BY city, state, store_no) AS BIGINT) AS store_sk FROM (
  SELECT city, state, s.store_no FROM alloc, LATERAL (SELECT unnest(range(1, CAST(n_stores AS BIGINT) + 1)) AS store_no) s) x""")
_PRODS = ("prods", """SELECT product_id, CAST(ROW_NUMBER() OVER (ORDER BY product_id) AS BIGINT) AS product_sk
  FROM (SELECT DISTINCT product_id FROM src_items) x""")
_INV = ("inv", f"""
WITH pc AS (SELECT COUNT(*) AS P FROM prods),
sk AS (SELECT store_sk, LEAST(pc.P, CAST(400 + FLOOR({draw_sql('store_sk', 31)} * 201) AS BIGINT)) AS k,
              CAST(FLOOR({draw_sql('store_sk', 32)} * pc.P) AS BIGINT) AS off, pc.P FROM stores, pc),
gen AS (SELECT sk.store_sk, ((1000003 * g.i + sk.off) % sk.P) + 1 AS product_sk FROM sk,
        LATERAL (SELECT unnest(range(0, sk.k)) AS i) g),
stocked AS (SELECT g.store_sk, p.product_id FROM gen g JOIN prods p ON g.product_sk = p.product_sk),
missing AS (SELECT (p.product_sk % (SELECT COUNT(*) FROM stores)) + 1 AS store_sk, p.product_id FROM prods p
            WHERE p.product_id NOT IN (SELECT product_id FROM stocked))
SELECT store_sk, product_id, CAST(10 + FLOOR({draw_sql("(store_sk || ':' || product_id)", 33)} * 191) AS INTEGER)
       AS stock_qty FROM (SELECT * FROM stocked UNION ALL SELECT * FROM missing) u""")
register("etl_store_inventory", W([], "SELECT * FROM inv", S(SRC_ORDERS, SRC_ITEMS, TOP30, _Q, _ALLOC, _STORES, _PRODS, _INV)))(
    _inventory)

register("etl_fact_orders_report", W([], """
SELECT (SELECT COUNT(*) FROM src_orders WHERE customer_unique_id NOT IN (SELECT customer_unique_id FROM cbase)) AS n_dropped,
       (SELECT COUNT(*) FROM src_orders) AS n_orders,
       (SELECT COUNT(*) FROM src_orders WHERE customer_unique_id NOT IN (SELECT customer_unique_id FROM cbase))
         > 0.01 * (SELECT COUNT(*) FROM src_orders) AS alert""", S(SRC_ORDERS, TOP10, _CK10, _FIRST, _BASE)))(
    lambda t: e.fact_orders_base(_orders(t), e.dim_customer_base(e.first_record_per_customer(_orders(t)), _orders(t),
                                                                 _city_keys(t))[0])[1])

register("etl_order_lines", W([], f"""
SELECT i.order_id, i.product_id, COUNT(*) AS quantity, {R('AVG(i.price)', 2)} AS price, o.ts
FROM src_items i JOIN src_orders o ON i.order_id = o.order_id GROUP BY i.order_id, i.product_id, o.ts""",
    S(SRC_ORDERS, SRC_ITEMS)))(lambda t: e.order_lines(e.source_items(t), _orders(t)))

register("etl_fk_report", W(["fact_order", "dim_customer", "dim_product", "dim_location"], """
SELECT 'order_customer' AS edge, COUNT(*) AS n_orphans FROM (SELECT DISTINCT customer_id FROM fact_order) c
  WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM dim_customer)
UNION ALL SELECT 'order_product', COUNT(*) FROM (SELECT DISTINCT product_id FROM fact_order) c
  WHERE product_id IS NULL OR product_id NOT IN (SELECT product_id FROM dim_product)
UNION ALL SELECT 'order_store', COUNT(*) FROM (SELECT DISTINCT store_id FROM fact_order) c
  WHERE store_id IS NULL OR store_id NOT IN (SELECT store_id FROM dim_location)
UNION ALL SELECT 'item_order', COUNT(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem) c
  WHERE l_orderkey IS NULL OR l_orderkey NOT IN (SELECT o_orderkey FROM orders)"""))(
    lambda t: e.fk_report([
        ("order_customer", t.view("fact_order"), "customer_id", t.view("dim_customer"), "customer_id"),
        ("order_product", t.view("fact_order"), "product_id", t.view("dim_product"), "product_id"),
        ("order_store", t.view("fact_order"), "store_id", t.view("dim_location"), "store_id"),
        ("item_order", t["lineitem"], "l_orderkey", t["orders"], "o_orderkey")]))

register("etl_business_constraints", W([], """
SELECT 'BC1_order_has_line' AS rule, COUNT(*) AS n, COUNT(*) = 0 AS ok FROM src_orders
  WHERE order_id NOT IN (SELECT order_id FROM src_items)
UNION ALL SELECT 'BC2_ordered_product_stocked', COUNT(*), COUNT(*) = 0 FROM (SELECT DISTINCT product_id FROM src_items) x
  WHERE product_id NOT IN (SELECT product_id FROM inv)""",
    S(SRC_ORDERS, SRC_ITEMS, TOP30, _Q, _ALLOC, _STORES, _PRODS, _INV)))(
    lambda t: e.business_constraints(_orders(t), e.source_items(t), _inventory(t)))

register("etl_row_count_summary", W([], """
SELECT COALESCE(table_name, 'TOTAL') AS table_name, CAST(SUM(n_rows) AS BIGINT) AS n_rows FROM (
  SELECT 'orders' AS table_name, COUNT(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
  UNION ALL SELECT 'customer', COUNT(*) FROM customer UNION ALL SELECT 'part', COUNT(*) FROM part) x
GROUP BY ROLLUP (table_name)"""))(
    lambda t: e.row_count_summary({"orders": t["orders"], "lineitem": t["lineitem"], "customer": t["customer"],
                                   "part": t["part"]}).withColumn("n_rows", F.col("n_rows").cast("long")))
