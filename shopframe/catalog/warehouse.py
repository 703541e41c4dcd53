"""Registered queries: star schema (E23), OLAP (O1-O13), quality and log (Q1-Q15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopframe.catalog.base import register
from shopframe.operators import olap, quality as q
from shopframe.functions.exprs import exact_sum, rnd, rnd_sql
from shopframe.plans.oracle import with_views as W


def _star(t):
    return (t.view("fact_order"), t.view("fact_inventory"), t.view("dim_customer"),
            t.view("dim_product"), t.view("dim_location"), t.view("dim_time"))


# ---------------------------------------------------------------- E23 star schema tables

for _name in ("dim_time", "dim_location", "dim_product", "dim_customer", "fact_inventory", "fact_order"):
    register(f"star_{_name}", W([_name], f"SELECT * FROM {_name}"))(
        (lambda n: lambda t: t.view(n))(_name))

register("star_customer_subtypes", W(["customer_subtypes"], "SELECT * FROM customer_subtypes"))(
    lambda t: t.view("customer_subtypes"))


# ---------------------------------------------------------------- O1-O13

@register("olap_stock_listing", W(["fact_inventory", "dim_location", "dim_product"], """
SELECT l.store_id, l.store_name, l.city_name, l.state, l.phone, p.product_id, p.description, p.size,
       p.weight_g, p.price AS unit_price, fi.stock_qty
FROM fact_inventory fi JOIN dim_location l ON fi.store_id = l.store_id
JOIN dim_product p ON fi.product_id = p.product_id"""))
def _o1(t):
    fo, fi, c, p, loc, tm = _star(t)
    return olap.stock_listing(fi, loc, p)


@register("olap_order_totals", W(["fact_order", "dim_customer", "dim_time"], f"""
SELECT fo.order_id, c.customer_name,
       CAST(tm.day AS VARCHAR) || '/' || CAST(tm.month AS VARCHAR) || '/' || CAST(tm.year AS VARCHAR) AS order_date,
       tm.weekday, fo.channel, {rnd_sql('SUM(fo.amount)', 2)} AS order_total
FROM fact_order fo JOIN dim_customer c ON fo.customer_id = c.customer_id
JOIN dim_time tm ON fo.time_id = tm.time_id
GROUP BY fo.order_id, c.customer_name, tm.day, tm.month, tm.year, tm.weekday, fo.channel"""))
def _o2(t):
    fo, fi, c, p, loc, tm = _star(t)
    return olap.order_totals(fo, c, tm)


@register("olap_stores_of_customer", W(["fact_order", "dim_location"], """
SELECT DISTINCT l.store_id, l.store_name, l.city_name, l.phone
FROM fact_order fo JOIN dim_location l ON fo.store_id = l.store_id
WHERE fo.customer_id = (SELECT MIN(customer_id) FROM fact_order)"""))
def _o3(t):
    fo, fi, c, p, loc, tm = _star(t)
    return olap.stores_of_customer(fo, loc)


# stock per (store, product) is a sum of order quantities (1-50 per line), so
# the reference default of 100 selects nothing at sf0.01; 30 is registered.
@register("olap_stores_with_stock", W(["fact_inventory", "dim_location"], """
SELECT DISTINCT l.store_id, l.store_name, l.office_address, l.city_name, l.state, fi.stock_qty
FROM fact_inventory fi JOIN dim_location l ON fi.store_id = l.store_id
WHERE fi.stock_qty > 30
  AND fi.product_id = (SELECT MIN(product_id) FROM fact_inventory WHERE stock_qty > 30)"""))
def _o4(t):
    fo, fi, c, p, loc, tm = _star(t)
    return olap.stores_with_stock(fi, loc, min_qty=30)


@register("olap_order_detail", W(["fact_order", "dim_customer", "dim_product", "dim_location"], """
SELECT fo.order_id, c.customer_name, p.product_id, p.description, fo.store_id, l.store_name, l.city_name,
       fo.qty, fo.unit_price, fo.amount
FROM fact_order fo JOIN dim_customer c ON fo.customer_id = c.customer_id
JOIN dim_product p ON fo.product_id = p.product_id JOIN dim_location l ON fo.store_id = l.store_id"""))
def _o5(t):
    fo, fi, c, p, loc, tm = _star(t)
    return olap.order_detail(fo, c, p, loc)


@register("olap_customer_address", W(["dim_customer"], """
SELECT customer_id, customer_name, city_id, city_name, state FROM dim_customer
WHERE customer_id = (SELECT MIN(customer_id) FROM dim_customer)"""))
def _o6(t):
    return olap.customer_address(t.view("dim_customer"))


@register("olap_stock_in_city", W(["fact_inventory", "dim_location", "dim_product"], """
SELECT l.store_id, l.store_name, l.store_type, p.product_id, p.description, fi.stock_qty
FROM fact_inventory fi JOIN dim_location l ON fi.store_id = l.store_id
JOIN dim_product p ON fi.product_id = p.product_id
JOIN (SELECT fi2.product_id AS pid, l2.city_id AS cid
      FROM fact_inventory fi2 JOIN dim_location l2 ON fi2.store_id = l2.store_id
      ORDER BY fi2.product_id, l2.city_id LIMIT 1) d ON fi.product_id = d.pid AND l.city_id = d.cid"""))
def _o7(t):
    fo, fi, c, p, loc, tm = _star(t)
    return olap.stock_in_city(fi, loc, p)


@register("olap_one_order", W(["fact_order", "dim_customer", "dim_product", "dim_location"], """
SELECT fo.order_id, p.product_id, p.description, fo.qty, fo.unit_price, fo.amount,
       c.customer_id, c.customer_name, l.store_id, l.store_name, l.city_name
FROM fact_order fo JOIN dim_product p ON fo.product_id = p.product_id
JOIN dim_customer c ON fo.customer_id = c.customer_id JOIN dim_location l ON fo.store_id = l.store_id
WHERE fo.order_id = (SELECT MIN(order_id) FROM fact_order)"""))
def _o8(t):
    fo, fi, c, p, loc, tm = _star(t)
    return olap.one_order(fo, c, p, loc)


@register("olap_tourists", W(["dim_customer"],
          "SELECT customer_id, customer_name, guide FROM dim_customer WHERE customer_type = 'tourist'"))
def _o9a(t):
    return olap.customers_of_type(t.view("dim_customer"), "tourist")


@register("olap_postal", W(["dim_customer"],
          "SELECT customer_id, customer_name, postal_address FROM dim_customer WHERE customer_type = 'postal'"))
def _o9b(t):
    return olap.customers_of_type(t.view("dim_customer"), "postal")


@register("olap_both_types", W(["dim_customer"], """
SELECT customer_id, customer_name, guide, postal_address FROM dim_customer WHERE customer_type = 'both'"""))
def _o9c(t):
    return olap.customers_of_type(t.view("dim_customer"), "both")


@register("olap_customer_type_counts", W(["dim_customer"], """
SELECT customer_type, COUNT(*) AS n_customers FROM dim_customer
WHERE customer_type IS NOT NULL GROUP BY customer_type"""))
def _o9d(t):
    return olap.customer_type_counts(t.view("dim_customer"))


@register("olap_listing_first_100", W(["fact_inventory", "dim_location", "dim_product"], """
SELECT l.store_id, l.store_name, l.city_name, l.state, l.phone, p.product_id, p.description, p.size,
       p.weight_g, p.price AS unit_price, fi.stock_qty
FROM fact_inventory fi JOIN dim_location l ON fi.store_id = l.store_id
JOIN dim_product p ON fi.product_id = p.product_id
ORDER BY l.store_id, p.product_id LIMIT 100"""))
def _o11(t):
    fo, fi, c, p, loc, tm = _star(t)
    return olap.limited(olap.stock_listing(fi, loc, p, order=False), 100, "store_id", "product_id")


@register("olap_slice_city", W(["fact_order", "dim_customer", "dim_product", "dim_location"], """
SELECT fo.order_id, c.customer_name, p.product_id, p.description, fo.store_id, l.store_name, l.city_name,
       fo.qty, fo.unit_price, fo.amount
FROM fact_order fo JOIN dim_customer c ON fo.customer_id = c.customer_id
JOIN dim_product p ON fo.product_id = p.product_id JOIN dim_location l ON fo.store_id = l.store_id
WHERE contains(lower(COALESCE(CAST(l.city_name AS VARCHAR), '')), 'nation_1')"""))
def _o12(t):
    fo, fi, c, p, loc, tm = _star(t)
    return olap.slice_contains(olap.order_detail(fo, c, p, loc, order=False), "city_name", "NATION_1")


@register("olap_summary_by_city", W(["fact_order", "dim_customer", "dim_product", "dim_location"], """
SELECT COALESCE(CAST(l.city_name AS VARCHAR), '(null)') AS "group", COUNT(*) AS row_count,
       CAST(FLOOR(COALESCE(SUM(TRY_CAST(CAST(fo.amount AS VARCHAR) AS DOUBLE)), 0.0) * 100.0 + 0.5) / 100.0 AS DOUBLE)
         AS sum_value
FROM fact_order fo JOIN dim_customer c ON fo.customer_id = c.customer_id
JOIN dim_product p ON fo.product_id = p.product_id JOIN dim_location l ON fo.store_id = l.store_id
GROUP BY 1"""))
def _o13(t):
    fo, fi, c, p, loc, tm = _star(t)
    return olap.summarise(olap.order_detail(fo, c, p, loc, order=False), "city_name", "amount", digits=2)


# ---------------------------------------------------------------- Q1-Q11 reconciliation

def _checks(t):
    """Q1-Q9: each table is aggregated once into a one-row frame; the checks are unpivoted from them."""
    fo, fi, c, p, loc, tm = _star(t)
    src_c, src_p, src_o, src_l = t["customer"], t["part"], t["orders"], t["lineitem"]
    st = t.view("customer_subtypes")
    cnt = F.count(F.lit(1))
    key_null = (F.col("order_id").isNull() | F.col("customer_id").isNull() | F.col("product_id").isNull()
                | F.col("store_id").isNull() | F.col("time_id").isNull())
    neg = (F.col("qty") < 0) | (F.col("unit_price") < 0) | (F.col("amount") < 0)
    # orphans in the same pass: left joins to the (unique) dimension keys, misses counted
    fx = fo
    for d, k in ((c, "customer_id"), (p, "product_id"), (loc, "store_id")):
        fx = fx.join(d.select(k, F.lit(1).alias(f"_has_{k}")), k, "left")
    fo_row = fx.agg(cnt.alias("fo_n"), F.count_distinct("order_id").alias("fo_orders"),
                    rnd(exact_sum("amount"), 2).alias("fo_amount"), F.count_if(neg).alias("fo_negative"),
                    F.count_if(key_null).alias("fo_nulls"),
                    *[F.count_if(F.col(f"_has_{k}").isNull()).alias(f"orph_{k}")
                      for k in ("customer_id", "product_id", "store_id")])
    phys = loc.filter(F.col("store_type") == "physical").select("store_id")
    dw = fo_row \
        .crossJoin(c.agg(cnt.alias("c_n"), F.count("guide").alias("c_guide"), F.count("postal_address").alias("c_addr"),
                         F.count_distinct("customer_id").alias("c_keys"))) \
        .crossJoin(p.agg(cnt.alias("p_n"), F.count_distinct("product_id").alias("p_keys"))) \
        .crossJoin(fi.join(phys, "store_id", "left_semi").agg(F.sum("stock_qty").alias("fi_phys"))) \
        .withColumn("zero", F.lit(0.0))
    li_row = src_l.agg(cnt.alias("l_n"),
                       rnd(exact_sum(F.col("l_quantity") * (F.col("l_extendedprice") / F.col("l_quantity"))), 2)
                       .alias("l_amount"),
                       F.sum(F.when(F.col("l_suppkey") % 2 == 0, F.col("l_quantity"))).alias("l_phys"))
    src = src_c.agg(cnt.alias("sc_n")).crossJoin(src_p.agg(cnt.alias("sp_n"))).crossJoin(li_row) \
        .crossJoin(st.agg(F.count_if("is_tourist").alias("st_t"), F.count_if("is_postal").alias("st_p"))) \
        .crossJoin(src_o.join(src_l.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
                   .agg(cnt.alias("so_n"))) \
        .withColumn("zero_src", F.lit(0.0))
    return q.reconcile_many(dw, src, [
        ("customer_count", "c_n", "sc_n", "dim_customer vs customer"),
        ("tourist_customers", "c_guide", "st_t", "guide not null vs tourist subtype"),
        ("postal_customers", "c_addr", "st_p", "address not null vs postal subtype"),
        ("product_count", "p_n", "sp_n", "dim_product vs part"),
        ("order_line_count", "fo_n", "l_n", "fact_order vs lineitem"),
        ("distinct_customer_key", "c_keys", "sc_n", "distinct keys vs rows"),
        ("distinct_product_key", "p_keys", "sp_n", "distinct keys vs rows"),
        ("distinct_order_key", "fo_orders", "so_n", "orders with lines"),
        ("physical_stock_qty", "fi_phys", "l_phys", "stock of physical stores"),
        ("order_amount", "fo_amount", "l_amount", "rounded revenue"),
        ("orphan_order_customer", "orph_customer_id", "zero_src", "expect 0"),
        ("orphan_order_product", "orph_product_id", "zero_src", "expect 0"),
        ("orphan_order_store", "orph_store_id", "zero_src", "expect 0"),
        ("negative_values", "fo_negative", "zero_src", "expect 0"),
        ("critical_nulls", "fo_nulls", "zero_src", "expect 0"),
    ])


_CHECKS_SQL = """
SELECT 'customer_count' AS name, (SELECT CAST(COUNT(*) AS DOUBLE) FROM dim_customer) AS dw_value,
       (SELECT CAST(COUNT(*) AS DOUBLE) FROM customer) AS source_value, 'dim_customer vs customer' AS note
UNION ALL SELECT 'tourist_customers', (SELECT CAST(COUNT(guide) AS DOUBLE) FROM dim_customer),
       (SELECT CAST(COUNT(*) AS DOUBLE) FROM customer_subtypes WHERE is_tourist), 'guide not null vs tourist subtype'
UNION ALL SELECT 'postal_customers', (SELECT CAST(COUNT(postal_address) AS DOUBLE) FROM dim_customer),
       (SELECT CAST(COUNT(*) AS DOUBLE) FROM customer_subtypes WHERE is_postal), 'address not null vs postal subtype'
UNION ALL SELECT 'product_count', (SELECT CAST(COUNT(*) AS DOUBLE) FROM dim_product),
       (SELECT CAST(COUNT(*) AS DOUBLE) FROM part), 'dim_product vs part'
UNION ALL SELECT 'order_line_count', (SELECT CAST(COUNT(*) AS DOUBLE) FROM fact_order),
       (SELECT CAST(COUNT(*) AS DOUBLE) FROM lineitem), 'fact_order vs lineitem'
UNION ALL SELECT 'distinct_customer_key', (SELECT CAST(COUNT(DISTINCT customer_id) AS DOUBLE) FROM dim_customer),
       (SELECT CAST(COUNT(*) AS DOUBLE) FROM customer), 'distinct keys vs rows'
UNION ALL SELECT 'distinct_product_key', (SELECT CAST(COUNT(DISTINCT product_id) AS DOUBLE) FROM dim_product),
       (SELECT CAST(COUNT(*) AS DOUBLE) FROM part), 'distinct keys vs rows'
UNION ALL SELECT 'distinct_order_key', (SELECT CAST(COUNT(DISTINCT order_id) AS DOUBLE) FROM fact_order),
       (SELECT CAST(COUNT(*) AS DOUBLE) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)), 'orders with lines'
UNION ALL SELECT 'physical_stock_qty',
       (SELECT CAST(SUM(stock_qty) AS DOUBLE) FROM fact_inventory WHERE store_id IN
          (SELECT store_id FROM dim_location WHERE store_type = 'physical')),
       (SELECT CAST(SUM(l_quantity) AS DOUBLE) FROM lineitem WHERE l_suppkey % 2 = 0), 'stock of physical stores'
UNION ALL SELECT 'order_amount', (SELECT CAST(ROUND(SUM(CAST(amount AS DECIMAL(28, 6))), 2) AS DOUBLE)
       FROM fact_order), (SELECT CAST(ROUND(SUM(CAST(l_quantity * (l_extendedprice / l_quantity) AS DECIMAL(28, 6))), 2) AS DOUBLE)
       FROM lineitem), 'rounded revenue'
UNION ALL SELECT 'orphan_order_customer', (SELECT CAST(COUNT(*) AS DOUBLE) FROM fact_order f
       WHERE NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.customer_id = f.customer_id)), 0.0, 'expect 0'
UNION ALL SELECT 'orphan_order_product', (SELECT CAST(COUNT(*) AS DOUBLE) FROM fact_order f
       WHERE NOT EXISTS (SELECT 1 FROM dim_product d WHERE d.product_id = f.product_id)), 0.0, 'expect 0'
UNION ALL SELECT 'orphan_order_store', (SELECT CAST(COUNT(*) AS DOUBLE) FROM fact_order f
       WHERE NOT EXISTS (SELECT 1 FROM dim_location d WHERE d.store_id = f.store_id)), 0.0, 'expect 0'
UNION ALL SELECT 'negative_values', (SELECT CAST(COUNT(*) AS DOUBLE) FROM fact_order
       WHERE qty < 0 OR unit_price < 0 OR amount < 0), 0.0, 'expect 0'
UNION ALL SELECT 'critical_nulls', (SELECT CAST(COUNT(*) AS DOUBLE) FROM fact_order WHERE order_id IS NULL
       OR customer_id IS NULL OR product_id IS NULL OR store_id IS NULL OR time_id IS NULL), 0.0, 'expect 0'
"""
_CHECK_VIEWS = ["fact_order", "fact_inventory", "dim_customer", "dim_product", "dim_location", "customer_subtypes"]
_RECON_SQL = W(_CHECK_VIEWS, """
SELECT name, dw_value, source_value,
       CASE WHEN dw_value IS NULL OR source_value IS NULL THEN NULL ELSE abs(dw_value - source_value) < 0.01 END AS is_match,
       note
FROM checks""", [("checks", _CHECKS_SQL)])

register("quality_reconcile", _RECON_SQL)(_checks)


@register("quality_summary", W(_CHECK_VIEWS, """
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE m) AS ok, COUNT(*) FILTER (WHERE NOT m) AS failed,
       COUNT(*) FILTER (WHERE m IS NULL) AS unavailable
FROM (SELECT CASE WHEN dw_value IS NULL OR source_value IS NULL THEN NULL
                  ELSE abs(dw_value - source_value) < 0.01 END AS m FROM checks) z""", [("checks", _CHECKS_SQL)]))
def _q10(t):
    return q.quality_summary(_checks(t))


@register("quality_table_counts", """
SELECT 'dim_customer' AS table_name, COUNT(*) AS n_rows FROM customer
UNION ALL SELECT 'dim_product', COUNT(*) FROM part
UNION ALL SELECT 'dim_location', COUNT(*) FROM supplier
UNION ALL SELECT 'fact_order', COUNT(*) FROM lineitem
UNION ALL SELECT 'fact_inventory', COUNT(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
UNION ALL SELECT 'dim_time', COUNT(*) FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders)
UNION ALL SELECT 'etl_log', COUNT(*) FROM orders""")
def _q11(t):
    fo, fi, c, p, loc, tm = _star(t)
    return q.table_counts({"dim_customer": c, "dim_product": p, "dim_location": loc, "fact_order": fo,
                           "fact_inventory": fi, "dim_time": tm, "etl_log": t.view("etl_log")})


# ---------------------------------------------------------------- Q12-Q15 log queries

@register("log_last_run", W(["etl_log"], """
SELECT * FROM etl_log WHERE job = 'RUN_ALL' ORDER BY started_at DESC, log_id DESC LIMIT 1"""))
def _q12(t):
    return q.last_run(t.view("etl_log"))


@register("log_last_run_per_job", W(["etl_log"], """
SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY job ORDER BY started_at DESC, log_id DESC) AS rn
FROM etl_log WHERE job LIKE 'LOAD_%') x WHERE rn = 1"""))
def _q13(t):
    return q.last_run_per_job(t.view("etl_log"))


@register("log_errors_last_day", W(["etl_log"], """
SELECT * FROM etl_log WHERE status = 'FAILED'
  AND started_at >= (SELECT MAX(started_at) FROM etl_log) - INTERVAL 1 DAY
  AND started_at <= (SELECT MAX(started_at) FROM etl_log)"""))
def _q14(t):
    log = t.view("etl_log")
    asof = log.agg(F.max("started_at").alias("asof"))
    return log.crossJoin(asof).filter(
        (F.col("status") == "FAILED") & (F.col("started_at") >= F.col("asof") - F.expr("INTERVAL 1 DAY"))
        & (F.col("started_at") <= F.col("asof"))).drop("asof")


@register("log_search", W(["etl_log"], """
SELECT * FROM etl_log WHERE status = 'FAILED' AND upper(job) LIKE '%FACT%'
  AND started_at >= TIMESTAMP '1998-01-01 00:00:00' AND started_at <= TIMESTAMP '1998-12-31 23:59:59'
ORDER BY started_at DESC, log_id DESC LIMIT 100"""))
def _q15(t):
    return q.search_log(t.view("etl_log"), status="FAILED", job="fact", start="1998-01-01 00:00:00",
                        end="1998-12-31 23:59:59", limit=100)
