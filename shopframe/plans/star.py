"""The warehouse star schema over the driver's tables.

Stores are suppliers (even key = physical store), cities are nations, states
are regions. Product weight is ``p_size * 100`` grams. Customer subtypes come
from deterministic draws (E15). Spark plans and DuckDB twins side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopframe.functions.exprs import draw, draw_sql, padded, padded_sql, rnd, rnd_sql

PHYSICAL, ONLINE = "physical", "online"
TOURIST, POSTAL, BOTH = "tourist", "postal", "both"
# E15 probabilities by the heaviest product a customer ordered (grams):
# >= 3000 g: tourist .30, postal .70; < 1000 g: .80 / .20; else .60 / .60.
HEAVY_G, LIGHT_G = 3000.0, 1000.0
P_TOURIST = (0.30, 0.80, 0.60)
P_POSTAL = (0.70, 0.20, 0.60)


def _geo(t) -> DataFrame:
    n = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    r = t["region"].select("r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city_name"),
        F.col("r_name").alias("state"))


def dim_location(t) -> DataFrame:
    s = t["supplier"].select("s_suppkey", "s_name", "s_nationkey")
    g = F.broadcast(_geo(t))  # bounded by the number of nations
    return s.join(g, s.s_nationkey == g.city_id, "left").select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"),
        F.when(F.col("s_suppkey") % 2 == 0, PHYSICAL).otherwise(ONLINE).alias("store_type"),
        "city_id", "city_name", "state",
        F.concat(F.lit("Office "), F.col("city_name")).alias("office_address"),
        F.concat(F.lit("+84-"), padded(F.col("s_suppkey"), 7)).alias("phone"))


def dim_product(t) -> DataFrame:
    p = t["part"]
    return p.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("description"),
        F.col("p_size").cast("string").alias("size"),
        (F.col("p_size") * F.lit(100.0)).alias("weight_g"), F.col("p_retailprice").alias("price"))


def customer_max_weight(t) -> DataFrame:
    """E15 input: heaviest ordered product per customer, 0 when none."""
    li = t["lineitem"].select("l_orderkey", "l_partkey")
    o = t["orders"].select("o_orderkey", "o_custkey")
    p = t["part"].select("p_partkey", (F.col("p_size") * F.lit(100.0)).alias("w"))
    per_order = li.join(p, li.l_partkey == p.p_partkey).groupBy("l_orderkey").agg(F.max("w").alias("w"))
    per_cust = o.join(per_order, o.o_orderkey == per_order.l_orderkey).groupBy("o_custkey") \
        .agg(F.max("w").alias("max_weight_g"))
    c = t["customer"].select("c_custkey")
    return c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.coalesce("max_weight_g", F.lit(0.0)).alias("max_weight_g"))


def customer_subtypes(t) -> DataFrame:
    """Independent tourist / postal draws from weight-dependent chances."""
    w = customer_max_weight(t)
    mw = F.col("max_weight_g")

    def pick(ps):
        return F.when(mw >= HEAVY_G, ps[0]).when(mw < LIGHT_G, ps[1]).otherwise(ps[2])
    return w.select(
        "customer_id", "max_weight_g",
        (draw("customer_id", 11) < pick(P_TOURIST)).alias("is_tourist"),
        (draw("customer_id", 13) < pick(P_POSTAL)).alias("is_postal"))


def dim_customer(t) -> DataFrame:
    c = t["customer"].select("c_custkey", "c_name", "c_nationkey")
    g = F.broadcast(_geo(t))
    st = customer_subtypes(t)
    j = c.join(g, c.c_nationkey == g.city_id, "left").join(st, c.c_custkey == st.customer_id, "left")
    ctype = (F.when(F.col("is_tourist") & F.col("is_postal"), BOTH)
             .when(F.col("is_tourist"), TOURIST).when(F.col("is_postal"), POSTAL))
    guide = F.concat(F.lit("Guide "), F.lpad((F.col("c_custkey") % 20 + 1).cast("string"), 2, "0"))
    addr = F.concat(F.lit("PO Box "), (F.lit(1000) + F.col("c_custkey") % 9000).cast("string"),
                    F.lit(", "), F.col("city_name"))
    return j.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        ctype.alias("customer_type"), "city_id", "city_name", "state",
        F.when(F.col("is_tourist"), guide).alias("guide"),
        F.when(F.col("is_postal"), addr).alias("postal_address"))


def fact_inventory(t) -> DataFrame:
    li = t["lineitem"]
    return li.groupBy(F.col("l_suppkey").alias("store_id"), F.col("l_partkey").alias("product_id")) \
        .agg(F.sum("l_quantity").alias("stock_qty"))


def _time_id(c):
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def fact_order(t) -> DataFrame:
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                              "l_extendedprice", "l_linestatus")
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("store_id"),
        _time_id(F.col("o_orderdate")).alias("time_id"),
        F.when(F.col("l_linestatus") == "O", "online").otherwise("store").alias("channel"),
        F.col("l_quantity").alias("qty"),
        rnd(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("unit_price"),
        F.col("l_extendedprice").alias("amount"))


def dim_time(t) -> DataFrame:
    d = t["orders"].select(F.to_date("o_orderdate").alias("d")).distinct()
    return d.select(
        _time_id(F.col("d")).alias("time_id"), F.col("d").alias("date"),
        F.dayofmonth("d").alias("day"), F.month("d").alias("month"), F.quarter("d").alias("quarter"),
        F.year("d").alias("year"), F.date_format("d", "EEEE").alias("weekday"))


# ---------------------------------------------------------------- DuckDB twins

def _pick_sql(ps) -> str:
    return (f"CASE WHEN w.max_weight_g >= {HEAVY_G} THEN {ps[0]} WHEN w.max_weight_g < {LIGHT_G} "
            f"THEN {ps[1]} ELSE {ps[2]} END")


SQL: dict[str, str] = {
    "geo": """
SELECT n.n_nationkey AS city_id, n.n_name AS city_name, r.r_name AS state
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "dim_location": f"""
SELECT s.s_suppkey AS store_id, s.s_name AS store_name,
       CASE WHEN s.s_suppkey % 2 = 0 THEN '{PHYSICAL}' ELSE '{ONLINE}' END AS store_type,
       g.city_id, g.city_name, g.state, 'Office ' || g.city_name AS office_address,
       '+84-' || {padded_sql('s.s_suppkey', 7)} AS phone
FROM supplier s LEFT JOIN geo g ON s.s_nationkey = g.city_id""",
    "dim_product": """
SELECT p_partkey AS product_id, p_name AS description, CAST(p_size AS VARCHAR) AS size,
       CAST(p_size * 100.0 AS DOUBLE) AS weight_g, p_retailprice AS price
FROM part""",
    "customer_max_weight": """
SELECT c.c_custkey AS customer_id, CAST(COALESCE(m.max_weight_g, 0.0) AS DOUBLE) AS max_weight_g
FROM customer c LEFT JOIN (
  SELECT o.o_custkey, CAST(MAX(p.p_size * 100.0) AS DOUBLE) AS max_weight_g
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey) m ON c.c_custkey = m.o_custkey""",
    "customer_subtypes": f"""
SELECT w.customer_id, w.max_weight_g,
       {draw_sql('w.customer_id', 11)} < {_pick_sql(P_TOURIST)} AS is_tourist,
       {draw_sql('w.customer_id', 13)} < {_pick_sql(P_POSTAL)} AS is_postal
FROM customer_max_weight w""",
    "dim_customer": f"""
SELECT c.c_custkey AS customer_id, c.c_name AS customer_name,
       CASE WHEN st.is_tourist AND st.is_postal THEN '{BOTH}' WHEN st.is_tourist THEN '{TOURIST}'
            WHEN st.is_postal THEN '{POSTAL}' END AS customer_type,
       g.city_id, g.city_name, g.state,
       CASE WHEN st.is_tourist THEN 'Guide ' || lpad(CAST(c.c_custkey % 20 + 1 AS VARCHAR), 2, '0') END AS guide,
       CASE WHEN st.is_postal THEN 'PO Box ' || CAST(1000 + c.c_custkey % 9000 AS VARCHAR) || ', ' || g.city_name END
         AS postal_address
FROM customer c LEFT JOIN geo g ON c.c_nationkey = g.city_id
LEFT JOIN customer_subtypes st ON c.c_custkey = st.customer_id""",
    "fact_inventory": """
SELECT l_suppkey AS store_id, l_partkey AS product_id, SUM(l_quantity) AS stock_qty
FROM lineitem GROUP BY l_suppkey, l_partkey""",
    "fact_order": f"""
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
       l.l_suppkey AS store_id,
       CAST(year(o.o_orderdate) * 10000 + month(o.o_orderdate) * 100 + day(o.o_orderdate) AS INTEGER) AS time_id,
       CASE WHEN l.l_linestatus = 'O' THEN 'online' ELSE 'store' END AS channel,
       l.l_quantity AS qty, {rnd_sql('l.l_extendedprice / l.l_quantity', 2)} AS unit_price,
       l.l_extendedprice AS amount
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "dim_time": """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS time_id, d AS date,
       CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(year(d) AS INTEGER) AS year, dayname(d) AS weekday
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x""",
}

DEPS: dict[str, tuple[str, ...]] = {
    "dim_location": ("geo",),
    "customer_subtypes": ("customer_max_weight",),
    "dim_customer": ("geo", "customer_subtypes"),
}
