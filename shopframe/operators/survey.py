"""Profiling and signal-check queries over the shop and fashion entities.

Inputs are the surrogate entities of ``plans.retail`` (or any frames with the
same columns). Averages and percentages are rounded half-up with ``rnd`` to
the digits the reports print. Threshold parameters default to the values the
reports use; price cut-offs and volume floors are parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopframe.functions.baskets import dealt, first_by, item_sets, pair_counts, patterns
from shopframe.functions.exprs import bucket, days_between, exact_sum, rate, rnd, share
from shopframe.functions.quantile import group_quantiles, quantiles
from shopframe.plans.sessions import as_sessions

# ---------------------------------------------------------------- fixed values
# Report labels that must read exactly as in the reports, in band order.
PROCESSING_LABELS = ("Under 1 day", "1-2 days", "2-3 days", "Over 3 days")
EVENT_COUNT_LABELS = ("1 event", "2-5 events", "6-10 events", "11+ events")
BUYER_TYPE_LABELS = ("Repeat (>=2 orders)", "One-time (1 order)")
PAIR_TYPE_LABELS = ("Same Department", "Cross Department")
ORDER_GROUP_LABELS = ("1 order", "2 orders", "3 orders", "4 orders")
TIER_LABELS = ("Budget", "Mid-range", "Premium")
DEPTH_LABELS = ("01. 1-5", "02. 6-10", "03. 11-20", "04. 21-50", "05. 50+")
URI_LABELS = ("product_page", "category_page", "home", "other: ")
MARGIN_LABELS = ("1. Low (<30%)", "2. Mid (30-50%)", "3. High (50-70%)", "4. Premium (>70%)")
RETURN_BAND_LABELS = ("0%", "1-5%", "6-10%", "11-15%", "16-20%", ">20%")
LOGIN_LABELS = ("Anonymous", "Logged-in")
BROWSE_LABELS = ("1 product", "2-3 products", "4-5 products", "6+ products")
SEGMENT_LABELS = ("Newbie", "VIP", "Normal")
SALES_BAND_LABELS = ("0 (not sold)", "1-5", "6-10", "11+")
MARGIN_RETURN_LABELS = ("Low Margin (<40%)", "Mid Margin (40-55%)", "High Margin (>55%)")
AGE_GROUP_LABELS = ("< 20", "20-29", "30-39", "40-49", "50-59", "60+")
FREQUENCY_LABELS = ("1 (one-time)", "2-5", "6-10", "11-20", "21-50", "51+")
TRIP_LABELS = ("1 item", "2-3 items", "4-5 items", "6-10 items", "11+ items")
STYLE_AGE_LABELS = ("GenZ (< 25)", "Young (25-34)", "Middle (35-49)", "Senior (50+)")
PRICE_BAND_LABELS = ("01. <20", "02. 20-50", "03. 50-100", "04. 100-200", "05. 200+")
AGE_BAND_LABELS = ("18-24", "25-34", "35-44", "45-54", "55+")
CANCEL_BAND_LABELS = ("Under $20", "$20 - $50", "$50 - $100", "Over $100")


def _n() -> Column:
    return F.count(F.lit(1))


def not_cancelled(oi: DataFrame) -> DataFrame:
    return oi.filter(F.col("status") != "Cancelled")


def distribution(df: DataFrame, value: str, label: str | None = None, n: str = "n",
                 d: int = 2) -> DataFrame:
    """Rows per value (or label) with their share of all rows."""
    g = df.groupBy(label if label is not None else value).agg(_n().alias(n))
    return g.withColumn("pct", share(n, d=d))


def _items(oi, p, cols=("category",)):
    return oi.join(p.select(F.col("id").alias("product_id"), *cols), "product_id")


# ---------------------------------------------------------------- V1-V14 (shop)

def age_by_category(u, oi, p):
    j = oi.join(u.select(F.col("id").alias("user_id"), "age"), "user_id")
    j = _items(j, p)
    return j.groupBy("category").agg(_n().alias("total_orders"), rnd(F.avg("age"), 1).alias("avg_age"),
                                     rnd(F.stddev_samp("age"), 1).alias("std_age"))


def spend_by_traffic_source(u, o, oi):
    j = u.select(F.col("id").alias("user_id"), "traffic_source") \
        .join(o.select("order_id", "user_id", "num_of_item"), "user_id") \
        .join(oi.select("order_id", "sale_price"), "order_id")
    return j.groupBy("traffic_source").agg(
        F.count_distinct("order_id").alias("total_orders"),
        rnd(F.avg("sale_price"), 2).alias("avg_item_price"),
        rnd(F.avg("num_of_item"), 2).alias("avg_items_per_order"))


def delivery_time_by_center(oi, p):
    j = _items(oi.filter(F.col("delivered_at").isNotNull()), p, ("distribution_center_id",))
    return j.groupBy("distribution_center_id").agg(
        _n().alias("total_shipped"),
        rnd(F.avg(days_between("delivered_at", "shipped_at")), 2).alias("avg_transit_days"),
        rnd(F.avg(days_between("shipped_at", "created_at")), 2).alias("avg_processing_days"))


def days_to_sell_by_category(ii, p):
    j = _items(ii.filter(F.col("sold_at").isNotNull()), p)
    return j.groupBy("category").agg(_n().alias("items_sold"),
                                     rnd(F.avg(days_between("sold_at", "created_at")), 2).alias("avg_days_to_sell"))


def processing_time_buckets(oi):
    d = days_between("shipped_at", "created_at")
    b = bucket(d, [1, 2, 3], PROCESSING_LABELS)
    return oi.filter(F.col("shipped_at").isNotNull()).groupBy(b.alias("processing_time_bucket")) \
        .agg(_n().alias("num_orders"))


def session_length_vs_purchase(ev):
    s = as_sessions(ev).select(F.col("n_events").alias("total_events"), (F.col("n_purchase") > 0).cast("int").alias("has_purchase"))
    te = F.col("total_events")
    e = EVENT_COUNT_LABELS
    b = F.when(te == 1, e[0]).when(te.between(2, 5), e[1]).when(te.between(6, 10), e[2]).otherwise(e[3])
    return s.groupBy(b.alias("event_count_bucket")).agg(
        _n().alias("total_sessions"),
        rnd(F.lit(100.0) * F.sum("has_purchase") / _n(), 2).alias("purchase_rate"))


def user_order_totals(oi):
    """Per user: non-cancelled distinct orders and spend."""
    return not_cancelled(oi).groupBy("user_id").agg(
        F.count_distinct("order_id").alias("total_orders"), exact_sum("sale_price").alias("total_monetary"))


def first_orders_by_min_time(oi):
    """First non-cancelled order per user, orders ranked by their earliest item time."""
    per_order = not_cancelled(oi).groupBy("user_id", "order_id").agg(F.min("created_at").alias("t0"))
    return first_by(per_order, "user_id", ["t0", "order_id"], [])


def first_order_vs_repeat(oi):
    fo = first_orders_by_min_time(oi)
    items = oi.groupBy("user_id", "order_id").agg(_n().alias("first_order_items"))
    fos = fo.join(items, ["user_id", "order_id"])
    j = fos.join(user_order_totals(oi), "user_id")
    return j.groupBy("first_order_items").agg(
        _n().alias("num_users"), rnd(F.avg("total_orders"), 3).alias("avg_total_orders"),
        rnd(F.lit(100.0) * F.avg(F.when(F.col("total_orders") >= 2, 1.0).otherwise(0.0)), 2).alias("repeat_pct"))


def repeat_vs_onetime_profile(oi, p):
    # the reference joins the first order's lines on order id only
    fo = first_orders_by_min_time(oi).select(F.col("user_id").alias("fuser"), "order_id")
    lines = _items(oi.select("order_id", "product_id"), p)
    fof = fo.join(lines, "order_id").groupBy("fuser").agg(
        _n().alias("first_order_num_items"), F.count_distinct("category").alias("first_order_num_categories"))
    j = fof.join(user_order_totals(oi), F.col("fuser") == F.col("user_id"))
    bt = F.when(F.col("total_orders") >= 2, BUYER_TYPE_LABELS[0]).otherwise(BUYER_TYPE_LABELS[1])
    return j.groupBy(bt.alias("buyer_type")).agg(
        _n().alias("num_users"), rnd(F.avg("first_order_num_items"), 3).alias("avg_first_items"),
        rnd(F.avg("first_order_num_categories"), 3).alias("avg_first_cats"))


def category_frequency_by_department(oi, p, top: int = 15, parts: int = 1):
    """Orders are made distinct by their own tasks, so that only counts travel by category."""
    j = dealt(_items(not_cancelled(oi), p, ("department", "category")).select("order_id", "department", "category"), "order_id", parts)
    total = dealt(not_cancelled(oi).select("order_id"), "order_id", parts).distinct().agg(F.count("order_id").alias("_all"))
    g = j.distinct().groupBy("department", "category").agg(F.count("order_id").alias("orders_with_category"))
    g = g.crossJoin(total).select("department", "category", "orders_with_category",
                                  rnd(F.lit(100.0) * F.col("orders_with_category") / F.col("_all"), 2)
                                  .alias("pct_of_all_orders"))
    return g.orderBy(F.desc("orders_with_category"), "department", "category").limit(top)


def same_vs_cross_department_pairs(oi, p):
    j = _items(not_cancelled(oi), p, ("department", "category"))
    sets = item_sets(j, "order_id", F.struct("category", "department"), min_size=2)
    pc = pair_counts(patterns(sets), cond=lambda pr: pr["a"]["category"] < pr["b"]["category"])
    t = F.when(F.col("a.department") == F.col("b.department"), PAIR_TYPE_LABELS[0]).otherwise(PAIR_TYPE_LABELS[1])
    g = pc.groupBy(t.alias("pair_type")).agg(F.sum("n").alias("pair_count"))
    return g.withColumn("pct", share("pair_count"))


def order_count_profile(oi, p):
    j = _items(not_cancelled(oi), p)
    u = j.groupBy("user_id").agg(
        F.count_distinct("order_id").alias("total_orders"), exact_sum("sale_price").alias("monetary"),
        F.avg("sale_price").alias("aov"), F.count_distinct("category").alias("num_categories"))
    t = F.col("total_orders")
    og = ORDER_GROUP_LABELS
    label = F.when(t == 1, og[0]).when(t == 2, og[1]).when(t == 3, og[2]).when(t == 4, og[3])
    g = u.groupBy("total_orders").agg(
        _n().alias("num_users"), rnd(F.avg("monetary"), 2).alias("avg_monetary"),
        rnd(F.avg("aov"), 2).alias("avg_aov"), rnd(F.avg("num_categories"), 2).alias("avg_categories"))
    return g.select(label.alias("order_group"), "num_users", "avg_monetary", "avg_aov", "avg_categories")


def departments_per_order(oi, p):
    j = _items(not_cancelled(oi), p, ("department",))
    per = j.groupBy("order_id").agg(F.count_distinct("department").alias("num_departments"))
    return distribution(per, "num_departments", n="num_orders")


def gender_purchasing(u, oi):
    us = not_cancelled(oi).groupBy("user_id").agg(
        F.count_distinct("order_id").alias("total_orders"), exact_sum("sale_price").alias("monetary"),
        F.avg("sale_price").alias("avg_price"))
    j = u.select(F.col("id").alias("user_id"), "gender").join(us, "user_id") \
        .join(oi.select("user_id"), "user_id")  # one row per item: the report's weighting
    return j.groupBy("gender").agg(
        F.count_distinct("user_id").alias("num_users"), rnd(F.avg("total_orders"), 2).alias("avg_orders"),
        rnd(F.avg("monetary"), 2).alias("avg_monetary"), rnd(F.avg("avg_price"), 2).alias("avg_item_price"))


def category_pairs(oi, p, department: str | None = None, attr: str = "category") -> DataFrame:
    """distinct_pairs(): (a, b, n) orders holding both values, a < b, non-cancelled."""
    j = _items(not_cancelled(oi), p, tuple({attr, "department"}))
    if department is not None:
        j = j.filter(F.col("department") == department)
    j = j.filter(F.col(attr).isNotNull() & (F.col(attr) != ""))
    sets = item_sets(j, "order_id", attr, min_size=2)
    return pair_counts(patterns(sets))


def top_pairs_in_department(oi, p, department: str, top: int = 10):
    pc = category_pairs(oi, p, department)
    return pc.select(F.col("a").alias("cat_a"), F.col("b").alias("cat_b"), F.col("n").alias("pair_count")) \
        .orderBy(F.desc("pair_count"), "cat_a", "cat_b").limit(top)


# ---------------------------------------------------------------- V15-V17 prices

def price_tier_counts_by_category(p, lo: float = 28, hi: float = 58):
    x = p.filter(F.col("retail_price") > 0)
    rp = F.col("retail_price")
    return x.groupBy("category").agg(
        _n().alias("total"), F.count_if(rp < lo).alias("budget_count"),
        F.count_if(rp.between(lo, hi)).alias("mid_count"), F.count_if(rp > hi).alias("premium_count"),
        rnd(F.lit(100.0) * F.count_if(rp > hi) / _n(), 1).alias("pct_premium"))


def price_tier(rp: Column, lo: float, hi: float) -> Column:
    return F.when(rp < lo, TIER_LABELS[0]).when(rp <= hi, TIER_LABELS[1]).otherwise(TIER_LABELS[2])


def tier_share_by_department(p, lo: float = 28, hi: float = 58):
    x = p.filter(F.col("retail_price") > 0)
    g = x.groupBy("department", price_tier(F.col("retail_price"), lo, hi).alias("tier")).agg(_n().alias("cnt"))
    return g.withColumn("pct", share("cnt", by=["department"]))


def price_spread_by_category(p):
    x = p.filter(F.col("retail_price") > 0)
    rp = F.col("retail_price")
    return x.groupBy("category").agg(
        _n().alias("num_products"), rnd(F.min(rp), 2).alias("min_price"), rnd(F.max(rp), 2).alias("max_price"),
        rnd(F.avg(rp), 2).alias("avg_price"), rnd(F.stddev_samp(rp), 2).alias("std_price"),
        rnd(F.max(rp) - F.min(rp), 2).alias("price_range"))


# ---------------------------------------------------------------- V18-V30

def status_distribution(oi):
    return distribution(oi, "status", n="cnt")


def event_type_distribution(ev):
    return distribution(ev, "event_type", n="cnt")


def user_overlap(ev, oi):
    e = ev.filter(F.col("user_id").isNotNull()).select("user_id").distinct()
    o = oi.select("user_id").distinct()
    return (e.agg(_n().alias("users_with_events"))
            .crossJoin(o.agg(_n().alias("users_with_orders")))
            .crossJoin(e.join(o, "user_id").agg(_n().alias("users_with_both"))))


def category_count(p):
    return p.agg(F.count_distinct("category").alias("num_categories"))


def items_per_order(oi):
    per = oi.groupBy("order_id").agg(_n().alias("item_count"))
    return per.agg(rnd(F.avg("item_count"), 2).alias("avg_items"),
                   F.percentile("item_count", 0.5).alias("median_items"),
                   F.max("item_count").alias("max_items"))


def _returns(g):
    ret = F.sum(F.when(F.col("status") == "Returned", 1).otherwise(0))
    return g.agg(_n().alias("total"), ret.alias("returned"), rate(F.col("status") == "Returned").alias("return_pct"))


def return_rate_by_category(oi, p, top: int = 15):
    g = _returns(_items(oi, p).groupBy("category")).withColumnRenamed("total", "total_items")
    return g.orderBy(F.desc("total_items"), "category").limit(top)


PRICE_BAND_EDGES = (20, 50, 100, 200)

def return_rate_by_price_band(oi, edges=PRICE_BAND_EDGES, labels=PRICE_BAND_LABELS):
    return _returns(oi.groupBy(bucket("sale_price", edges, labels).alias("price_range")))


def event_funnel(ev):
    e = ev.filter(F.col("user_id").isNotNull())
    total = e.agg(F.count_distinct("session_id").alias("_s"))
    g = e.groupBy("event_type").agg(_n().alias("total_events"),
                                    F.count_distinct("session_id").alias("sessions_with_event"))
    return g.crossJoin(total).select(
        "event_type", "total_events", "sessions_with_event",
        rnd(F.lit(100.0) * F.col("sessions_with_event") / F.col("_s"), 2).alias("pct_sessions"))


def categories_per_order(oi, p, parts: int = 1):
    per = dealt(_items(oi, p).select("order_id", "category"), "order_id", parts).groupBy("order_id").agg(F.count_distinct("category").alias("num_categories"))
    return distribution(per, "num_categories", n="num_orders")


def orders_per_user(oi, top: int = 15):
    per = user_order_totals(oi)
    return distribution(per, "total_orders", n="num_users").orderBy("total_orders").limit(top)


AGE_BAND_EDGES = (25, 35, 45, 55)


def return_rate_by_age_band(oi, u):
    j = oi.join(u.select(F.col("id").alias("user_id"), "age"), "user_id")
    # CASE without a null branch: unknown age falls into the last band
    return _returns(j.groupBy(bucket("age", AGE_BAND_EDGES, AGE_BAND_LABELS).alias("age_group")))


def session_depth_bands(ev):
    s = as_sessions(ev).filter(F.col("user_id").isNotNull()).select(F.col("depth").alias("m"))
    b = bucket("m", [5, 10, 20, 50], DEPTH_LABELS, right_open=False)
    return distribution(s, "m", b.alias("depth_range"), n="num_sessions")


def purchase_events_vs_orders(ev, oi):
    nc = not_cancelled(oi)
    return (ev.filter((F.col("event_type") == "purchase") & F.col("user_id").isNotNull())
            .agg(_n().alias("purchase_events"))
            .crossJoin(nc.agg(F.count_distinct("order_id").alias("distinct_orders"), _n().alias("total_order_items"))))


def describe_table(df: DataFrame) -> DataFrame:
    """Column names and types of a frame (metadata only)."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal_position int, column_name string, data_type string, "
                                                 "is_nullable boolean")


def list_tables(spark, database: str | None = None) -> DataFrame:
    """Names of the tables and views of the catalog."""
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name string, table_type string, is_temporary boolean")


# ---------------------------------------------------------------- V32-V54 events and products

def top_uris(ev, top: int = 30, event_type: str | None = None):
    e = ev.filter(F.col("user_id").isNotNull())
    keys = ["uri", "event_type"]
    if event_type is not None:
        e = e.filter(F.col("event_type") == event_type)
        keys = ["uri"]
    return e.groupBy(*keys).agg(_n().alias("cnt")).orderBy(F.desc("cnt"), *keys).limit(top)


def events_with_and_without_user(ev, types=("cancel", "purchase", "cart")):
    return ev.filter(F.col("event_type").isin(*types)).groupBy("event_type").agg(
        F.count_if(F.col("user_id").isNotNull()).alias("with_user"),
        F.count_if(F.col("user_id").isNull()).alias("without_user"), _n().alias("total"))


def first_order_vs_total(oi):
    """First order = the order of a user's earliest non-cancelled item."""
    fo = first_by(not_cancelled(oi), "user_id", ["created_at", "order_id"], [])
    items = oi.groupBy("user_id", "order_id").agg(_n().alias("first_order_items"))
    j = fo.join(items, ["user_id", "order_id"]).join(user_order_totals(oi), "user_id")
    return j.groupBy("first_order_items").agg(
        _n().alias("num_users"), rnd(F.avg("total_monetary"), 2).alias("avg_monetary"),
        rnd(F.avg("total_orders"), 2).alias("avg_orders"),
        rnd(F.avg(F.when(F.col("total_orders") >= 2, 1.0).otherwise(0.0)) * 100, 2).alias("repeat_pct"))


def repeat_by_traffic_source(u, oi):
    j = u.select(F.col("id").alias("user_id"), "traffic_source").join(user_order_totals(oi), "user_id")
    return j.groupBy("traffic_source").agg(
        _n().alias("num_users"),
        rnd(F.avg(F.when(F.col("total_orders") >= 2, 1.0).otherwise(0.0)) * 100, 2).alias("repeat_pct"),
        rnd(F.avg("total_orders"), 2).alias("avg_orders"))


def spend_by_gender(u, oi):
    j = u.select(F.col("id").alias("user_id"), "gender").join(user_order_totals(oi), "user_id")
    return j.groupBy("gender").agg(
        F.count_distinct("user_id").alias("num_users"), rnd(F.avg("total_monetary"), 2).alias("avg_monetary"),
        rnd(F.avg("total_orders"), 2).alias("avg_orders"))


def _support(pc, oi, d):
    total = not_cancelled(oi).agg(F.count_distinct("order_id").alias("_all"))
    return pc.crossJoin(total).withColumn("support_pct", rnd(F.lit(100.0) * F.col("pair_count") / F.col("_all"), d)) \
        .drop("_all")


def top_category_pairs(oi, p, top: int = 15):
    pc = category_pairs(oi, p).select(F.col("a").alias("cat_a"), F.col("b").alias("cat_b"),
                                      F.col("n").alias("pair_count"))
    return _support(pc, oi, 2).orderBy(F.desc("pair_count"), "cat_a", "cat_b").limit(top)


def department_share(p):
    return distribution(p, "department", n="num_products")


def uri_pattern_counts(ev, top: int = 20):
    e = ev.filter(F.col("user_id").isNotNull())
    u = F.col("uri")
    pat = (F.when(u.like("/product/%"), URI_LABELS[0]).when(u.like("/category/%"), URI_LABELS[1])
           .when(u.like("/"), URI_LABELS[2]).otherwise(F.concat(F.lit(URI_LABELS[3]), F.left(u, F.lit(30)))))
    return e.groupBy(pat.alias("uri_pattern")).agg(_n().alias("cnt")).orderBy(F.desc("cnt"), "uri_pattern").limit(top)


def uri_segment_counts(ev, top: int = 20):
    e = ev.filter((F.col("event_type") == "product") & F.col("user_id").isNotNull() & F.col("uri").like("/product/%"))
    seg = F.split_part(F.col("uri"), F.lit("/"), F.lit(5))
    return e.groupBy(seg.alias("browsed_category")).agg(_n().alias("view_count")) \
        .orderBy(F.desc("view_count"), "browsed_category").limit(top)


def products_viewed_per_session(ev):
    s = as_sessions(ev).filter(F.col("user_id").isNotNull()).select(F.col("n_product").alias("pb"))
    pb = F.col("pb")
    lab = F.when(pb == 1, "1").when(pb == 2, "2").when(pb == 3, "3").when(pb >= 4, "4+")
    return distribution(s, "pb", lab.alias("products_per_session"), n="num_sessions")


def browse_events_total(ev):
    return ev.filter((F.col("event_type") == "department") & F.col("user_id").isNotNull()
                     & F.col("uri").like("/department/%")).agg(_n().alias("total_browse_events"))


def margin(p) -> Column:
    return F.try_divide(F.col("retail_price") - F.col("cost"), F.nullif(F.col("retail_price"), F.lit(0)))


def _priced(p):
    return p.filter((F.col("cost") > 0) & (F.col("retail_price") > 0))


def margin_bands(p):
    x = _priced(p).withColumn("margin_pct", margin(p))
    b = bucket("margin_pct", [0.3, 0.5, 0.7], MARGIN_LABELS)
    rp = F.col("retail_price")
    return x.groupBy(b.alias("margin_band")).agg(
        _n().alias("num_products"), rnd(F.min(rp), 2).alias("min_price"), rnd(F.max(rp), 2).alias("max_price"),
        rnd(F.avg(rp), 2).alias("avg_price"))


def brands_by_price(p, min_products: int = 5, top: int = 20):
    rp = F.col("retail_price")
    g = p.filter(F.col("brand").isNotNull()).groupBy("brand").agg(
        _n().alias("num_products"), rnd(F.avg(rp), 2).alias("avg_price"), rnd(F.min(rp), 2).alias("min_price"),
        rnd(F.max(rp), 2).alias("max_price"), rnd(F.stddev_samp(rp), 2).alias("std_price"))
    return g.filter(F.col("num_products") >= min_products).orderBy(F.desc("avg_price"), "brand").limit(top)


def margin_by_category(p):
    x = _priced(p).withColumn("m", margin(p))
    return x.groupBy("category").agg(_n().alias("num_products"), rnd(F.avg("m") * 100, 2).alias("avg_margin_pct"),
                                     rnd(F.stddev_samp("m") * 100, 2).alias("std_margin_pct"))


def brand_counts(p, oi):
    b = p.filter(F.col("brand").isNotNull())
    bought = _items(not_cancelled(oi), p, ("brand",))
    return (b.agg(F.count_distinct("brand").alias("unique_brands"))
            .crossJoin(b.filter(F.col("brand") != "").agg(F.count_distinct("brand").alias("non_empty_brands")))
            .crossJoin(bought.agg(F.count_distinct("brand").alias("brands_actually_purchased"))))


def product_return_bands(oi, p, min_sales: int = 10):
    ps = _items(oi, p, ("brand", "category")).groupBy("product_id", "brand", "category").agg(
        _n().alias("total_sold"), F.count_if(F.col("status") == "Returned").alias("total_returned"))
    ps = ps.filter(F.col("total_sold") >= min_sales).withColumn(
        "return_pct", rnd(F.lit(100.0) * F.col("total_returned") / F.col("total_sold"), 1))
    r = F.col("return_pct")
    rb = RETURN_BAND_LABELS
    b = (F.when(r == 0, rb[0]).when(r <= 5, rb[1]).when(r <= 10, rb[2]).when(r <= 15, rb[3])
         .when(r <= 20, rb[4]).otherwise(rb[5]))
    return ps.groupBy(b.alias("return_band")).agg(_n().alias("num_products"),
                                                  rnd(F.avg("return_pct"), 2).alias("avg_return_pct"))


def brands_per_order(oi, p):
    j = _items(not_cancelled(oi), p, ("brand",)).filter(F.col("brand").isNotNull() & (F.col("brand") != ""))
    per = j.groupBy("order_id").agg(F.count_distinct("brand").alias("num_brands"))
    return distribution(per, "num_brands", n="num_orders")


def funnel_by_login_state(ev):
    ut = F.when(F.col("user_id").isNull(), LOGIN_LABELS[0]).otherwise(LOGIN_LABELS[1])
    return ev.groupBy(ut.alias("user_type"), "event_type").agg(
        _n().alias("total_events"), F.count_distinct("session_id").alias("sessions_with_this_event"))


def browse_depth(ev):
    s = ev.filter((F.col("event_type") == "product") & F.col("user_id").isNotNull()) \
        .groupBy("session_id").agg(F.count_distinct("uri").alias("up"))
    b = bucket("up", [1, 3, 5], BROWSE_LABELS, right_open=False)
    return distribution(s, "up", b.alias("browse_depth"), n="num_sessions")


def brand_pairs(oi, p, min_count: int = 50, top: int = 20):
    pc = category_pairs(oi, p, attr="brand").filter(F.col("n") >= min_count).select(
        F.col("a").alias("brand_a"), F.col("b").alias("brand_b"), F.col("n").alias("pair_count"))
    return _support(pc, oi, 3).orderBy(F.desc("pair_count"), "brand_a", "brand_b").limit(top)


def _product_of_uri(uri: Column) -> Column:
    return F.split_part(uri, F.lit("/"), F.lit(3)).try_cast("long")


def conversion_by_category(ev, oi, p, min_views: int = 100):
    views = ev.filter((F.col("event_type") == "product") & F.col("user_id").isNull()) \
        .groupBy(_product_of_uri(F.col("uri")).alias("product_id")).agg(_n().alias("total_views"))
    sales = not_cancelled(oi).groupBy("product_id").agg(_n().alias("total_sales"))
    j = p.select(F.col("id").alias("product_id"), "category").join(views, "product_id", "left") \
        .join(sales, "product_id", "left")
    g = j.groupBy("category").agg(F.sum("total_views").alias("views"), F.sum("total_sales").alias("sales"))
    return g.filter(F.col("views") > min_views).withColumn(
        "conv_rate", rnd(F.try_divide(F.lit(100.0) * F.col("sales"), F.nullif(F.col("views"), F.lit(0))), 2))


def anonymous_sessions(ev):
    """Per anonymous session: viewed product (max of the uri text), cancelled, carted."""
    return as_sessions(ev).filter(F.col("user_id").isNull()).select(
        "session_id", F.col("product_text").try_cast("long").alias("product_id"),
        (F.col("n_cancel") > 0).cast("int").alias("is_cancelled"), (F.col("n_cart") > 0).cast("int").alias("added_to_cart"))


def abandonment_by_category(ev, p):
    sb = anonymous_sessions(ev).join(p.select(F.col("id").alias("product_id"), "category"), "product_id")
    return sb.groupBy("category").agg(
        _n().alias("total_sessions"), F.sum("is_cancelled").alias("cancelled_sessions"),
        rnd(F.lit(100.0) * F.sum("is_cancelled") / _n(), 2).alias("cancel_rate"))


CANCEL_BAND_EDGES = (20, 50, 100)


def cancel_rate_by_price_band(ev, p, edges=CANCEL_BAND_EDGES, labels=CANCEL_BAND_LABELS):
    sb = anonymous_sessions(ev).join(
        p.filter(F.col("retail_price").isNotNull()).select(F.col("id").alias("product_id"), "retail_price"),
        "product_id")
    return sb.groupBy(bucket("retail_price", edges, labels).alias("price_range")).agg(
        _n().alias("total_sessions"), rnd(F.lit(100.0) * F.sum("is_cancelled") / _n(), 2).alias("cancel_rate"))


def _mix(df: DataFrame, seg: str, values: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Category share per segment value, one column per value (MAX(CASE) pivot)."""
    tot = df.groupBy(seg).agg(_n().alias("_tot"))
    cat = df.groupBy(seg, "category").agg(_n().alias("_cat"))
    j = cat.join(tot, seg)
    cols = [rnd(F.lit(100.0) * F.max(F.when(F.col(seg) == v, F.col("_cat")).otherwise(0))
                / F.max(F.when(F.col(seg) == v, F.col("_tot")).otherwise(1)), 2).alias(n)
            for v, n in zip(values, names)]
    return j.groupBy("category").agg(*cols)


def category_mix_by_country(u, oi, p, countries: Sequence[str], names: Sequence[str]):
    j = _items(oi.join(u.select(F.col("id").alias("user_id"), "country"), "user_id"), p) \
        .filter(F.col("country").isin(*countries))
    return _mix(j, "country", countries, names)


def category_mix_newbie_vs_vip(o, oi, p):
    uc = o.groupBy("user_id").agg(F.count_distinct("order_id").alias("num_orders"))
    n = F.col("num_orders")
    new, vip, normal = SEGMENT_LABELS
    seg = uc.select("user_id", F.when(n == 1, new).when(n > 3, vip).otherwise(normal).alias("segment"))
    j = _items(seg.filter(F.col("segment").isin(new, vip)).join(oi.select("user_id", "product_id"), "user_id"), p)
    return _mix(j, "segment", [new, vip], ["newbie_pct", "vip_pct"])


# ---------------------------------------------------------------- V57-V62

def price_quartiles_by_category(p, exact: bool = True):
    x = p.filter(F.col("retail_price") > 0)
    by, points, names = ["category", "department"], [0.25, 0.5, 0.75], ["p25", "median", "p75"]
    g = x.groupBy(*by).agg(_n().alias("num_products"), F.percentile_approx("retail_price", points, 10000).alias("_q"),
                           rnd(F.avg("retail_price"), 2).alias("avg_price"))
    if exact:
        q = group_quantiles(x, ["retail_price"], points, by)
        q = q.select(*[F.col(c).alias(f"_{c}") for c in by], F.array(*[f"retail_price_q{i}" for i in range(3)]).alias("_e"))
        g = g.drop("_q").join(q, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]).withColumnRenamed("_e", "_q")
    return g.select(*by, "num_products", *[rnd(F.get("_q", F.lit(i)), 2).alias(n) for i, n in enumerate(names)], "avg_price")


def price_cutoffs(p, exact: bool = True):
    rp = F.col("retail_price")
    x, points = p.filter(rp > 0), [0.33, 0.67]
    q = group_quantiles(x, ["retail_price"], points) if exact else \
        x.agg(F.percentile_approx(rp, points, 100_000).alias("_q")).select(*[F.get("_q", F.lit(i)).alias(f"retail_price_q{i}") for i in range(2)])
    rest = x.agg(rnd(F.min(rp), 2).alias("min_price"), rnd(F.max(rp), 2).alias("max_price"),
                 rnd(F.avg(rp), 2).alias("avg_price"), _n().alias("total_products"))
    return q.select(rnd("retail_price_q0", 2).alias("p33_budget_cutoff"), rnd("retail_price_q1", 2).alias("p67_premium_cutoff")).crossJoin(rest)


def sales_volume_bands(p, oi):
    sold = not_cancelled(oi).groupBy("product_id").agg(_n().alias("num_sold"))
    j = p.select(F.col("id").alias("product_id")).join(sold, "product_id", "left") \
        .select(F.coalesce("num_sold", F.lit(0)).alias("num_sold"))
    s = F.col("num_sold")
    sb = SALES_BAND_LABELS
    b = F.when(s == 0, sb[0]).when(s <= 5, sb[1]).when(s <= 10, sb[2]).otherwise(sb[3])
    return j.groupBy(b.alias("sales_band")).agg(_n().alias("num_products"))


def _return_stats(oi, p, attr: str, min_sales: int):
    j = _items(oi, p, (attr,))
    if attr == "brand":
        j = j.filter(F.col("brand").isNotNull() & (F.col("brand") != ""))
    g = j.groupBy(attr).agg(_n().alias("total_sold"),
                            F.sum(F.when(F.col("status") == "Returned", 1).otherwise(0)).alias("total_returned"))
    return g.filter(F.col("total_sold") >= min_sales).withColumn(
        "return_rate", rnd(F.lit(100.0) * F.col("total_returned") / F.col("total_sold"), 2))


def return_rate_high_volume_brands(oi, p, min_sales: int = 500, top: int = 20, highest: bool = True):
    g = _return_stats(oi, p, "brand", min_sales)
    o = F.desc("return_rate") if highest else F.asc("return_rate")
    return g.orderBy(o, "brand").limit(top)


def return_rate_high_volume_categories(oi, p, min_sales: int = 1000):
    return _return_stats(oi, p, "category", min_sales)


def margin_vs_return_rate(oi, p, min_sales: int = 50):
    j = oi.join(p.select(F.col("id").alias("product_id"), "retail_price", "cost"), "product_id")
    ps = j.groupBy("product_id", "retail_price", "cost").agg(
        _n().alias("total_sold"), rnd(F.lit(100.0) * F.sum(F.when(F.col("status") == "Returned", 1).otherwise(0))
                                     / _n(), 2).alias("return_rate"))
    ps = ps.filter(F.col("total_sold") >= min_sales).withColumn(
        "margin_pct", (F.col("retail_price") - F.col("cost")) / F.col("retail_price"))
    b = bucket("margin_pct", [0.4, 0.55], MARGIN_RETURN_LABELS)
    return ps.groupBy(b.alias("margin_band")).agg(
        _n().alias("num_products"), rnd(F.avg("return_rate"), 2).alias("avg_return_rate"),
        rnd(F.min("return_rate"), 2).alias("min_return_rate"), rnd(F.max("return_rate"), 2).alias("max_return_rate"))


# ---------------------------------------------------------------- V63-V77 (fashion)

def sample_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """First n rows by key (deterministic, TakeOrdered)."""
    return df.orderBy(*(order or df.columns[:1])).limit(n)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column and total rows, one scan, long format."""
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    one = df.agg(_n().alias("__total"), *aggs)
    return one.unpivot(["__total"], list(df.columns), "column_name", "null_count") \
        .withColumnRenamed("__total", "total_rows")


def hierarchy_cardinality(a: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct count of each hierarchy column in one aggregate."""
    return a.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])


def time_span(t: DataFrame) -> DataFrame:
    return t.agg(_n().alias("total_rows"), F.min("t_dat").alias("earliest"), F.max("t_dat").alias("latest"),
                 F.datediff(F.max("t_dat"), F.min("t_dat")).cast("long").alias("span_days"),
                 F.count_distinct("customer_id").alias("unique_customers"),
                 F.count_distinct("article_id").alias("unique_articles"))


def numeric_profile(df: DataFrame, col: str, d: int = 4) -> DataFrame:
    """Count, nulls, min, quartiles, max, mean, std of one column (exact, distributed quartiles)."""
    c = F.col(col)
    one = df.agg(_n().alias("total"), F.count_if(c.isNull()).alias("null_count"), F.min(c).alias("lo"), F.max(c).alias("hi"),
                 F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"))
    return one.crossJoin(quantiles(df, col, [0.25, 0.5, 0.75])).select(  # one row each
        "total", "null_count", rnd("lo", d).alias("min_value"), rnd("q0", d).alias("p25"), rnd("q1", d).alias("median"), rnd("q2", d).alias("p75"),
        rnd("hi", d).alias("max_value"), rnd("mean", d).alias("avg_value"), rnd("std", d).alias("std_value"))


def age_groups(c: DataFrame) -> DataFrame:
    b = bucket("age", [20, 30, 40, 50, 60], AGE_GROUP_LABELS)
    return distribution(c.filter(F.col("age").isNotNull()), "age", b.alias("age_group"), n="n_customers")


def articles_per_index_group(a: DataFrame) -> DataFrame:
    return a.groupBy("index_group_name").agg(_n().alias("n_articles"))


def monthly_sales(t: DataFrame) -> DataFrame:
    return t.groupBy(F.date_format("t_dat", "yyyy-MM").alias("month")).agg(
        _n().alias("n_transactions"), F.count_distinct("customer_id").alias("n_customers"),
        rnd(exact_sum("price"), 2).alias("total_revenue"))


def purchase_frequency_bands(t: DataFrame) -> DataFrame:
    per = t.groupBy("customer_id").agg(_n().alias("n_purchases"))
    b = bucket("n_purchases", [1, 5, 10, 20, 50], FREQUENCY_LABELS,
               right_open=False)
    g = per.groupBy(b.alias("freq_bucket")).agg(_n().alias("n_customers"), F.min("n_purchases").alias("_o"))
    return g.withColumn("pct", share("n_customers")).orderBy("_o").drop("_o")


def channel_share(t: DataFrame) -> DataFrame:
    return distribution(t, "sales_channel_id", n="n_transactions")


def trip_size(t: DataFrame) -> DataFrame:
    per = t.groupBy("customer_id", "t_dat").agg(_n().alias("n_items"))
    b = bucket("n_items", [1, 3, 5, 10], TRIP_LABELS,
               right_open=False)
    g = per.groupBy(b.alias("trip_size")).agg(_n().alias("n_trips"), F.min("n_items").alias("_o"))
    return g.withColumn("pct", share("n_trips")).orderBy("_o").drop("_o")


def age_by_style(t: DataFrame, a: DataFrame, c: DataFrame) -> DataFrame:
    j = t.join(a.select("article_id", "index_group_name"), "article_id") \
        .join(c.filter(F.col("age").isNotNull()).select("customer_id", "age"), "customer_id")
    ag = bucket("age", [25, 35, 50], STYLE_AGE_LABELS)
    g = j.groupBy(ag.alias("age_group"), "index_group_name").agg(_n().alias("n_purchases"))
    return g.withColumn("pct_within_age", share("n_purchases", by=["age_group"]))


def brand_return_check(oi, p, min_sales: int = 500):
    """Product-level sold/returned, rolled up to brand."""
    per = _items(oi, p, ("brand",)).groupBy("product_id", "brand").agg(
        _n().alias("sold"), F.count_if(F.col("status") == "Returned").alias("returned"))
    g = per.groupBy("brand").agg(F.sum("sold").alias("total_sold"), F.sum("returned").alias("total_returned"))
    return g.filter(F.col("total_sold") >= min_sales).withColumn(
        "return_rate", rnd(F.lit(100.0) * F.col("total_returned") / F.col("total_sold"), 2))


def crosstab(df: DataFrame, row: str, col: str, normalize: bool = False) -> DataFrame:
    """Counts per (row, col) in long form; ``normalize`` adds the row percentage."""
    g = df.groupBy(row, col).agg(_n().alias("n"))
    return g.withColumn("row_pct", share("n", by=[row])) if normalize else g


def crosstab_wide(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """V77 as a matrix: one column per given value of ``col`` (values listed, no driver scan)."""
    return df.groupBy(row).pivot(col, list(values)).agg(_n()).na.fill(0)
