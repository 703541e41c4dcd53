"""Customer, session, product and basket features.

All features are aggregates over the fact rows (one shuffle on the entity
key, map-side partial aggregation). "First order / first session per user"
is a ``min(struct(time, id))`` aggregate instead of a per-user window, so a
heavy user is reduced before the shuffle. Quantiles of unbounded columns are
exact and distributed (``functions.quantile``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopframe.functions.baskets import dealt, first_by, item_sets
from shopframe.functions.exprs import days_between, draw, exact_sum, rnd
from shopframe.functions.prefix import row_numbers
from shopframe.functions.quantile import counted_quantiles, quantiles
from shopframe.plans.sessions import as_sessions
from shopframe.session import materialize

STYLE_GROUPS = {"pct_ladieswear": "Ladieswear", "pct_divided": "Divided", "pct_menswear": "Menswear",
                "pct_baby": "Baby/Children", "pct_sport": "Sport"}


def _n() -> Column:
    return F.count(F.lit(1))


def _date(d) -> Column:
    if isinstance(d, Column):
        return d.cast("date")
    if isinstance(d, (dt.date, dt.datetime)):
        d = d.isoformat()[:10]
    return F.lit(d).cast("date")


def _cutoff(cutoff) -> Column:
    """The cutoff as a literal date, or as the scalar of a one-row frame (a subquery that the scan's filters can use)."""
    return cutoff.select(cutoff.columns[0]).scalar().cast("date") if isinstance(cutoff, DataFrame) else _date(cutoff)


def _share(cond: Column) -> Column:
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def _style_aggs(groups=STYLE_GROUPS) -> list[Column]:
    return [_share(F.col("index_group_name") == g).alias(name) for name, g in groups.items()]


# ---------------------------------------------------------------- F1-F10 fashion retail

def customer_features(tx: DataFrame, articles: DataFrame, customers: DataFrame, cutoff,
                      customer_id=None) -> DataFrame:
    """per customer up to ``cutoff`` (inclusive): items, active days, spend, shares, recency, age.

    ``customer_id`` restricts the scan to one customer (the filter reaches the
    parquet scan as a pushed predicate).
    """
    t = tx.filter(F.col("customer_id") == customer_id) if customer_id is not None else tx
    c = _cutoff(cutoff)
    t = t.filter(F.col("t_dat") <= c)
    j = t.join(articles.select("article_id", "index_group_name"), "article_id")
    agg = j.groupBy("customer_id").agg(
        _n().alias("total_items"), F.avg("price").alias("avg_price"), exact_sum("price").alias("monetary"),
        F.count_distinct("t_dat").alias("frequency"), F.max("t_dat").alias("last_purchase"),
        _share(F.col("sales_channel_id") == 2).alias("pct_online"), *_style_aggs())
    out = agg.join(customers.select("customer_id", "age"), "customer_id", "left")
    return out.select("customer_id", "age", "total_items", "frequency", "monetary", "avg_price", "pct_online",
                      *STYLE_GROUPS.keys(), F.datediff(c, F.col("last_purchase")).alias("recency_days"))


def fill_features(df: DataFrame, default_age: int = 30) -> DataFrame:
    """shares and price null -> 0, recency null -> 9999, age null -> median (or 30).

    The median comes from the number of customers of each age; that branch
    needs the keys and ages only, so nothing is stored for it.
    """
    pct = [c for c in df.columns if c.startswith("pct_")]
    med = df.groupBy("age").agg(_n().alias("_n")).agg(F.percentile("age", 0.5, F.col("_n")).alias("_med"))
    out = df.na.fill(0.0, subset=pct + ["avg_price"]).na.fill(9999, subset=["recency_days"])
    out = out.crossJoin(med).withColumn(
        "age", F.coalesce(F.col("age"), F.floor(F.coalesce("_med", F.lit(float(default_age)))))).drop("_med")
    return out


def sample_customers(df: DataFrame, n: int | None, seed: int = 42, key: str = "customer_id") -> DataFrame:
    """a fixed-size sample without replacement, stable for a seed (ordered by a keyed draw)."""
    if not n:
        return df
    return df.orderBy(draw(key, seed), key).limit(n)


def latest_cutoff(tx: DataFrame) -> DataFrame:
    """one row with the newest transaction date (null when empty)."""
    return tx.agg(F.max("t_dat").alias("cutoff"))


def baskets(tx: DataFrame, articles: DataFrame, clusters: DataFrame | None = None,
            cluster_id=None, min_items: int = 2) -> DataFrame:
    """per (customer, day) the sorted distinct product groups, only baskets of >= 2.

    With ``clusters`` the cluster id is kept as a column (all clusters in one
    plan); ``cluster_id`` keeps one cluster.
    """
    j = tx.join(articles.select("article_id", "product_group_name"), "article_id")
    keys = ["customer_id", "t_dat"]
    if clusters is not None:
        cl = clusters.select("customer_id", "cluster_id")
        if cluster_id is not None:
            cl = cl.filter(F.col("cluster_id") == cluster_id)
        j = j.join(cl, "customer_id")
        keys = ["cluster_id"] + keys
    return item_sets(j, keys, "product_group_name", min_size=min_items)


def buy_labels(tx: DataFrame, cutoff, window: int = 7) -> DataFrame:
    """distinct customers buying in (cutoff, cutoff + window]."""
    c = _cutoff(cutoff)
    return tx.filter((F.col("t_dat") > c) & (F.col("t_dat") <= F.date_add(c, window))) \
        .select("customer_id").distinct()


def purchase_dataset(tx, articles, customers, cutoff=None, window: int = 7) -> DataFrame:
    """filled F1 features + ``will_buy``; default cutoff = newest date - window (kept lazy)."""
    if cutoff is None:
        cutoff = tx.agg(F.date_sub(F.max("t_dat"), window).alias("cutoff"))
    feats = fill_features(customer_features(tx, articles, customers, cutoff))
    lab = buy_labels(tx, cutoff, window).withColumn("will_buy", F.lit(1))
    return feats.join(lab, "customer_id", "left").withColumn("will_buy", F.coalesce("will_buy", F.lit(0)))


def style_dna(tx, articles, customers, min_items: int = 3) -> DataFrame:
    """F8: style shares, online share, mean price for customers with >= min_items and known age."""
    j = tx.join(articles.select("article_id", "index_group_name"), "article_id")
    cs = j.groupBy("customer_id").agg(
        _n().alias("total_items"), F.avg("price").alias("avg_price"), *_style_aggs(),
        _share(F.col("sales_channel_id") == 2).alias("pct_online"))
    cs = cs.filter(F.col("total_items") >= min_items)
    return cs.join(customers.filter(F.col("age").isNotNull()).select("customer_id", "age"), "customer_id")


def notebook_cutoff(tx: DataFrame, upper: str = "2021-01-01", window: int = 7) -> DataFrame:
    """F9 cutoff: newest date before ``upper`` minus ``window`` days (one row)."""
    return tx.filter(F.col("t_dat") < _date(upper)).agg(F.date_sub(F.max("t_dat"), window).alias("cutoff"))


def purchase_features_nb(tx, articles, upper: str = "2021-01-01", window: int = 7) -> DataFrame:
    """features strictly before the cutoff, label = any purchase at or after it.

    Frequency counts item rows; there is no sport share (notebook variant).
    """
    c = notebook_cutoff(tx, upper, window)
    j = tx.crossJoin(c).filter(F.col("t_dat") < F.col("cutoff")) \
        .join(articles.select("article_id", "index_group_name"), "article_id")
    groups = {k: v for k, v in STYLE_GROUPS.items() if k != "pct_sport"}
    feats = j.groupBy("customer_id", "cutoff").agg(
        F.max("t_dat").alias("_last"), _n().alias("frequency"), exact_sum("price").alias("monetary"),
        F.avg("price").alias("avg_price"), *_style_aggs(groups),
        _share(F.col("sales_channel_id") == 2).alias("pct_online"))
    feats = feats.withColumn("recency_days", F.datediff("cutoff", "_last")).drop("_last", "cutoff")
    buyers = tx.crossJoin(c).filter(F.col("t_dat") >= F.col("cutoff")).select("customer_id").distinct() \
        .withColumn("will_buy", F.lit(1))
    return feats.join(buyers, "customer_id", "left").withColumn("will_buy", F.coalesce("will_buy", F.lit(0)))


# ---------------------------------------------------------------- F11-F23 shop users

def _nc(oi):
    return oi.filter(F.col("status") != "Cancelled")


def rfm(oi: DataFrame, ref_date) -> DataFrame:
    """recency (days), frequency (distinct orders), monetary, order value; cancelled excluded."""
    g = _nc(oi).groupBy("user_id").agg(
        F.count_distinct("order_id").alias("frequency"), exact_sum("sale_price").alias("monetary"),
        F.max("created_at").alias("last_purchase_date"))
    return g.withColumn("avg_order_value", F.col("monetary") / F.col("frequency")) \
        .withColumn("recency", F.datediff(_date(ref_date), F.to_date("last_purchase_date")).cast("long"))


def session_stats(ev: DataFrame) -> DataFrame:
    """per (user, session): depth, purchase / cart flags, product views."""
    return as_sessions(ev).filter(F.col("user_id").isNotNull()).select(
        "user_id", "session_id", F.col("depth").alias("session_depth"), (F.col("n_purchase") > 0).cast("int").alias("has_purchase"),
        (F.col("n_cart") > 0).cast("int").alias("has_cart"), F.col("n_product").alias("products_viewed"))


def user_behaviour(sessions: DataFrame) -> DataFrame:
    """sessions, mean depth and views, cart abandon = (carts - purchases) / carts (0 if no cart)."""
    return sessions.groupBy("user_id").agg(
        F.count_distinct("session_id").alias("total_sessions"),
        F.avg("session_depth").alias("avg_session_depth"), F.avg("products_viewed").alias("avg_products_viewed"),
        F.when(F.sum("has_cart") > 0, (F.sum("has_cart") - F.sum("has_purchase")).cast("double") / F.sum("has_cart"))
         .otherwise(F.lit(0.0)).alias("cart_abandon_rate"))


RFM9 = ["recency", "frequency", "monetary", "avg_order_value", "total_sessions", "avg_session_depth",
        "avg_products_viewed", "cart_abandon_rate", "conversion_rate"]


def rfm_behaviour_9(oi: DataFrame, ev: DataFrame, ref_ts) -> DataFrame:
    """RFM joined to behaviour; recency = whole days to ``ref_ts``; conversion clipped at 1."""
    r = _nc(oi).groupBy("user_id").agg(
        F.max("created_at").alias("last_purchase_date"), F.count_distinct("order_id").alias("frequency"),
        exact_sum("sale_price").alias("monetary"))
    b = user_behaviour(session_stats(ev))
    j = r.join(b, "user_id")
    ref = F.lit(ref_ts).cast("timestamp_ntz")
    return j.select(
        "user_id", F.floor(days_between(ref, F.col("last_purchase_date"))).alias("recency"), "frequency",
        "monetary", (F.col("monetary") / F.col("frequency")).alias("avg_order_value"), "total_sessions",
        "avg_session_depth", "avg_products_viewed", "cart_abandon_rate",
        F.least(F.lit(1.0), F.col("frequency") / F.col("total_sessions")).alias("conversion_rate"))


def rfm_behaviour_9_fixed(oi: DataFrame, ev: DataFrame, ref_date="2024-01-01") -> DataFrame:
    """recency to a fixed date, abandon = share of sessions with a cart, conversion unclipped."""
    r = _nc(oi).groupBy("user_id").agg(
        F.max("created_at").alias("last_purchase_date"), F.count_distinct("order_id").alias("frequency"),
        exact_sum("sale_price").alias("monetary"))
    s = session_stats(ev)
    b = s.groupBy("user_id").agg(
        F.count_distinct("session_id").alias("total_sessions"), F.avg("session_depth").alias("avg_session_depth"),
        F.avg("products_viewed").alias("avg_products_viewed"), F.avg("has_cart").alias("cart_abandon_rate"))
    j = r.join(b, "user_id")
    return j.select(
        "user_id", F.datediff(_date(ref_date), F.to_date("last_purchase_date")).cast("long").alias("recency"),
        "frequency", "monetary", (F.col("monetary") / F.col("frequency")).alias("avg_order_value"),
        "total_sessions", "avg_session_depth", "avg_products_viewed", "cart_abandon_rate",
        F.try_divide(F.col("frequency").cast("double"), F.nullif(F.col("total_sessions"), F.lit(0)))
         .alias("conversion_rate"))


def customer_360(u: DataFrame, o: DataFrame, oi: DataFrame, p: DataFrame) -> DataFrame:
    """F16: orders, spend, distinct categories, return rate per user."""
    j = u.select(F.col("id").alias("user_id"), "age").join(o.select("order_id", "user_id"), "user_id") \
        .join(oi.select("order_id", "product_id", "sale_price", "status"), "order_id") \
        .join(p.select(F.col("id").alias("product_id"), "category"), "product_id")
    g = j.groupBy("user_id", "age").agg(
        F.count_distinct("order_id").alias("total_orders"), exact_sum("sale_price").alias("total_spend"),
        F.count_distinct("category").alias("unique_categories"),
        (F.sum(F.when(F.col("status") == "Returned", 1).otherwise(0)) * 1.0 / _n()).alias("return_rate"))
    return g.filter(F.col("total_orders") > 0)


def first_order_features(oi: DataFrame, p: DataFrame, by_item: bool = False) -> DataFrame:
    """features of each user's first non-cancelled order.

    ``by_item=False``: orders ranked by their earliest item; the order's lines
    are joined on order id; gives items, categories, smallest department.
    ``by_item=True``: the order of the earliest item; lines joined on order
    and user; gives value, items and categories.
    """
    pp = p.select(F.col("id").alias("product_id"), "category", "department")
    if not by_item:
        per = _nc(oi).groupBy("user_id", "order_id").agg(F.min("created_at").alias("t0"))
        fo = first_by(per, "user_id", ["t0", "order_id"], []).select(F.col("user_id").alias("fuser"), "order_id")
        j = fo.join(oi.select("order_id", "product_id"), "order_id").join(pp, "product_id")
        return j.groupBy(F.col("fuser").alias("user_id")).agg(
            _n().alias("first_order_num_items"), F.count_distinct("category").alias("first_order_num_categories"),
            F.min("department").alias("first_order_department"))
    fo = first_by(_nc(oi), "user_id", ["created_at", "order_id"], []).select("user_id", "order_id")
    j = fo.join(oi.select("user_id", "order_id", "product_id", "sale_price"), ["user_id", "order_id"]) \
        .join(pp, "product_id")
    return j.groupBy("user_id").agg(
        exact_sum("sale_price").alias("first_order_value"), _n().alias("first_order_num_items"),
        F.count_distinct("category").alias("first_order_num_categories"))


def first_session_features(ev: DataFrame, full: bool = True) -> DataFrame:
    """the user's first session (earliest start): depth, views, cart, purchase, traffic source."""
    values = ["depth", "n_product"] + (["n_cart", "n_purchase", "traffic_source"] if full else [])
    s = first_by(as_sessions(ev).filter(F.col("user_id").isNotNull()), "user_id", ["session_start", "session_id"], values)
    cols = [F.col("depth").alias("first_session_depth"), F.col("n_product").alias("first_session_products_viewed")]
    if full:
        cols += [(F.col("n_cart") > 0).cast("int").alias("first_session_carted"),
                 (F.col("n_purchase") > 0).cast("int").alias("first_session_purchased"),
                 F.col("traffic_source").alias("first_traffic_source")]
    return s.select("user_id", *cols)


def repeat_buyer_label(oi: DataFrame) -> DataFrame:
    """1 when a user has a second non-cancelled order."""
    return _nc(oi).groupBy("user_id").agg(
        F.when(F.count_distinct("order_id") >= 2, 1).otherwise(0).alias("is_repeat_buyer"))


def repeat_dataset(oi, p, ev, u) -> DataFrame:
    """first order x first session x user x repeat label (inner joins)."""
    us = u.select(F.col("id").alias("user_id"), "age", "gender", "country")
    return first_order_features(oi, p, by_item=True).join(first_session_features(ev), "user_id") \
        .join(us, "user_id").join(repeat_buyer_label(oi), "user_id")


def vip_dataset(oi, p, ev, u, labels: DataFrame) -> DataFrame:
    """first order x user, left join first session (null -> 0), inner join a VIP label frame."""
    us = u.select(F.col("id").alias("user_id"), "age", "gender", "country", "traffic_source")
    fs = first_session_features(ev, full=False)
    j = first_order_features(oi, p).join(us, "user_id").join(fs, "user_id", "left")
    j = j.withColumn("first_session_depth", F.coalesce("first_session_depth", F.lit(0))) \
        .withColumn("first_session_products_viewed", F.coalesce("first_session_products_viewed", F.lit(0)))
    return j.join(labels.select("user_id", "is_vip"), "user_id")


def lookalike_dataset(oi, p, ev, u, labels: DataFrame | None = None) -> DataFrame:
    """first order (earliest item) x first session (inner) x user [x label]."""
    fo = first_order_features(oi, p, by_item=True).drop("first_order_value")
    fs = first_session_features(ev).drop("first_session_purchased")
    us = u.select(F.col("id").alias("user_id"), "age", "gender", "country")
    j = fo.join(fs, "user_id").join(us, "user_id")
    return j.join(labels.select("user_id", "is_vip"), "user_id") if labels is not None else j


RETURN_STATUSES = ("Complete", "Returned", "Shipped", "Processing")


def return_dataset(oi, p, u) -> DataFrame:
    """item-level return features, label = Returned, among the four final statuses."""
    j = oi.filter(F.col("status").isin(*RETURN_STATUSES)) \
        .join(p.select(F.col("id").alias("product_id"), "category", "department", "brand"), "product_id") \
        .join(u.select(F.col("id").alias("user_id"), "age", "gender", "country", "traffic_source"), "user_id")
    return j.select("order_id", "line_no", "sale_price", "status", "category", "department", "brand", "age",
                    "gender", "country", "traffic_source",
                    (F.col("status") == "Returned").cast("int").alias("is_returned"))


# ---------------------------------------------------------------- F24-F33 products and baskets

def product_margin(p: DataFrame) -> DataFrame:
    """margin % (4 digits) and amount, for priced products."""
    x = p.filter((F.col("retail_price") > 0) & (F.col("cost") > 0))
    return x.select(F.col("id").alias("product_id"), "category", "department", "retail_price", "cost",
                    rnd(F.try_divide(F.col("retail_price") - F.col("cost"), F.nullif("retail_price", F.lit(0))), 4)
                    .alias("margin_pct"), (F.col("retail_price") - F.col("cost")).alias("margin_amount"))


def product_sales(p: DataFrame, oi: DataFrame) -> DataFrame:
    """units sold per product (non-cancelled), 0 when never sold."""
    s = _nc(oi).groupBy("product_id").agg(_n().alias("num_sold"))
    return p.select(F.col("id").alias("product_id")).join(s, "product_id", "left") \
        .withColumn("num_sold", F.coalesce("num_sold", F.lit(0)))


def vip_by_percentile(oi: DataFrame, p: float = 0.75) -> DataFrame:
    """users whose non-cancelled spend exceeds the p-th percentile of user spend (exact, distributed)."""
    spend = materialize(_nc(oi).groupBy("user_id").agg(exact_sum("sale_price").alias("total_spend")))
    return spend.crossJoin(quantiles(spend, "total_spend", [p])).filter(F.col("total_spend") > F.col("q0")) \
        .select("user_id", "total_spend")


def user_category_baskets(oi, p, vip: DataFrame, min_items: int = 2) -> DataFrame:
    """category set per VIP user (>= 2 categories)."""
    j = _nc(oi).join(vip.select("user_id"), "user_id") \
        .join(p.select(F.col("id").alias("product_id"), "category"), "product_id") \
        .filter(F.col("category").isNotNull())
    return item_sets(j, "user_id", "category", min_size=min_items)


def basket_size_distribution(sets: DataFrame, items: str = "items") -> DataFrame:
    """baskets per basket size."""
    return sets.groupBy(F.size(items).alias("basket_size")).agg(_n().alias("n_baskets"))


def order_category_baskets(oi, p, department: str | None = None, min_items: int = 2) -> DataFrame:
    """category set per order (>= 2), optionally within one department."""
    j = _nc(oi).join(p.select(F.col("id").alias("product_id"), "department", "category"), "product_id")
    if department is not None:
        j = j.filter(F.col("department") == department)
    return item_sets(j, "order_id", "category", min_size=min_items)


def returned_baskets(oi, p, min_items: int = 2) -> DataFrame:
    """categories of an order's returned items (>= 2)."""
    j = oi.filter(F.col("status") == "Returned").join(
        p.select(F.col("id").alias("product_id"), "category"), "product_id")
    return item_sets(j, "order_id", "category", min_size=min_items)


def product_id_baskets(fo: DataFrame, min_len: int = 2, parts: int = 1) -> DataFrame:
    """product ids per order with their multiplicity (duplicates count toward the length).

    Lines are first counted per (order, product), so a basket is a sorted array
    of (product_id, n) - bounded by the distinct products of an order rather
    than by its number of lines. ``n_lines`` is the length with duplicates.
    ``parts`` tasks share the orders.
    """
    c = dealt(fo.select("order_id", "product_id"), "order_id", parts).groupBy("order_id", "product_id").agg(_n().alias("n"))
    g = c.groupBy("order_id").agg(F.sort_array(F.collect_list(F.struct("product_id", "n"))).alias("items"),
                                  F.sum("n").alias("n_lines"))
    return g.filter(F.col("n_lines") >= min_len)


def majority_tier(oi: DataFrame, tiers: DataFrame) -> DataFrame:
    """per order the most frequent price tier; ties go to the first tier name."""
    j = _nc(oi).select("order_id", "product_id").join(tiers.select("product_id", "price_tier"), "product_id")
    c = j.groupBy("order_id", "price_tier").agg(_n().alias("cnt"))
    m = c.groupBy("order_id").agg(F.min(F.struct((-F.col("cnt")).alias("k"), "price_tier")).alias("_m"))
    return m.select("order_id", F.col("_m.price_tier").alias("majority_tier"))


def category_segment_labels(oi, p, segments: DataFrame, min_items: int = 2) -> DataFrame:
    """F32: per order the set of ``category (segment)`` labels (>= 2)."""
    j = _nc(oi).join(p.select(F.col("id").alias("product_id"), "category"), "product_id") \
        .join(segments.select("product_id", "segment"), "product_id")
    lab = F.concat(F.col("category"), F.lit(" ("), F.col("segment"), F.lit(")"))
    return item_sets(j, "order_id", lab, min_size=min_items)


def log_features(df: DataFrame, price: str = "price", weight: str = "weight_g") -> DataFrame:
    """zero weight -> 1, then log1p of price and weight."""
    w = F.when(F.col(weight) == 0, F.lit(1.0)).otherwise(F.col(weight))
    return df.withColumn(weight, w).withColumn(f"log_{price}", F.log1p(price)) \
        .withColumn(f"log_{weight}", F.log1p(weight))


# ---------------------------------------------------------------- F34-F40 preparation for models

def label_encode(df: DataFrame, cols: Sequence[str], unknown: str = "Unknown") -> DataFrame:
    """each text column -> index in sorted order of its values (null -> ``unknown``).

    The dictionary is a distinct-values frame joined back (bounded by the
    number of distinct values), not a driver-side map.
    """
    out = df
    for c in cols:
        filled = F.coalesce(F.col(c).cast("string"), F.lit(unknown))
        out = out.withColumn(c, filled)
        vocab = row_numbers(out.select(c).distinct(), [c], f"{c}_enc").withColumn(f"{c}_enc", (F.col(f"{c}_enc") - 1).cast("int"))
        out = out.join(vocab, c, "left")
    return out


def one_hot_pipeline(cols: Sequence[str]):
    """StringIndexer(keep) + OneHotEncoder(dropLast) per column; unseen value -> all zeros."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep", stringOrderType="alphabetAsc")
           for c in cols]
    # the indexer gives unseen values the last index, which the encoder drops
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_vec" for c in cols], dropLast=True)
    return Pipeline(stages=idx + [ohe])


def impute(df: DataFrame, median_cols: Sequence[str] = (), text_cols: Sequence[str] = (),
           zero_cols: Sequence[str] = (), drop_null: bool = False, unknown: str = "Unknown") -> DataFrame:
    """numeric -> median, text -> ``unknown``, listed -> 0, optionally drop remaining nulls."""
    out = df
    if median_cols:
        for c in median_cols:
            out = out.crossJoin(counted_quantiles(df, c, [0.5]).select(F.col("q0").alias(f"_m_{c}")))
            out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"_m_{c}"))).drop(f"_m_{c}")
    for c in text_cols:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(unknown)))
    if zero_cols:
        out = out.na.fill(0, subset=list(zero_cols))
    return out.dropna() if drop_null else out


def scaling_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """one row with mean and population std of each column."""
    return df.agg(*[F.avg(c).alias(f"{c}__mean") for c in cols], *[F.stddev_pop(c).alias(f"{c}__std") for c in cols])


def standardize(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None,
                suffix: str = "") -> DataFrame:
    """z-score with the population std (constant column -> 0)."""
    st = stats if stats is not None else scaling_stats(df, cols)
    out = df.crossJoin(st)
    for c in cols:
        z = F.try_divide(F.col(c) - F.col(f"{c}__mean"), F.nullif(F.col(f"{c}__std"), F.lit(0.0)))
        out = out.withColumn(c + suffix, F.coalesce(z, F.lit(0.0)))
    return out.drop(*[f"{c}__mean" for c in cols], *[f"{c}__std" for c in cols])


def unstandardize(df: DataFrame, cols: Sequence[str], stats: DataFrame) -> DataFrame:
    """F37 inverse: x = z * std + mean."""
    out = df.crossJoin(stats)
    for c in cols:
        out = out.withColumn(c, F.col(c) * F.col(f"{c}__std") + F.col(f"{c}__mean"))
    return out.drop(*[f"{c}__mean" for c in cols], *[f"{c}__std" for c in cols])


def assert_standardized(df: DataFrame, cols: Sequence[str], tol: float = 0.01) -> DataFrame:
    """per column |mean| < tol and |std - 1| < tol, plus the row count (one pass for all columns)."""
    one = df.agg(_n().alias("n_rows"), *[g(c).alias(f"{n}_{i}") for i, c in enumerate(cols) for n, g in (("m", F.avg), ("s", F.stddev_pop))])
    out = one.select("n_rows", F.stack(F.lit(len(cols)), *[x for i, c in enumerate(cols) for x in (F.lit(c), F.col(f"m_{i}"), F.col(f"s_{i}"))])
                     .alias("column_name", "mean", "std")).select("column_name", "mean", "std", "n_rows")
    return out.withColumn("ok", (F.abs("mean") < tol) & (F.abs(F.col("std") - 1) < tol))


def minmax_profile(df: DataFrame, segment: str, cols: Sequence[str],
                   invert: Sequence[str] = ("recency", "cart_abandon_rate"), row_level: bool = False) -> DataFrame:
    """features scaled to 0-1 over all rows (inverted where lower is better), mean per segment."""
    mm = df.agg(*[F.min(c).alias(f"{c}__lo") for c in cols], *[F.max(c).alias(f"{c}__hi") for c in cols])
    out = df.crossJoin(mm)
    for c in cols:
        s = F.try_divide(F.col(c) - F.col(f"{c}__lo"), F.nullif(F.col(f"{c}__hi") - F.col(f"{c}__lo"), F.lit(0)))
        out = out.withColumn(c, (F.lit(1.0) - s) if c in invert else s)
    out = out.drop(*[f"{c}__lo" for c in cols], *[f"{c}__hi" for c in cols])
    return out if row_level else out.groupBy(segment).agg(*[F.avg(c).alias(c) for c in cols])


def describe_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per feature (long format).

    One scan of the features, stored as (feature, value); the quartiles are
    exact and distributed over the values.
    """
    long = df.select(F.stack(F.lit(len(cols)), *[x for c in cols for x in (F.lit(c), F.col(c).cast("double"))]).alias("feature", "value"))
    long = materialize(long)
    stats = long.groupBy("feature").agg(F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                        F.min("value").alias("min"), F.max("value").alias("max"))
    q = quantiles(long, "value", [0.25, 0.5, 0.75], ["feature"])
    return stats.join(q, "feature").select("feature", "count", "mean", "std", "min", F.col("q0").alias("p25"), F.col("q1").alias("p50"),
                                           F.col("q2").alias("p75"), "max")
