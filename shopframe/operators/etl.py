"""Building the warehouse tables from operational sources.

Every random choice of the original load is a deterministic keyed draw
(``functions.exprs.draw``), so a rerun - or a retried task - produces the
same rows, and SQL can reproduce them. Nothing is collected: samples of
products per store are generated per store from a permutation (no store x
product cross product), keys are distributed row numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopframe.functions.baskets import first_by
from shopframe.functions.exprs import draw, rnd, padded
from shopframe.functions.prefix import row_numbers
from shopframe.functions.quantile import group_quantiles


def _n() -> Column:
    return F.count(F.lit(1))


# ---------------------------------------------------------------- sources as the load sees them

def source_orders(t) -> DataFrame:
    """Orders with the buyer's person id, city and state (city = nation, state = region)."""
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    c = t["customer"].select("c_custkey", "c_nationkey")
    n = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    r = t["region"].select("r_regionkey", "r_name")
    geo = F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey, "left"))  # nations: bounded dimension
    return o.join(c, o.o_custkey == c.c_custkey).join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left") \
        .select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_unique_id"),
                F.col("n_name").alias("city"), F.col("r_name").alias("state"), F.col("o_orderdate").alias("ts"))


def source_items(t) -> DataFrame:
    li = t["lineitem"]
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                     (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))


def source_products(t) -> DataFrame:
    p = t["part"]
    return p.select(F.col("p_partkey").alias("product_id"), F.lower("p_type").alias("category_name"),
                    (F.col("p_size") * F.lit(100.0)).alias("weight_g"), F.col("p_size").alias("length_cm"),
                    (F.col("p_size") % 7 + 1).alias("height_cm"),
                    F.when(F.col("p_partkey") % 13 == 0, F.lit(None)).otherwise(F.col("p_size") % 5 + 10)
                    .alias("width_cm"))


def source_translation(t) -> DataFrame:
    """Category translation derived from the part types (STANDARD left untranslated)."""
    return t["part"].select(F.lower("p_type").alias("category_name")).distinct() \
        .filter(F.col("category_name") != "standard") \
        .withColumn("category_name_english", F.initcap("category_name"))


# ---------------------------------------------------------------- E1-E7

def orders_with_customer(orders: DataFrame) -> DataFrame:
    """(already joined in ``source_orders``) order, person id, city, state."""
    return orders.select("order_id", "customer_unique_id", "city", "state", "ts")


def top_cities(orders: DataFrame, n: int = 30) -> DataFrame:
    """The n (city, state) pairs with most orders; ties by name."""
    return orders.groupBy("city", "state").agg(_n().alias("n_orders")) \
        .orderBy(F.desc("n_orders"), "city", "state").limit(n)


def restrict_to_cities(orders: DataFrame, cities: DataFrame) -> DataFrame:
    """Orders in the kept cities (semi join on a small city list)."""
    return orders.join(F.broadcast(cities.select("city", "state")), ["city", "state"], "left_semi")


def items_of_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items of kept orders."""
    return items.join(orders.select("order_id"), "order_id", "left_semi")


def drop_ghost_orders(orders: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """E5: orders having at least one item, and a one-row count of those dropped."""
    keep = orders.join(items.select("order_id"), "order_id", "left_semi")
    dropped = orders.join(items.select("order_id"), "order_id", "left_anti").agg(_n().alias("n_dropped"))
    return keep, dropped


def first_record_per_customer(orders: DataFrame) -> DataFrame:
    """One row per person, taken from the earliest order (ties by order id)."""
    return first_by(orders, "customer_unique_id", ["ts", "order_id"], ["city", "state"])


def allocate_stores(cities: DataFrame, n: int = 100) -> DataFrame:
    """At least one store per city, the rest in proportion to orders (largest remainder).

    ``cities``: city, state, n_orders (a short list). Deterministic replacement
    of the weighted random draw. Output: one row per store (city, state, store_no).
    """
    tot = cities.agg(F.sum("n_orders").alias("_tot"), _n().alias("_k"))
    x = cities.crossJoin(tot).withColumn("_extra", F.greatest(F.lit(n) - F.col("_k"), F.lit(0)))
    x = x.withColumn("_quota", F.col("_extra") * F.col("n_orders") / F.col("_tot")) \
        .withColumn("_base", F.floor("_quota")).withColumn("_frac", F.col("_quota") - F.col("_base"))
    left = x.agg((F.first("_extra") - F.sum("_base")).alias("_left"))
    w = Window.orderBy(F.desc("_frac"), F.desc("n_orders"), "city", "state")  # over the city list only
    x = x.crossJoin(left).withColumn("_r", F.row_number().over(w))
    x = x.withColumn("n_stores", 1 + F.col("_base") + F.when(F.col("_r") <= F.col("_left"), 1).otherwise(0))
    return x.select("city", "state", "n_orders", "n_stores",
                    F.explode(F.sequence(F.lit(1), F.col("n_stores").cast("int"))).alias("store_no"))


# ---------------------------------------------------------------- E8-E12

def order_features(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Heaviest product and mean item price per order (left joins)."""
    f = items.join(products.select("product_id", "weight_g"), "product_id", "left") \
        .groupBy("order_id").agg(F.max("weight_g").alias("max_weight"), F.avg("price").alias("avg_price"))
    return orders.join(f, "order_id", "left")


def shift_order_dates(of: DataFrame, ts: str = "ts", key: str = "order_id") -> DataFrame:
    """Light (< 1000 g) weekday orders move to Sat/Sun with chance .6; then light orders with
    mean price >= 100 move to a day 1-28 of Nov/Dec with chance .5. Unknown weight: unchanged."""
    wd = (F.dayofweek(ts) + 5) % 7  # Monday = 0 ... Sunday = 6
    light = F.col("max_weight") < 1000
    target = F.when(draw(key, 22) < 0.5, 5).otherwise(6)
    move1 = light & (wd < 5) & (draw(key, 21) < 0.60)
    t1 = F.when(move1, F.col(ts) + F.make_dt_interval((target - wd).cast("int"))).otherwise(F.col(ts))
    move2 = light & (F.col("avg_price") >= 100) & (draw(key, 23) < 0.50)
    month = F.when(draw(key, 24) < 0.5, 11).otherwise(12)
    day = (F.floor(draw(key, 25) * 28) + 1).cast("int")
    t2 = F.make_timestamp_ntz(F.year(t1), month, day, F.hour(t1), F.minute(t1), F.second(t1))
    out = F.when(F.col("max_weight").isNull(), F.col(ts)).when(move2, t2).otherwise(t1)
    return of.withColumn("shifted_ts", out)


def surrogate_keys(df: DataFrame, key: Sequence[str] | str, out: str = "sk") -> DataFrame:
    """1..n in sorted key order over the distinct keys (distributed, no single-partition window)."""
    keys = [key] if isinstance(key, str) else list(key)
    return row_numbers(df.select(*keys).distinct(), keys, out)


def median_price(items: DataFrame) -> DataFrame:
    """Exact median item price per product."""
    return group_quantiles(items, ["price"], [0.5], ["product_id"]).withColumnRenamed("price_q0", "median_price")


def dim_product_etl(products: DataFrame, translation: DataFrame, items: DataFrame) -> DataFrame:
    """English category (fallback: source name, then 'unknown'), ``cat #0001`` names,
    ``LxHxW cm`` size (null -> 0), integer weight, median price rounded to 2 (null -> 0)."""
    j = products.join(translation, "category_name", "left") \
        .join(median_price(items), "product_id", "left")
    cat = F.coalesce("category_name_english", "category_name", F.lit("unknown"))
    # number within category, distributed: a category holding most products still spans many tasks
    j = row_numbers(j.withColumn("category", cat), ["product_id"], "_no", by=["category"])
    size = F.concat_ws("x", *[F.coalesce(F.col(c).cast("int"), F.lit(0)).cast("string")
                              for c in ("length_cm", "height_cm", "width_cm")])
    return j.select("product_id", F.concat(F.col("category"), F.lit(" #"),
                                           padded(F.col("_no"), 4)).alias("description"),
                    F.concat(size, F.lit(" cm")).alias("size"),
                    F.coalesce(F.col("weight_g").cast("int"), F.lit(0)).alias("weight_g"),
                    F.coalesce(rnd("median_price", 2), F.lit(0.0)).alias("price"))


# ---------------------------------------------------------------- E13-E19

def first_order_date(orders: DataFrame) -> DataFrame:
    """Earliest order time per person."""
    return orders.groupBy("customer_unique_id").agg(F.min("ts").alias("first_order_ts"))


def dim_customer_base(first: DataFrame, orders: DataFrame, city_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Id, city key, first order date; and the number of people lost for an unknown city."""
    fo = first_order_date(orders)
    j = first.join(fo, "customer_unique_id")
    keep = j.join(city_keys, ["city", "state"])
    lost = j.join(city_keys.select("city", "state"), ["city", "state"], "left_anti").agg(_n().alias("n_lost"))
    return keep.select("customer_unique_id", "city_sk", "first_order_ts"), lost


def subtype_tables(base: DataFrame, subtypes: DataFrame, guides: int = 20) -> tuple[DataFrame, DataFrame]:
    """Tourist table (guide from a pool, since first order) and postal table (zip-based address)."""
    j = base.join(subtypes.select(F.col("customer_id").alias("customer_unique_id"), "is_tourist", "is_postal"),
                  "customer_unique_id")
    guide = F.concat(F.lit("Guide "), F.lpad((F.col("customer_unique_id") % guides + 1).cast("string"), 2, "0"))
    tourist = j.filter("is_tourist").select("customer_unique_id", guide.alias("guide"),
                                            F.col("first_order_ts").alias("since"))
    postal = j.filter("is_postal").select(
        "customer_unique_id", F.concat(F.lit("PO Box "), (F.lit(1000) + F.col("customer_unique_id") % 9000)
                                       .cast("string")).alias("postal_address"))
    return tourist, postal


def store_inventory(stores: DataFrame, products: DataFrame, lo: int = 400, hi: int = 600,
                    qlo: int = 10, qhi: int = 200, prime: int = 1000003) -> DataFrame:
    """Every store stocks lo..hi distinct products (quantity qlo..qhi); products left out get one store.

    A store's sample is the permutation i -> (prime * i + offset) mod P of the
    numbered products, i < k: distinct products, generated per store, so the
    work is the output size (no store x product product).
    ``stores``: store_sk; ``products``: product_id, product_sk (1..P).
    """
    P = products.agg(F.count(F.lit(1)).alias("_P"))
    s = stores.crossJoin(P)  # one-row count
    k = F.least(F.col("_P"), (F.lit(lo) + F.floor(draw("store_sk", 31) * (hi - lo + 1))).cast("long"))
    s = s.withColumn("_k", k).withColumn("_off", F.floor(draw("store_sk", 32) * F.col("_P")).cast("long"))
    s = s.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1)))
    s = s.withColumn("product_sk", F.pmod(F.lit(prime) * F.col("_i") + F.col("_off"), F.col("_P")) + 1)
    stocked = s.join(products.select("product_id", "product_sk"), "product_sk").select("store_sk", "product_id")
    n_stores = stores.agg(F.count(F.lit(1)).alias("_S"))
    missing = products.join(stocked.select("product_id"), "product_id", "left_anti").crossJoin(n_stores) \
        .select((F.pmod(F.col("product_sk"), F.col("_S")) + 1).alias("store_sk"), "product_id")
    allrows = stocked.unionByName(missing)
    qty = (F.lit(qlo) + F.floor(draw(F.concat_ws(":", "store_sk", "product_id"), 33) * (qhi - qlo + 1)))
    return allrows.withColumn("stock_qty", qty.cast("int"))


def fact_orders_base(orders: DataFrame, customers: DataFrame, alert: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """Orders of loaded customers; dropped count and an alert flag above ``alert`` share."""
    keep = orders.join(customers.select("customer_unique_id"), "customer_unique_id", "left_semi")
    dropped = orders.join(customers.select("customer_unique_id"), "customer_unique_id", "left_anti")
    rep = dropped.agg(_n().alias("n_dropped")).crossJoin(orders.agg(_n().alias("n_orders"))) \
        .withColumn("alert", F.col("n_dropped") > F.lit(alert) * F.col("n_orders"))
    return keep.select("order_id", "ts", "customer_unique_id"), rep


def order_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per (order, product): quantity = item count, price = mean (2 digits), date from the order."""
    g = items.groupBy("order_id", "product_id").agg(_n().alias("quantity"), rnd(F.avg("price"), 2).alias("price"))
    return g.join(orders.select("order_id", "ts"), "order_id")


# ---------------------------------------------------------------- E20-E24

def fk_report(edges: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """For each (name, child, child_key, parent, parent_key) the number of distinct orphan keys.

    Edges that share a child table are checked in one pass over it: left joins
    to each parent's distinct keys (unique, so no row is multiplied), then one
    aggregate counts the distinct keys that found no parent.
    """
    groups: dict[int, list] = {}
    for e in edges:
        groups.setdefault(id(e[1]), []).append(e)
    parts = []
    for grp in groups.values():
        child = grp[0][1]
        x = child
        for i, (name, _, ck, parent, pk) in enumerate(grp):
            keys = parent.select(F.col(pk).alias(f"_pk{i}")).distinct().withColumn(f"_has{i}", F.lit(1))
            x = x.join(keys, F.col(ck) == F.col(f"_pk{i}"), "left")
        # a null child key counts as one orphan (a set difference keeps it)
        agg = x.agg(*[(F.count_distinct(F.when(F.col(f"_has{i}").isNull(), F.col(ck)))
                       + F.max(F.when(F.col(ck).isNull(), 1).otherwise(0))).cast("long").alias(f"_n{i}")
                      for i, (_, _, ck, _, _) in enumerate(grp)])
        parts.append(agg.select(F.stack(F.lit(len(grp)), *[v for i, e in enumerate(grp)
                                                             for v in (F.lit(e[0]), F.col(f"_n{i}"))])
                                .alias("edge", "n_orphans")))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def business_constraints(orders: DataFrame, lines: DataFrame, inventory: DataFrame) -> DataFrame:
    """BC1 orders without a line, BC2 ordered products not stocked anywhere."""
    bc1 = orders.select("order_id").join(lines.select("order_id"), "order_id", "left_anti").agg(_n().alias("n"))
    bc2 = lines.select("product_id").distinct().join(inventory.select("product_id"), "product_id", "left_anti") \
        .agg(_n().alias("n"))
    return bc1.select(F.lit("BC1_order_has_line").alias("rule"), "n") \
        .unionByName(bc2.select(F.lit("BC2_ordered_product_stocked").alias("rule"), "n")) \
        .withColumn("ok", F.col("n") == 0)


def assert_constraints(report: DataFrame) -> None:
    """Fail the run when any rule is violated (one small collect of the report)."""
    bad = [r["rule"] for r in report.filter(~F.col("ok")).collect()]
    if bad:
        raise RuntimeError(f"business constraints violated: {bad}")


def row_count_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table plus a TOTAL row (rollup)."""
    parts = [df.agg(_n().alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.rollup("table_name").agg(F.sum("n_rows").alias("n_rows")) \
        .withColumn("table_name", F.coalesce("table_name", F.lit("TOTAL")))


def run_all_with_log(spark, steps: Sequence[tuple[str, object]], log_path: str, job_prefix: str = "LOAD_") -> DataFrame:
    """Run each (name, callable returning a row count) in order; append one log row per step
    and one for the whole run (``RUN_ALL``). Failures are logged and re-raised."""
    import datetime as dt
    rows = []
    start_all = dt.datetime.now()
    status_all, note_all, total = "SUCCESS", "", 0
    log_id0 = int(start_all.timestamp() * 1000)
    try:
        for i, (name, fn) in enumerate(steps):
            t0 = dt.datetime.now()
            try:
                n = int(fn() or 0)
                rows.append((log_id0 + i + 1, job_prefix + name, t0, dt.datetime.now(), "SUCCESS", n, ""))
                total += n
            except Exception as e:  # noqa: BLE001
                rows.append((log_id0 + i + 1, job_prefix + name, t0, dt.datetime.now(), "FAILED", 0, str(e)[:500]))
                status_all, note_all = "FAILED", f"{name}: {str(e)[:200]}"
                raise
    finally:
        rows.append((log_id0, "RUN_ALL", start_all, dt.datetime.now(), status_all, total, note_all))
        from shopframe.operators.quality import LOG_SCHEMA
        spark.createDataFrame(rows, LOG_SCHEMA).write.mode("append").parquet(log_path)
    return spark.read.parquet(log_path)
