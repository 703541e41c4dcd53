"""The warehouse OLAP questions over the star schema.

Dimensions are small next to the facts; joins to them are left to Catalyst
(AQE turns them into broadcast joins when the runtime size allows), so no
dimension is force-broadcast without a size bound. Default parameters are
one-row aggregates joined back (``crossJoin`` of exactly one row), never a
driver round trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopframe.functions.exprs import exact_sum, rnd


def default_param(df: DataFrame, col: str, value=None, pred: Column | None = None) -> DataFrame:
    """A one-row frame ``{col}`` holding ``value`` or ``MIN(col)`` under ``pred``."""
    if value is not None:
        return df.sparkSession.range(1).select(F.lit(value).cast(df.schema[col].dataType).alias(col))
    src = df.filter(pred) if pred is not None else df
    return src.agg(F.min(col).alias(col))


def limited(df: DataFrame, n: int | None, *order) -> DataFrame:
    """Order then keep the first n rows (TakeOrderedAndProject); None keeps all."""
    df = df.orderBy(*order) if order else df
    return df.limit(n) if n is not None else df


def slice_contains(df: DataFrame, col: str, text: str | None) -> DataFrame:
    """Case-insensitive contains filter on any column; empty text = no filter."""
    if text is None or not text.strip():
        return df
    return df.filter(F.contains(F.lower(F.coalesce(F.col(col).cast("string"), F.lit(""))),
                                F.lit(text.lower())))


def summarise(df: DataFrame, group: str, sum_col: str | None = None, digits: int | None = None) -> DataFrame:
    """Row count and numeric sum per group value (null group -> '(null)')."""
    g = F.coalesce(F.col(group).cast("string"), F.lit("(null)")).alias("group")
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if sum_col:
        # non-numbers are skipped, an all-null group sums to 0
        value = F.coalesce(F.sum(F.col(sum_col).cast("string").try_cast("double")), F.lit(0.0))
        aggs.append((rnd(value, digits) if digits is not None else value).alias("sum_value"))
    return df.groupBy(g).agg(*aggs).orderBy(F.desc("row_count"), "group")


def stock_listing(fi: DataFrame, loc: DataFrame, prod: DataFrame, order: bool = True) -> DataFrame:
    """O1: inventory with store and product attributes."""
    out = (fi.join(loc, "store_id").join(prod, "product_id")
           .select("store_id", "store_name", "city_name", "state", "phone", "product_id",
                   "description", "size", "weight_g", F.col("price").alias("unit_price"), "stock_qty"))
    return out.orderBy("store_id", "product_id") if order else out


def order_totals(fo: DataFrame, cust: DataFrame, time: DataFrame, order: bool = True, digits: int = 2) -> DataFrame:
    """O2: amount per order, customer, day and channel; date as d/m/y text.

    The money sum is rounded to cents, which makes it independent of the
    summation order (partitioning) of the lines.
    """
    j = fo.join(cust.select("customer_id", "customer_name"), "customer_id") \
        .join(time.select("time_id", "day", "month", "year", "weekday"), "time_id")
    out = j.groupBy("order_id", "customer_name", "day", "month", "year", "weekday", "channel") \
        .agg(rnd(exact_sum("amount"), digits).alias("order_total"))
    out = out.select("order_id", "customer_name",
                     F.concat_ws("/", F.col("day").cast("string"), F.col("month").cast("string"),
                                 F.col("year").cast("string")).alias("order_date"),
                     "weekday", "channel", "order_total", "year", "month", "day")
    out = out.orderBy("year", "month", "day", "order_id", "channel") if order else out
    return out.drop("year", "month", "day")


def stores_of_customer(fo: DataFrame, loc: DataFrame, customer_id=None) -> DataFrame:
    """O3: distinct stores that sold to one customer (default: smallest customer key)."""
    p = default_param(fo, "customer_id", customer_id)
    sold = fo.join(p, "customer_id", "left_semi").select("store_id").distinct()
    return sold.join(loc, "store_id").select("store_id", "store_name", "city_name", "phone") \
        .orderBy("store_id")


def stores_with_stock(fi: DataFrame, loc: DataFrame, product_id=None, min_qty: float = 100) -> DataFrame:
    """Stores holding more than ``min_qty`` of a product."""
    p = default_param(fi, "product_id", product_id, F.col("stock_qty") > min_qty)
    hit = fi.filter(F.col("stock_qty") > min_qty).join(p, "product_id", "left_semi")
    return (hit.join(loc, "store_id")
            .select("store_id", "store_name", "office_address", "city_name", "state", "stock_qty")
            .distinct().orderBy("state", "city_name", "store_id"))


def order_detail(fo: DataFrame, cust: DataFrame, prod: DataFrame, loc: DataFrame,
                 order: bool = True) -> DataFrame:
    """Order lines with customer, product and store."""
    out = (fo.join(cust.select("customer_id", "customer_name"), "customer_id")
           .join(prod.select("product_id", "description"), "product_id")
           .join(loc.select("store_id", "store_name", "city_name"), "store_id")
           .select("order_id", "customer_name", "product_id", "description", "store_id",
                   "store_name", "city_name", "qty", "unit_price", "amount"))
    return out.orderBy("order_id", "product_id", "store_id") if order else out


def customer_address(cust: DataFrame, customer_id=None) -> DataFrame:
    """One customer's city and state."""
    p = default_param(cust, "customer_id", customer_id)
    return cust.join(p, "customer_id", "left_semi").select(
        "customer_id", "customer_name", "city_id", "city_name", "state")


def stock_in_city(fi: DataFrame, loc: DataFrame, prod: DataFrame, product_id=None,
                  city_id=None) -> DataFrame:
    """Stock of a product in the stores of a city.

    Missing parameters default to the first (product, city) pair in key order,
    computed as ``min(struct(product, city))`` - one aggregate, no sort.
    """
    pairs = fi.join(loc.select("store_id", "city_id"), "store_id")
    first = pairs.agg(F.min(F.struct("product_id", "city_id")).alias("m")).select(
        F.col("m.product_id").alias("d_product"), F.col("m.city_id").alias("d_city"))
    first = first.select(
        (F.lit(product_id).cast("long") if product_id is not None else F.col("d_product")).alias("p_id"),
        (F.lit(city_id).cast("int") if city_id is not None else F.col("d_city")).alias("c_id"))
    j = pairs.join(first, (F.col("product_id") == F.col("p_id")) & (F.col("city_id") == F.col("c_id")))
    return (j.join(loc.select("store_id", "store_name", "store_type"), "store_id")
            .join(prod.select("product_id", "description"), "product_id")
            .select("store_id", "store_name", "store_type", "product_id", "description", "stock_qty")
            .orderBy("store_id"))


def one_order(fo: DataFrame, cust: DataFrame, prod: DataFrame, loc: DataFrame, order_id=None) -> DataFrame:
    """All lines of one order (default: smallest order key)."""
    p = default_param(fo, "order_id", order_id)
    lines = fo.join(p, "order_id", "left_semi")
    return (lines.join(prod.select("product_id", "description"), "product_id")
            .join(cust.select("customer_id", "customer_name"), "customer_id")
            .join(loc.select("store_id", "store_name", "city_name"), "store_id")
            .select("order_id", "product_id", "description", "qty", "unit_price", "amount",
                    "customer_id", "customer_name", "store_id", "store_name", "city_name")
            .orderBy("product_id", "store_id"))


def customers_of_type(cust: DataFrame, ctype: str) -> DataFrame:
    """O9a-c: customers of one subtype with their subtype attributes."""
    cols = {"tourist": ["guide"], "postal": ["postal_address"], "both": ["guide", "postal_address"]}[ctype]
    return cust.filter(F.col("customer_type") == ctype) \
        .select("customer_id", "customer_name", *cols).orderBy("customer_id")


def customer_type_counts(cust: DataFrame) -> DataFrame:
    """O9d: customers per subtype, null type excluded."""
    return cust.filter(F.col("customer_type").isNotNull()).groupBy("customer_type") \
        .agg(F.count(F.lit(1)).alias("n_customers")).orderBy(F.desc("n_customers"), "customer_type")
