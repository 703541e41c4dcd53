"""Model registry, prediction log and serving queries.

The registry is a small versioned table (``sources.sinks``): each change
writes a new version with the active flags recomputed, so activation is
atomic. Models are saved with Spark ML persistence next to it. Serving
queries are batch forms of the per-customer endpoints: they answer for all
(or a page of) customers in one job instead of one request per customer.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopframe.functions.exprs import exact_sum, rnd
from shopframe.sources.sinks import read_current, replace_table

LAYERS = ("L1_KMEANS", "L2_APRIORI", "L3_RANDOMFOREST")
REGISTRY_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()), T.StructField("version", T.StringType()),
    T.StructField("artifact_path", T.StringType()), T.StructField("metrics", T.StringType()),
    T.StructField("n_samples_train", T.LongType()), T.StructField("cutoff_date", T.DateType()),
    T.StructField("is_active", T.BooleanType()), T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("parent_version", T.StringType()), T.StructField("is_incremental", T.BooleanType())])


def _registry(spark: SparkSession, base: str) -> DataFrame:
    cur = read_current(spark, f"{base}/registry", REGISTRY_SCHEMA)
    return cur if cur is not None else spark.createDataFrame([], REGISTRY_SCHEMA)


def register_model(spark: SparkSession, base: str, layer: str, artifact=None, metrics: dict | None = None,
                   n_samples: int = 0, cutoff: dt.date | None = None, parent: str | None = None,
                   incremental: bool = False, now: dt.datetime | None = None) -> str:
    """Save the artifact, deactivate the layer's other versions, add the new active row."""
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}")
    now = now or dt.datetime.now()
    version = f"{layer}_{now.strftime('%Y%m%d_%H%M%S_%f')}"
    path = f"{base}/artifacts/{layer}/{version}"
    if artifact is not None:
        if hasattr(artifact, "write"):
            artifact.write().overwrite().save(path)
        elif isinstance(artifact, DataFrame):
            artifact.write.mode("overwrite").parquet(path)
    row = spark.createDataFrame([(layer, version, path, json.dumps(metrics or {}, default=str), int(n_samples),
                                  cutoff, True, now.replace(microsecond=now.microsecond), parent, incremental)],
                                REGISTRY_SCHEMA)
    reg = _registry(spark, base)
    reg = reg.withColumn("is_active", F.when(F.col("layer") == layer, F.lit(False)).otherwise(F.col("is_active")))
    replace_table(reg.unionByName(row), f"{base}/registry")
    return version


def active_version(reg: DataFrame, layer: str) -> DataFrame:
    """R2: newest active row of a layer (empty when none)."""
    return reg.filter((F.col("layer") == layer) & F.col("is_active")) \
        .agg(F.max_by(F.struct(*reg.columns), F.col("created_at")).alias("r")).select("r.*") \
        .filter(F.col("version").isNotNull())


def activate_version(spark: SparkSession, base: str, layer: str, version: str) -> None:
    """Make ``version`` the only active one of its layer; unknown version -> ValueError."""
    reg = _registry(spark, base)
    if reg.filter((F.col("layer") == layer) & (F.col("version") == version)).limit(1).count() == 0:
        raise ValueError(f"unknown version {version} for {layer}")
    new = reg.withColumn("is_active", F.when(F.col("layer") != layer, F.col("is_active"))
                         .otherwise(F.col("version") == version))
    replace_table(new, f"{base}/registry")


def version_history(reg: DataFrame, layer: str, n: int = 20) -> DataFrame:
    """Newest ``n`` versions of a layer with metrics."""
    return reg.filter(F.col("layer") == layer).orderBy(F.desc("created_at"), F.desc("version")).limit(n)


PREDICTION_SCHEMA = "customer_id long, layer string, model_version string, predicted_value string, " \
                    "actual_value string, predicted_at timestamp_ntz, resolved_at timestamp_ntz"


def prediction_rows(pred: DataFrame, layer: str, version: str, value_cols, at) -> DataFrame:
    """Customer, layer, version and the prediction as JSON text."""
    return pred.select(F.col("customer_id").cast("long"), F.lit(layer).alias("layer"),
                       F.lit(version).alias("model_version"),
                       F.to_json(F.struct(*value_cols)).alias("predicted_value"),
                       F.lit(None).cast("string").alias("actual_value"),
                       F.lit(at).cast("timestamp_ntz").alias("predicted_at"),
                       F.lit(None).cast("timestamp_ntz").alias("resolved_at"))


def log_predictions(rows: DataFrame, path: str) -> None:
    """Append to the prediction log (parallel append, no per-row insert)."""
    rows.write.mode("append").parquet(path)


def resolve_predictions(log: DataFrame, tx: DataFrame, window: int = 7, asof=None) -> DataFrame:
    """Actual outcome of will-buy predictions once their window has passed.

    A range join by buckets: time is cut into stretches of ``window`` days, so a
    prediction's days lie in at most two of them. Predictions meet only the
    purchase days of these stretches (at most ``window`` distinct ones each),
    never the customer's whole history. A prediction without a customer or a
    time has no purchases.
    """
    stretch = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / window)
    days = tx.select("customer_id", "t_dat", stretch(F.col("t_dat")).alias("_s")).distinct()
    p = log.withColumn("_d0", F.to_date("predicted_at")).withColumn("_d1", F.date_add("_d0", window))
    if asof is not None:
        p = p.filter(F.col("_d1") <= F.lit(asof).cast("date"))
    asked = p.select("customer_id", "predicted_at", "_d0", "_d1").distinct() \
        .withColumn("_s", F.explode(F.array_distinct(F.array(stretch(F.date_add("_d0", 1)), stretch(F.col("_d1"))))))
    hits = asked.join(days, ["customer_id", "_s"]).filter((F.col("t_dat") > F.col("_d0")) & (F.col("t_dat") <= F.col("_d1"))) \
        .select("customer_id", "predicted_at").distinct().withColumn("_hit", F.lit(1))
    out = p.join(hits, ["customer_id", "predicted_at"], "left")
    actual = F.coalesce(F.col("_hit"), F.lit(0))
    return out.withColumn("actual_value", F.to_json(F.struct(actual.alias("will_buy")))) \
        .withColumn("resolved_at", F.col("_d1").cast("timestamp_ntz")) \
        .withColumn("correct", F.get_json_object("predicted_value", "$.will_buy").cast("int") == actual) \
        .drop("_d0", "_d1", "_hit")


def accuracy_by_version(resolved: DataFrame) -> DataFrame:
    """Resolved predictions and accuracy per model version."""
    return resolved.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("n_resolved"), F.avg(F.col("correct").cast("double")).alias("accuracy"))


def mining_summary(customers: DataFrame, articles: DataFrame, tx: DataFrame, clusters: DataFrame,
                   reg: DataFrame | None = None) -> DataFrame:
    """One row of counts and the newest transaction date (plus active versions when given)."""
    out = customers.agg(F.count(F.lit(1)).alias("n_customers")) \
        .crossJoin(articles.agg(F.count(F.lit(1)).alias("n_articles"))) \
        .crossJoin(tx.agg(F.count(F.lit(1)).alias("n_transactions"), F.max("t_dat").alias("latest_transaction_date"))) \
        .crossJoin(clusters.agg(F.count(F.lit(1)).alias("n_clustered_customers")))
    if reg is not None:
        act = reg.filter("is_active").groupBy().agg(
            F.map_from_entries(F.collect_list(F.struct("layer", "version"))).alias("active_models"))
        out = out.crossJoin(act)
    return out


def cluster_distribution(clusters: DataFrame) -> DataFrame:
    """Customers per cluster and label."""
    return clusters.groupBy("cluster_id", "cluster_label").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


def customers_in_cluster(clusters: DataFrame, customers: DataFrame, tx: DataFrame, cluster_id: int,
                         page: int = 1, size: int = 10) -> DataFrame:
    """One page of a cluster's customers by id, with their stats; aggregates only for that page."""
    members = clusters.filter(F.col("cluster_id") == cluster_id)
    total = members.agg(F.count(F.lit(1)).alias("total"))
    picked = members.orderBy("customer_id").offset((page - 1) * size).limit(size)
    stats = tx.join(picked.select("customer_id"), "customer_id", "left_semi").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_transactions"), exact_sum("price").alias("_spent"), F.max("t_dat").alias("last_purchase"))
    out = picked.join(customers.select("customer_id", "age", "club_member_status"), "customer_id", "left") \
        .join(stats, "customer_id", "left")
    return out.select("customer_id", "cluster_id", "cluster_label", "age", "club_member_status",
                      F.coalesce("n_transactions", F.lit(0)).alias("n_transactions"),
                      rnd(F.coalesce("_spent", F.lit(0.0)), 4).alias("total_spent"), "last_purchase") \
        .crossJoin(total).withColumn("total_pages", F.ceil(F.col("total") / F.lit(size)))


def customer_profiles(customers: DataFrame, tx: DataFrame, articles: DataFrame, clusters: DataFrame,
                      top: int = 5) -> DataFrame:
    """R10 (batch): demographics, purchase stats, top product groups and cluster for every customer."""
    stats = tx.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_transactions"), F.count_distinct("t_dat").alias("n_days_active"),
        exact_sum("price").alias("total_spent"), F.avg("price").alias("avg_price"), F.min("t_dat").alias("first_purchase"),
        F.max("t_dat").alias("last_purchase"),
        F.avg(F.when(F.col("sales_channel_id") == 2, 1.0).otherwise(0.0)).alias("pct_online"))
    g = tx.join(articles.select("article_id", "product_group_name"), "article_id") \
        .groupBy("customer_id", "product_group_name").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("customer_id").orderBy(F.desc("n"), "product_group_name")  # groups of one customer
    topg = g.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= top) \
        .groupBy("customer_id").agg(F.array_sort(F.collect_list(F.struct("_r", "product_group_name", "n")))
                                    .alias("_top"))
    topg = topg.select("customer_id", F.transform("_top", lambda x: F.struct(
        x["product_group_name"].alias("group_name"), x["n"].alias("n"))).alias("top_product_groups"))
    return customers.select("customer_id", "age", "club_member_status", "fashion_news_frequency", "postal_code") \
        .join(stats, "customer_id", "left").join(topg, "customer_id", "left") \
        .join(clusters.select("customer_id", "cluster_id", "cluster_label"), "customer_id", "left")
