"""Customer upserts, batch validation, all-or-nothing appends, retraining chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopframe.sources.keyed import latest_fields

#: limit of the request form of ingest; streams and files have none
MAX_REQUEST_ROWS = 10_000
REPORT_IDS = 20


def upsert_customers(target: DataFrame, updates: DataFrame, key: str = "customer_id",
                     fields: Sequence[str] | None = None, order: Sequence[str] = ()) -> DataFrame:
    """New customers are inserted; known ones take only the non-null fields of the update.

    Several updates of a customer count as if they came one after another in
    ``order`` (ties: the greater value); a customer stays one row. Updates
    without a key are left out, as they name nobody. ``KeyedTable.upsert`` with
    ``mode="fill"`` does the same to a stored table, bucket by bucket.
    """
    fields = list(fields or [c for c in target.columns if c != key])
    given = [c for c in fields if c in updates.columns]
    by = [c for c in order if c not in given]
    u = latest_fields(updates.where(F.col(key).isNotNull()).select(key, *given, *by), key, by)
    u = u.select(key, *[F.col(c).alias(f"_new_{c}") for c in given])
    j = target.join(u, key, "full_outer")
    return j.select(key, *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in given else F.col(c) for c in fields])


def _smallest(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n smallest distinct values as one sorted array (a top-n, never the whole set)."""
    return df.select(col).distinct().orderBy(col).limit(n).agg(F.sort_array(F.collect_list(col)).alias(col))


def validate_transactions(batch: DataFrame, customers: DataFrame, articles: DataFrame,
                          max_rows: int | None = None) -> DataFrame:
    """One-row report: size limit (if any), article ids castable to int, channel in {1, 2},
    unknown customers and articles (the first 20 of each, sorted), and ``ok``."""
    b = batch.withColumn("_aid", F.col("article_id").cast("string").try_cast("long"))
    head = b.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("_aid").isNull()).alias("bad_article_ids"),
                 F.count_if(~F.col("sales_channel_id").isin(1, 2) | F.col("sales_channel_id").isNull())
                 .alias("bad_channels"))
    mc = b.select("customer_id").distinct().join(customers.select("customer_id"), "customer_id", "left_anti")
    ma = b.filter(F.col("_aid").isNotNull()).select(F.col("_aid").alias("article_id")).distinct() \
        .join(articles.select(F.col("article_id").cast("long").alias("article_id")), "article_id", "left_anti")
    rep = head.crossJoin(mc.agg(F.count(F.lit(1)).alias("n_missing_customers"))) \
        .crossJoin(ma.agg(F.count(F.lit(1)).alias("n_missing_articles"))) \
        .crossJoin(_smallest(mc, "customer_id", REPORT_IDS).withColumnRenamed("customer_id", "missing_customers")) \
        .crossJoin(_smallest(ma, "article_id", REPORT_IDS).withColumnRenamed("article_id", "missing_articles"))
    return rep.withColumn("too_many", F.col("n_rows") > max_rows if max_rows else F.lit(False)).withColumn(
        "ok", (F.col("n_rows") > 0) & ~F.col("too_many") & (F.col("bad_article_ids") == 0)
        & (F.col("bad_channels") == 0) & (F.col("n_missing_customers") == 0) & (F.col("n_missing_articles") == 0))


def validate_files(rows: DataFrame, customers: DataFrame, articles: DataFrame, file: str) -> DataFrame:
    """I2 for many batches at once: one report row per value of ``file``.

    ``file, n_rows, bad_article_ids, bad_channels, n_missing_customers,
    n_missing_articles, ok``. Unknown keys are counted distinct, after the keys
    of each file have been made distinct.
    """
    b = rows.withColumn("_aid", F.col("article_id").cast("string").try_cast("long"))
    head = b.groupBy(file).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("_aid").isNull()).alias("bad_article_ids"),
                               F.count_if(~F.col("sales_channel_id").isin(1, 2) | F.col("sales_channel_id").isNull()).alias("bad_channels"))

    def missing(keys: DataFrame, known: DataFrame, key: str, out: str) -> DataFrame:
        k = keys.distinct().join(known.select(F.col(key).cast("long").alias("_key")), "_key", "left_anti")
        return k.groupBy(file).agg(F.count(F.lit(1)).alias(out))
    mc = missing(b.select(file, F.col("customer_id").cast("long").alias("_key")), customers, "customer_id", "n_missing_customers")
    ma = missing(b.where("_aid IS NOT NULL").select(file, F.col("_aid").alias("_key")), articles, "article_id", "n_missing_articles")
    rep = head.join(mc, file, "left").join(ma, file, "left").na.fill(0, ["n_missing_customers", "n_missing_articles"])
    return rep.withColumn("ok", (F.col("bad_article_ids") == 0) & (F.col("bad_channels") == 0)
                          & (F.col("n_missing_customers") == 0) & (F.col("n_missing_articles") == 0))


def append_transactions(batch: DataFrame, customers: DataFrame, articles: DataFrame, path: str,
                        quarantine: str | None = None, batch_id: str | None = None, max_rows: int | None = None) -> dict:
    """Add the whole batch when valid, nothing otherwise (optionally to a quarantine folder).

    The batch lands in its own ``ingest_batch=<id>`` folder (overwritten on a
    retry with the same id), so a resubmitted batch is never counted twice. The
    checks and the write read one cached copy of the batch; a batch that the
    caller has cached stays cached.
    """
    import uuid
    bid = batch_id or uuid.uuid4().hex
    own = batch.storageLevel == StorageLevel.NONE
    if own:
        batch = batch.persist()
    try:
        rep = validate_transactions(batch, customers, articles, max_rows).first().asDict()
        clean = batch.withColumn("article_id", F.col("article_id").cast("string").try_cast("long"))
        if rep["ok"]:
            clean.write.mode("overwrite").parquet(f"{path}/ingest_batch={bid}")
        elif quarantine:
            batch.write.mode("overwrite").parquet(f"{quarantine}/ingest_batch={bid}")
    finally:
        if own:
            batch.unpersist()
    return {**rep, "batch_id": bid}


def retrain_chain(steps: Sequence[tuple[str, object]]) -> list[tuple[str, object]]:
    """Run the layers in order (clusters -> rules -> forest); a failing layer stops the chain."""
    done = []
    for name, fn in steps:
        done.append((name, fn()))
    return done


def incremental_chain(update_clusters, extend_forest) -> list[tuple[str, object]]:
    """I5 incremental: clusters and forest only (rules are re-mined by the full chain)."""
    return retrain_chain([("L1_KMEANS", update_clusters), ("L3_RANDOMFOREST", extend_forest)])
