"""Streams have no row limit; the request form keeps its own."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from shopframe.operators.ingest import MAX_REQUEST_ROWS, append_transactions, validate_transactions
from shopframe.streaming.ingest_stream import stream_transactions


def test_large_micro_batch_reaches_the_target(spark, tmpdir_path):
    n = 50_000
    customers = spark.range(100).select(F.col("id").alias("customer_id"))
    articles = spark.range(50).select(F.col("id").alias("article_id"))
    batch = spark.range(n).select(F.lit(dt.date(2020, 9, 1)).alias("t_dat"), (F.col("id") % 100).alias("customer_id"), (F.col("id") % 50).cast("string").alias("article_id"),
                                  F.lit(1.5).alias("price"), F.lit(1).alias("sales_channel_id"))
    batch.write.parquet(f"{tmpdir_path}/in/one")
    q = stream_transactions(spark, f"{tmpdir_path}/in/one", f"{tmpdir_path}/out", f"{tmpdir_path}/bad", customers, articles, name=f"big_{uuid.uuid4().hex[:6]}")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == n
    assert validate_transactions(batch, customers, articles).first()["ok"]
    assert validate_transactions(batch, customers, articles, MAX_REQUEST_ROWS).first()["too_many"]
    rep = append_transactions(batch, customers, articles, f"{tmpdir_path}/appended", batch_id="b1")
    assert rep["ok"] and spark.read.parquet(f"{tmpdir_path}/appended").count() == n
