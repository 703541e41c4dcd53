"""A stream's batch ids cost per file, not per row."""

import time

from pyspark.sql import functions as F

from shopframe.streaming import ingest_stream


def test_batch_ids_do_not_cost_time_by_the_length_of_the_folder(spark, tmpdir_path):
    path = "file:/" + "x" * 500 + "/day-1.snappy.parquet"
    rows = spark.range(3000).select(F.lit("2020-09-01").cast("date").alias("t_dat"), (F.col("id") % 10).alias("customer_id"), F.lit("1").alias("article_id"),
                                    F.lit(1.5).alias("price"), F.lit(1).alias("sales_channel_id"), F.lit(path).alias("_file"), F.timestamp_seconds(F.lit(1)).alias("_time"))
    since = time.time()
    ingest_stream.ingest_files(rows, 0, f"{tmpdir_path}/out", f"{tmpdir_path}/bad", spark.range(10).withColumnRenamed("id", "customer_id"),
                               spark.range(5).withColumnRenamed("id", "article_id"))
    assert time.time() - since < 60
    assert [tuple(r) for r in spark.read.parquet(f"{tmpdir_path}/out").groupBy("batch_id").count().collect()] == [("day-1", 3000)]


def test_batch_ids_of_paths(spark):
    names = {"file:/a.b/c/part-0.snappy.parquet": "part-0", "/x/y.json": "y", "z": "z", "s3://k/.hid.x": "hid", "/a/..b..c": "b", "/a/...": "", "/a/d e%20f": "d e%20f"}
    got = spark.createDataFrame([(k,) for k in names], "_file string").select("_file", ingest_stream.batch_of("_file").alias("i"), F.regexp_extract("_file", r"([^/.]+)[^/]*$", 1).alias("old"))
    assert all(r.i == names[r._file] == r.old for r in got.collect())
