"""A batch that is appended is computed once."""

import os

from shopframe.operators import ingest


def test_an_appended_batch_is_computed_once(spark, tmpdir_path):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    batch = spark.range(100, numPartitions=2).selectExpr("date'2020-09-01' AS t_dat", "id % 10 AS customer_id", "'1' AS article_id", "1.5D AS price", "1 AS sales_channel_id")
    batch = batch.mapInArrow(look, batch.schema)
    known = spark.range(10)
    rep = ingest.append_transactions(batch, known.withColumnRenamed("id", "customer_id"), known.withColumnRenamed("id", "article_id"), tmpdir_path, batch_id="b")
    assert rep["ok"] and spark.read.parquet(os.path.join(tmpdir_path, "ingest_batch=b")).count() == 100
    assert seen.value == 100
    assert not batch.storageLevel.useMemory
