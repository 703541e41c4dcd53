"""Training rows are spread over tasks."""

from pyspark.sql import functions as F

from shopframe.operators import prediction as p


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_training_rows_are_spread_over_tasks(spark):
    df = spark.range(2000).select("id", (F.col("id") % 2).alias("y")).coalesce(1)
    many, one = p.training_copy(df, "id", rows=100), p.training_copy(df, "id", rows=5000)
    sizes = [r["count"] for r in many.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 200 and len(sizes) == 20
    assert one.rdd.getNumPartitions() == 1 and _rows(one) == _rows(many)
