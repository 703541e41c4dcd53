"""ETL run log, retraining chain, metadata, exports and the streaming aggregate."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shopframe.operators import clustering as cl
from shopframe.operators import etl, ingest, prediction as p, survey
from shopframe.sources import sinks


def test_run_all_with_log_success_and_failure(spark, tmpdir_path):
    log = os.path.join(tmpdir_path, "etl_log")
    out = etl.run_all_with_log(spark, [("DIM_A", lambda: 3), ("FACT_B", lambda: 4)], log)
    rows = {r.job: (r.status, r.n_rows) for r in out.collect()}
    assert rows == {"LOAD_DIM_A": ("SUCCESS", 3), "LOAD_FACT_B": ("SUCCESS", 4), "RUN_ALL": ("SUCCESS", 7)}

    def boom():
        raise RuntimeError("bad input")
    with pytest.raises(RuntimeError):
        etl.run_all_with_log(spark, [("DIM_C", boom)], log)
    failed = spark.read.parquet(log).filter(F.col("status") == "FAILED").select("job").collect()
    assert sorted(r.job for r in failed) == ["LOAD_DIM_C", "RUN_ALL"]


def test_business_constraints_raise(spark):
    orders = spark.createDataFrame([(1,), (2,)], "order_id long")
    lines = spark.createDataFrame([(1, 10)], "order_id long, product_id long")
    inv = spark.createDataFrame([(10,)], "product_id long")
    rep = etl.business_constraints(orders, lines, inv)
    with pytest.raises(RuntimeError):
        etl.assert_constraints(rep)


def test_allocate_stores_largest_remainder(spark):
    cities = spark.createDataFrame([("a", "s", 50), ("b", "s", 30), ("c", "s", 20)], "city string, state string, "
                                                                                   "n_orders long")
    out = {r.city: r.n_stores for r in etl.allocate_stores(cities, 10).select("city", "n_stores").distinct().collect()}
    assert sum(out.values()) == 10 and all(v >= 1 for v in out.values()) and out["a"] >= out["b"] >= out["c"]


def test_store_inventory_distinct_and_covering(spark):
    stores = spark.createDataFrame([(i,) for i in range(1, 4)], "store_sk long")
    prods = spark.createDataFrame([(100 + i, i) for i in range(1, 51)], "product_id long, product_sk long")
    inv = etl.store_inventory(stores, prods, lo=5, hi=10)
    assert inv.groupBy("store_sk", "product_id").count().filter("count > 1").count() == 0
    assert inv.select("product_id").distinct().count() == 50
    q = inv.agg(F.min("stock_qty"), F.max("stock_qty")).first()
    assert 10 <= q[0] and q[1] <= 200


def test_retrain_and_incremental_chain(spark):
    df = spark.createDataFrame([(float(i % 5), float(i % 3)) for i in range(60)], "x double, y double")
    calls = []
    done = ingest.retrain_chain([("L1_KMEANS", lambda: calls.append("k") or cl.fit_kmeans(df, ["x", "y"], 3)[0]),
                                 ("L2_APRIORI", lambda: calls.append("a") or 0),
                                 ("L3_RANDOMFOREST", lambda: calls.append("f") or 1)])
    assert [n for n, _ in done] == ["L1_KMEANS", "L2_APRIORI", "L3_RANDOMFOREST"] and calls == ["k", "a", "f"]
    cen = spark.createDataFrame([(0, 0.0, 0.0, 10), (1, 4.0, 2.0, 10)], "cluster_id int, x double, y double, n long")
    new = {r.cluster_id: r for r in cl.update_clusters(df, cen, ["x", "y"]).collect()}
    assert new[0].n + new[1].n == 80


def test_forest_ensemble_weighted(spark):
    rows = [(float(i), float(i % 7), int(i % 7 > 3)) for i in range(200)]
    df = p.assemble(spark.createDataFrame(rows, "a double, b double, label int"), ["a", "b"])
    ens = p.ForestEnsemble().extend(df, "label", 5, max_depth=3).extend(df, "label", 15, max_depth=3, seed=3)
    assert ens.n_trees == 20
    s = ens.score(df)
    assert s.filter((F.col("score") < 0) | (F.col("score") > 1)).count() == 0


def test_describe_and_list_tables(spark):
    df = spark.createDataFrame([(1, "x")], "id long, name string")
    d = {r.column_name: r.data_type for r in survey.describe_table(df).collect()}
    assert d == {"id": "bigint", "name": "string"}
    df.createOrReplaceTempView("tmp_describe_me")
    assert "tmp_describe_me" in [r.table_name for r in survey.list_tables(spark).collect()]


def test_export_csv_header(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "csv")
    sinks.export_csv(spark.createDataFrame([(1, "a")], "id long, v string"), out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["id", "v"] and back.count() == 1


def test_windowed_sales_stream(spark, tmpdir_path):
    from shopframe.streaming.ingest_stream import BATCH_SCHEMA, windowed_sales
    src = os.path.join(tmpdir_path, "s")
    spark.createDataFrame([(dt.date(2024, 1, 1), 1, "1", 2.0, 1), (dt.date(2024, 1, 1), 2, "2", 3.0, 1),
                           (dt.date(2024, 1, 5), 1, "1", 4.0, 2)], BATCH_SCHEMA).write.parquet(src)
    stream = spark.readStream.schema(BATCH_SCHEMA).parquet(src)
    q = windowed_sales(stream).writeStream.outputMode("update").format("memory").queryName("ws_test") \
        .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.sales_channel_id, r.n_transactions) for r in spark.sql("SELECT * FROM ws_test").collect()}
    assert (1, 2) in got and (2, 1) in got


def test_fk_report_counts_distinct_orphans_and_null(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (3, 99), (4, 99), (5, None), (6, 11)], "id long, k long")
    parent = spark.createDataFrame([(10,), (11,), (11,)], "k long")
    other = spark.createDataFrame([(1,)], "id long")
    rep = {r.edge: r.n_orphans for r in etl.fk_report([("k_edge", child, "k", parent, "k"),
                                                        ("id_edge", child, "id", other, "id")]).collect()}
    assert rep == {"k_edge": 2, "id_edge": 5}
