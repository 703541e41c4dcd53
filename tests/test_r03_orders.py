"""Orders are dealt to tasks by rows."""

from shopframe.operators import features as f
from shopframe.operators import survey as v
from shopframe.sources.tables import Tables


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_orders_are_dealt_by_rows(spark, tmpdir_path):
    spark.range(1001).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    t = Tables(spark, tmpdir_path)
    t._src["lineitem"] = spark.range(1001)
    assert (t.parts("lineitem"), t.parts("lineitem", 100)) == (1, 11)
    oi = spark.createDataFrame([(o, q, s) for o in (1, 2, 3, 4, None) for q, s in ((1, "Complete"), (1, "Complete"), (2, "Shipped"), (3, "Cancelled"), (9, "Complete"))],
                               "order_id long, product_id long, status string")
    pr = spark.createDataFrame([(1, "a", "Men"), (2, "b", "Men"), (3, None, "Women")], "id long, category string, department string")
    cuts = [lambda n: v.categories_per_order(oi, pr, parts=n), lambda n: v.category_frequency_by_department(oi, pr, parts=n), lambda n: f.product_id_baskets(oi, parts=n)]
    for cut in cuts:
        assert _rows(cut(7)) == _rows(cut(1))
        assert "REPARTITION_BY_NUM" in cut(7)._jdf.queryExecution().toString() and "REPARTITION_BY_NUM" not in cut(1)._jdf.queryExecution().toString()
    assert _rows(v.category_frequency_by_department(oi, pr, parts=7)) == [("Men", "a", "4", "100.0"), ("Men", "b", "4", "100.0")]
