"""Shuffle files of stored steps go when the step ends."""

import os
import time

from pyspark.sql import functions as F

from shopframe.functions import prefix
from shopframe.operators import prediction as p
from shopframe.operators import rules as r
from shopframe.session import Work, materialize


def _shuffle_files(spark):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files made since; they are removed in the background."""
    end = time.time() + 10
    while (new := _shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.1)
    return new


def _grouped(spark, n):
    return spark.range(100_000).groupBy((F.col("id") % n).alias("k")).agg(F.sum("id").alias("v"))


def test_store_leaves_no_shuffle_files(spark):
    before, df = _shuffle_files(spark), _grouped(spark, 5000)
    out = Work(spark, "sweep").store(df, "a")
    assert not _left(spark, before)
    assert out.count() == df.count() == 5000 and out.agg(F.sum("v")).first()[0] == sum(range(100_000))


def test_materialize_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was, df = _shuffle_files(spark), spark.conf.get(key, "false"), _grouped(spark, 4000)
    out = materialize(df.join(_grouped(spark, 4000).withColumnRenamed("v", "w"), "k"))
    assert not _left(spark, before) and spark.conf.get(key, "false") == was
    assert out.where("v = w").count() == 4000 and out.agg(F.sum("v")).first()[0] == sum(range(100_000))


def test_fpgrowth_makes_its_baskets_once(spark):
    rows = [(g, b, i) for g in ("x", None) for b in range(40) for i in ("a", "b", "c", "d") if b % (ord(i) - 95)]
    rows += [("few", 1, "a"), ("few", 1, "b")]
    made = spark.sparkContext.accumulator(0)

    def seen(x):
        made.add(1)
        return x

    item = F.udf(seen, "string").asNondeterministic()
    lines = spark.createDataFrame(rows, "g string, b long, i string").withColumn("i", item("i"))
    sets = lines.groupBy("g", "b").agg(F.sort_array(F.collect_set("i")).alias("items"))
    got = {(x.g, tuple(x["items"])): x["count"] for x in r.frequent_itemsets(sets, 0.1, None, ["g"], method="fpgrowth", min_baskets=2).collect()}
    assert made.value == len(rows)
    baskets = {}
    for g, b, i in rows:
        baskets.setdefault((g, b), set()).add(i)
    assert {g for g, _ in got} == {"x", None}
    for (g, items), n in got.items():
        assert n == sum(1 for (h, _), s in baskets.items() if h == g and s >= set(items))
    assert (None, ("a", "b", "c", "d")) in got and len(got) == 2 * 15


def test_ordered_rows_are_kept_by_the_given_store(spark):
    df = spark.createDataFrame([(i, i % 3 if i % 7 else None, f"t{i % 5}") for i in range(300)], "k long, y long, t string")
    work, kept = Work(spark, "split"), []
    got = p.stratified_split(df, "y", "k", store=lambda d: kept.append(1) or work.store(d, "ordered"))
    want = p.stratified_split(df, "y", "k")
    rows = lambda d: sorted(map(str, d.select("k", "y", "t", "split").collect()))
    assert kept == [1] and rows(got) == rows(want) and len(rows(got)) == 300


def test_training_rows_leave_the_work_table(spark):
    df = spark.range(2000).select("id", (F.col("id") % 2).alias("y")).coalesce(1)
    work = Work(spark, "training")
    few = p.training_copy(df, "id", rows=5000, work=work)
    at = work.path("split").removeprefix("file:")
    assert few.count() == 2000 and os.path.isdir(at)
    other = work.store(df, "other")
    many = p.training_copy(other, "id", rows=100, work=work, spent=["other"])
    assert not os.path.exists(work.path("other").removeprefix("file:"))
    sizes = [x["count"] for x in many.groupBy(F.spark_partition_id()).count().collect()]
    assert not os.path.exists(at) and len(sizes) == 20 and max(sizes) <= 200
    assert sorted(x.id for x in many.collect()) == list(range(2000))


def test_offsets_are_joined_either_way(spark, monkeypatch):
    df = spark.createDataFrame([(i % 4 if i % 9 else None, i, i % 6 - 2) for i in range(400)], "g long, o long, v long")

    def totals(**kw):
        return sorted(map(str, prefix.running_total(df, ["o"], "v", **kw).collect())), prefix.running_total(df, ["o"], "v", **kw)._jdf.queryExecution().optimizedPlan().toString()

    (one, plan), (grouped, by_plan) = totals(), totals(by=["g"])
    assert "broadcast" in plan and "broadcast" in by_plan
    monkeypatch.setattr(prefix, "MOST_OFFSETS", 0)
    shuffled, far = totals(by=["g"])
    assert shuffled == grouped and "broadcast" not in far
    total, sums = 0, {}
    for i in range(400):
        g = i % 4 if i % 9 else None
        sums[g] = sums.get(g, 0) + i % 6 - 2
        total += i % 6 - 2
        assert f"Row(g={g}, o={i}, v={i % 6 - 2}, running={total})" in one
        assert f"Row(g={g}, o={i}, v={i % 6 - 2}, running={sums[g]})" in grouped
