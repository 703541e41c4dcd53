"""Running totals, numbering, draws, rounding and thresholds at sizes where sampling and floats matter."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopframe.functions.exprs import draw, exact_sum, padded, rnd
from shopframe.functions.prefix import row_numbers, running_total
from shopframe.operators.prediction import auc, roc_points, stratified_split
from shopframe.operators.rules import _threshold, frequent_itemsets


@pytest.fixture(scope="module")
def many(spark):
    """100,000 rows with payload columns, a hot group and a null group."""
    d = spark.range(100_000).select(
        F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("k"), F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 97 == 0, None).otherwise(F.concat(F.lit("g"), F.col("id") % 11)).alias("g"),
        (F.col("id") % 7).alias("v"), F.repeat(F.lit("payload"), 5).alias("p1"), F.rand(1).alias("p2"))
    return d.cache()


@pytest.mark.parametrize("parts", [3, 8, 50])
def test_row_numbers(many, parts):
    got = row_numbers(many, ["k", "id"], "rn", parts).agg(F.count("*"), F.countDistinct("rn"), F.min("rn"), F.max("rn")).first()
    assert tuple(got) == (100_000, 100_000, 1, 100_000)
    per = row_numbers(many, ["k", "id"], "rn", parts, by=["g"])
    rows = per.groupBy("g").agg(F.count("*"), F.countDistinct("rn"), F.max("rn")).collect()
    assert len(rows) == 13 and sum(r[1] for r in rows) == 100_000 and all(r[1] == r[2] == r[3] for r in rows)


def test_running_total(many):
    got = running_total(many, ["k", "id"], "v", "s", 8).select("k", "id", "v", "s").toPandas().sort_values(["k", "id"])
    assert (got["s"].to_numpy() == got["v"].to_numpy().cumsum()).all()


def test_auc_and_roc(spark):
    r = np.random.default_rng(5)
    s = r.random(100_000)
    y = (r.random(100_000) < 0.2 + 0.4 * s).astype(int)
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame({"label": y, "score": s, "other": s * 2}))
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    pos = y.sum()
    want = (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))
    for _ in range(2):
        assert auc(df).first()["auc"] == pytest.approx(want, abs=1e-12)
    pts = roc_points(df).toPandas().sort_values("threshold", ascending=False)
    assert len(pts) == 100_000 and pts["fpr"].iloc[-1] == 1.0 and pts["tpr"].iloc[-1] == 1.0
    desc = order[::-1]
    assert np.allclose(pts["tpr"].to_numpy(), np.cumsum(y[desc]) / pos)


def test_stratified_split_is_exact_per_label(many):
    d = many.withColumn("label", F.when(F.col("id") % 10 == 0, 1).otherwise(0))
    rows = stratified_split(d, "label", "id").groupBy("label", "split").count().collect()
    assert {(r["label"], r["split"]): r["count"] for r in rows} == {(0, "train"): 72_000, (0, "test"): 18_000, (1, "train"): 8_000, (1, "test"): 2_000}


def test_draws_are_independent(spark):
    d = spark.range(200_000).select(*[draw("id", s).alias(f"d{s}") for s in (11, 13, 21, 22)], draw(F.col("id") + (1 << 31) - 1, 11).alias("far"))
    pairs = [("d11", "d13", 0.3, 0.7), ("d21", "d22", 0.6, 0.5), ("d11", "far", 0.5, 0.5)]
    got = d.agg(*[F.avg(((F.col(a) < p) & (F.col(b) < q)).cast("double")) for a, b, p, q in pairs],
                *[F.avg((F.col(a) < p).cast("double")) for a, _, p, _ in pairs]).first()
    for i, (_, _, p, q) in enumerate(pairs):
        assert abs(got[i] - p * q) < 0.01 * max(p * q, 0.3) and abs(got[3 + i] - p) < 0.005


def test_rounding(spark):
    cases = [(1.5e14, 2, 1.5e14), (2.3449996, 2, 2.34), (2.345, 2, 2.35), (2.3449999999999, 2, 2.35), (-2.345, 2, -2.35), (2.5e10, 6, 2.5e10),
             (9.3e17, 2, 9.3e17), (0.518, 9, 0.518), (None, 2, None), (-0.001, 2, 0.0), (1234567.891, 1, 1234567.9)]
    for x, d, want in cases:
        assert spark.createDataFrame([(x,)], "x double").select(rnd("x", d)).first()[0] == want, (x, d)
    big = spark.range(4).select(exact_sum(F.lit(3e13) + F.lit(0.01))).first()[0]
    assert big == pytest.approx(120000000000000.04, abs=0.02)


def test_padding_keeps_long_numbers(spark):
    got = spark.createDataFrame([(7,), (1234,), (12345,), (123456789,)], "n long").select(padded(F.col("n"), 4)).collect()
    assert [r[0] for r in got] == ["0007", "1234", "12345", "123456789"]


def test_threshold_is_never_too_high():
    r = random.Random(1)
    for _ in range(1000):
        support, lo = r.choice([0.01, 0.02, 0.05, 0.1, 0.3]), r.randint(1, 10**6)
        rows = lo * r.randint(1, 50) + r.randint(0, 1000)
        least = math.ceil(support * lo - 1e-9)
        assert math.ceil(_threshold(support, lo, rows) * rows) <= max(least, 1) and _threshold(support, lo, rows) * rows > least - 1


@pytest.mark.parametrize("method", ["fpgrowth", "levels"])
def test_itemsets_exactly_at_the_support(spark, method):
    rows = [(s, sorted({"a", "b"} if i < 30 else {"c"})) for s, n in (("x", 100), ("y", 100), (None, 100)) for i in range(n)]
    sets = spark.createDataFrame(rows, "seg string, items array<string>")
    got = frequent_itemsets(sets, 0.3, 4 if method == "fpgrowth" else 3, ["seg"], method=method).collect()
    found = {(r["seg"], tuple(r["items"])): r["count"] for r in got}
    assert found == {(s, i): n for s in ("x", "y", None) for i, n in ((("a",), 30), (("b",), 30), (("a", "b"), 30), (("c",), 70))}
