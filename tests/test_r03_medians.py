"""Medians from counted values."""

import numpy as np
from pyspark.sql import functions as F

from shopframe.functions.quantile import counted_quantiles
from shopframe.operators import features as f


def test_medians_of_few_and_many_values(spark):
    x = [float(i * 37 % 101) for i in range(500)] + [None, float("nan")]
    df = spark.createDataFrame([(i,) for i in x], "x double")
    clean = [i for i in x if i is not None and i == i]
    for small in (10, 1000):
        got = counted_quantiles(df, "x", [0.25, 0.5, 0.9], small).first()
        assert np.allclose(list(got), np.percentile(clean, [25, 50, 90]))
        assert counted_quantiles(df.where("x IS NULL"), "x", [0.5], small).first()[0] is None
    filled = f.impute(df.selectExpr("x", "CAST(NULL AS STRING) AS s"), median_cols=["x"], text_cols=["s"]).where("NOT isnan(x)")
    assert filled.count() == 501 and filled.where("s = 'Unknown'").count() == 501
    assert filled.agg(F.max("x")).first()[0] == 100.0
