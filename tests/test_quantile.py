"""Distributed quantiles against numpy."""

import numpy as np
import pytest

from shopframe.functions.quantile import exact_quantiles, quantiles


def test_quantiles(spark):
    import pandas as pd
    r = np.random.default_rng(2)
    v = np.concatenate([r.normal(size=4000), r.integers(0, 5, 3000)])
    g = r.choice(["a", "b", "c"], len(v), p=[0.8, 0.15, 0.05])
    df = spark.createDataFrame(pd.DataFrame({"g": g, "v": v})).unionAll(spark.createDataFrame([("a", None), ("z", None), (None, 1.5), ("one", 7.0)], "g string, v double"))
    points = [0.0, 0.25, 0.5, 0.67, 0.75, 1.0]
    got = {x["g"]: [x[f"q{i}"] for i in range(6)] for x in quantiles(df, "v", points, ["g"]).collect()}
    for k in "abc":
        assert got[k] == pytest.approx(np.quantile(v[g == k], points).tolist())
    assert got["z"] == [None] * 6 and got[None] == [1.5] * 6 and got["one"] == [7.0] * 6
    assert list(quantiles(df, "v", points).first()) == pytest.approx(np.quantile(np.append(v, [1.5, 7.0]), points).tolist())


def test_no_rows(spark):
    assert quantiles(spark.createDataFrame([], "v double"), "v", [0.5]).first()[0] is None


@pytest.mark.parametrize("last, grid", [(50_000, 1000), (20, 10), (1, 4)])
def test_selection_of_many_columns(spark, last, grid):
    import pandas as pd
    r = np.random.default_rng(5)
    n = 3000
    d = pd.DataFrame({"g": r.choice(["a", "b"], n, p=[0.9, 0.1]), "x": r.normal(size=n), "heavy": np.where(r.random(n) < 0.5, 1.0, 2.0),
                      "tail": 10.0 ** r.uniform(-300, 300, n) * r.choice([-1, 1], n), "mixed": np.concatenate([np.full(n // 2 - 2, 5.0), r.integers(5, 9, 4), np.full(n - n // 2 - 2, 8.0)])})
    cols, points = ["x", "heavy", "tail", "mixed"], [0.0, 0.25, 0.5, 0.999, 1.0]
    df = spark.createDataFrame(d).unionByName(spark.createDataFrame([("none", None, None, None, None), (None, 1.0, 2.0, 3.0, 4.0)], "g string, x double, heavy double, tail double, mixed double"))
    got = {row["g"]: row for row in exact_quantiles(df, cols, points, ["g"], last, grid).collect()}
    assert set(got) == {"a", "b", "none", None}
    for g in "ab":
        for c in cols:
            assert [got[g][f"{c}_q{i}"] for i in range(len(points))] == pytest.approx(np.quantile(d[c][d.g == g], points).tolist(), rel=1e-12), (g, c)
    assert got["none"]["x_q0"] is None and got[None]["mixed_q2"] == 4.0
    whole = exact_quantiles(df, ["x"], [0.5], (), last, grid).collect()
    assert whole[0]["x_q0"] == pytest.approx(np.quantile(np.append(d.x, 1.0), 0.5))


def test_selection_without_rows(spark):
    got = exact_quantiles(spark.createDataFrame([], "a double, b int"), ["a", "b"], [0.5]).collect()
    assert [tuple(x) for x in got] == [(None, None)]
