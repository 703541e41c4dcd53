"""Euclidean silhouette against a direct computation."""

import numpy as np
import pytest

from shopframe.functions import silhouette as s


def direct(x, c):
    out = []
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        own = c == c[i]
        if own.sum() == 1 or len(set(c)) == 1:
            out.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[c == k].mean() for k in set(c) if k != c[i])
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


@pytest.mark.parametrize("k", [1, 2, 5])
def test_500_rows(spark, k):
    import pandas as pd
    r = np.random.default_rng(k)
    x = r.normal(size=(500, 3)) + r.integers(0, 4, 500)[:, None]
    c = r.integers(0, k, 500) * 3 + 1
    c[0] = 99  # a row alone in its cluster
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "cluster_id": c})).repartition(7)
    got = s.silhouette(df, ["a", "b", "c"]).first()
    assert got["silhouette"] == pytest.approx(direct(x, c), abs=1e-12) and got["n_sample"] == 500
    part = s.silhouette(df, ["a", "b", "c"], sample=100).first()
    assert part["n_sample"] == 100 and part == s.silhouette(df.repartition(3), ["a", "b", "c"], sample=100).first()


def test_no_rows(spark):
    df = spark.createDataFrame([], "a double, cluster_id int")
    assert tuple(s.silhouette(df, ["a"]).first()) == (None, 0)
