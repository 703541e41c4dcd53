"""k-means properties: k clusters, nearest-centroid assignment, cost falls with k, Davies-Bouldin brute force."""

import math
import random

from pyspark.sql import functions as F

from shopframe.operators import clustering as cl
from shopframe.operators.features import standardize


def _blobs(spark, n=300, seed=3):
    rnd = random.Random(seed)
    centres = [(0.0, 0.0), (5.0, 5.0), (0.0, 8.0), (9.0, 1.0)]
    rows = []
    for i in range(n):
        cx, cy = centres[i % 4]
        rows.append((i, cx + rnd.gauss(0, 0.5), cy + rnd.gauss(0, 0.5)))
    return spark.createDataFrame(rows, "id long, x double, y double")


def test_k_clusters_and_nearest_assignment(spark):
    df = _blobs(spark)
    model, stats = cl.fit_kmeans(df, ["x", "y"], 4, seed=7)
    scored = cl.predict(model, df, ["x", "y"], stats)
    assert scored.select("cluster_id").distinct().count() == 4
    # every row sits at its nearest centre (same arithmetic as the literal-centroid assignment)
    z = standardize(df, ["x", "y"], stats)
    mine = cl.assign_clusters(z, cl.centroids_of(model, ["x", "y"]), ["x", "y"], "mine")
    j = scored.select("id", "cluster_id").join(mine.select("id", "mine"), "id")
    assert j.filter(F.col("cluster_id") != F.col("mine")).count() == 0


def test_cost_does_not_increase_with_k(spark):
    df = _blobs(spark)
    costs = [cl.fit_kmeans(df, ["x", "y"], k, seed=7)[0].summary.trainingCost for k in (2, 3, 4)]
    assert costs[0] >= costs[1] >= costs[2]


def test_davies_bouldin_brute_force(spark):
    pts = [(0, 0.0, 0.0), (0, 0.0, 2.0), (1, 5.0, 0.0), (1, 7.0, 0.0), (2, 0.0, 9.0), (2, 1.0, 9.0)]
    df = spark.createDataFrame(pts, "cluster_id int, x double, y double")
    got = cl.davies_bouldin(df, ["x", "y"]).first()[0]
    groups = {}
    for c, x, y in pts:
        groups.setdefault(c, []).append((x, y))
    cen = {c: (sum(p[0] for p in v) / len(v), sum(p[1] for p in v) / len(v)) for c, v in groups.items()}
    s = {c: sum(math.dist(p, cen[c]) for p in v) / len(v) for c, v in groups.items()}
    exp = sum(max((s[i] + s[j]) / math.dist(cen[i], cen[j]) for j in cen if j != i) for i in cen) / len(cen)
    assert abs(got - exp) < 1e-12
