"""K-means segmentation, cluster quality, naming and incremental updates.

Model fitting is Spark ML ``KMeans`` (k-means|| init, distributed Lloyd
steps). Everything around it is DataFrame expressions: scaling with the
population std (F37), nearest-centroid assignment with the centroids as a
literal array (k x d model parameters, no join), Davies-Bouldin from
per-cluster aggregates, naming rules as ``when`` chains.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopframe.operators.features import scaling_stats, standardize
from shopframe.session import materialize
from shopframe.functions.quantile import group_quantiles
from shopframe.functions.silhouette import SAMPLE, silhouette

STYLE_COLS = ["pct_ladieswear", "pct_divided", "pct_menswear", "pct_baby", "pct_sport", "pct_online", "avg_price"]

# ---------------------------------------------------------------- fixed values
# Cluster names of the application rule (C5), in rule order, and its fallback prefix.
THRESHOLD_NAMES = ("Family/Moms", "Sporty Active", "Menswear", "GenZ Trend", "Classic Ladieswear", "Mixed (top: ")
# Cluster names of the notebook rule (C6), in rule order.
NOTEBOOK_NAMES = ("Family/Moms", "GenZ Trend", "Menswear", "Sporty Active", "Classic Offline", "Classic Online")
# Portfolio segments (C8): high margin & volume, low margin & high volume, high margin & low volume, rest.
PORTFOLIO_NAMES = ("Stars", "Cash Cows", "Question Marks", "Dogs")


def _vec(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def fit_kmeans(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42, max_iter: int = 50,
               scale: bool = True):
    """Fit k-means on ``cols`` (z-scored with the population std when ``scale``).

    Returns ``(model, stats)``; ``stats`` is the one-row scaling frame (or None).
    """
    from pyspark.ml.clustering import KMeans
    # Lloyd iterations re-read the input: fit on a stored copy, not on the feature lineage
    df = materialize(df.select(*cols))
    stats = materialize(scaling_stats(df, cols)) if scale else None
    x = standardize(df, cols, stats) if scale else df
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster_id") \
        .fit(_vec(x, cols))
    return model, stats


def centroids_of(model, cols: Sequence[str]) -> list[list[float]]:
    """Model centres as plain lists (k x d parameters, already on the driver)."""
    return [[float(v) for v in c] for c in model.clusterCenters()]


def assign_clusters(df: DataFrame, centroids: Sequence[Sequence[float]], cols: Sequence[str],
                    out: str = "cluster_id") -> DataFrame:
    """C4: nearest centroid (squared Euclidean; ties to the lower id) for every row.

    The k centroids enter as literals, so assignment is a projection: no
    shuffle, no join, and the same arithmetic can be written in SQL.
    """
    dists = []
    for i, c in enumerate(centroids):
        d = None
        for col, v in zip(cols, c):
            term = (F.col(col) - F.lit(float(v))) * (F.col(col) - F.lit(float(v)))
            d = term if d is None else d + term
        dists.append(F.struct(d.alias("d"), F.lit(i).alias("c")))
    best = F.array_min(F.array(*dists))
    return df.withColumn(out, best["c"]).withColumn(f"{out}_distance", best["d"])


def assign_clusters_sql(cols: Sequence[str], centroids: Sequence[Sequence[float]], src: str) -> str:
    """DuckDB twin of ``assign_clusters`` (CASE argmin, ties to the lower id)."""
    ds = []
    for c in centroids:
        ds.append(" + ".join(f"({col} - {float(v)!r}) * ({col} - {float(v)!r})" for col, v in zip(cols, c)))
    k = len(ds)
    whens = []
    for i in range(k - 1):
        conds = " AND ".join(f"d{i} <= d{j}" for j in range(i + 1, k) if j != i)
        conds_prev = " AND ".join(f"d{i} < d{j}" for j in range(0, i))
        cond = " AND ".join(x for x in (conds_prev, conds) if x)
        whens.append(f"WHEN {cond} THEN {i}")
    case = "CASE " + " ".join(whens) + f" ELSE {k - 1} END"
    dsel = ", ".join(f"{d} AS d{i}" for i, d in enumerate(ds))
    return f"SELECT *, {case} AS cluster_id FROM (SELECT *, {dsel} FROM {src}) z"


def predict(model, df: DataFrame, cols: Sequence[str], stats: DataFrame | None) -> DataFrame:
    """Score rows with a fitted model (same scaling as at fit time)."""
    x = standardize(df, cols, stats) if stats is not None else df
    return model.transform(_vec(x, cols)).drop("features")


def unscaled_centroids(model, cols: Sequence[str], stats: DataFrame | None) -> DataFrame:
    """Centroids back in feature units: one row per cluster (``cluster_id`` + cols)."""
    spark = stats.sparkSession if stats is not None else None
    rows = [(i, *c) for i, c in enumerate(centroids_of(model, cols))]
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    cdf = spark.createDataFrame(rows, ["cluster_id", *cols])
    if stats is None:
        return cdf
    out = cdf.crossJoin(stats)
    for c in cols:
        out = out.withColumn(c, F.col(c) * F.coalesce(F.nullif(F.col(f"{c}__std"), F.lit(0.0)), F.lit(1.0))
                             + F.col(f"{c}__mean"))
    return out.select("cluster_id", *cols)


# ---------------------------------------------------------------- naming

def label_by_threshold(centroids: DataFrame, cols: Sequence[str] = STYLE_COLS) -> DataFrame:
    """Baby / sport / men / divided / ladies share above .40, else 'Mixed (top: <feature>)'.

    The top feature is the largest centroid value over all columns, price included.
    """
    top = F.array_max(F.array(*[F.struct(F.col(c).alias("v"), F.lit(c).alias("n")) for c in cols]))["n"]
    n = THRESHOLD_NAMES
    lab = (F.when(F.col("pct_baby") > 0.40, n[0]).when(F.col("pct_sport") > 0.40, n[1])
           .when(F.col("pct_menswear") > 0.40, n[2]).when(F.col("pct_divided") > 0.40, n[3])
           .when(F.col("pct_ladieswear") > 0.40, n[4])
           .otherwise(F.concat(F.lit(n[5]), top, F.lit(")"))))
    return centroids.withColumn("cluster_label", lab)


def label_by_threshold_nb(profile: DataFrame) -> DataFrame:
    """Notebook naming on percentage profiles (0-100)."""
    n = NOTEBOOK_NAMES
    lab = (F.when(F.col("pct_baby") > 30, n[0]).when(F.col("pct_divided") > 40, n[1])
           .when(F.col("pct_menswear") > 40, n[2]).when(F.col("pct_sport") > 20, n[3])
           .when(F.col("pct_online") < 50, n[4]).otherwise(n[5]))
    return profile.withColumn("cluster_name", lab)


def label_by_rank(assigned: DataFrame, metric: str, names: Sequence[str], cluster: str = "cluster_id",
                  top_flag: str | None = "is_vip") -> DataFrame:
    """Clusters ordered by mean ``metric`` (ascending) get ``names``; the top cluster is flagged."""
    means = assigned.groupBy(cluster).agg(F.avg(metric).alias("_m"))
    ranked = means.withColumn("_r", F.row_number().over(Window.orderBy("_m", cluster)) - 1)
    lut = F.array(*[F.lit(n) for n in names])
    ranked = ranked.withColumn("segment", F.element_at(lut, F.col("_r") + 1))
    if top_flag:
        ranked = ranked.withColumn(top_flag, (F.col("_r") == len(names) - 1).cast("int"))
    return assigned.join(F.broadcast(ranked.drop("_m", "_r")), cluster)  # k rows


def portfolio_segment(products: DataFrame, cluster: str = "cluster_id",
                      x: str = "margin_amount", y: str = "sales_volume") -> DataFrame:
    """Stars / Cash Cows / Question Marks / Dogs against the median of the cluster means."""
    cm = products.groupBy(cluster).agg(F.avg(x).alias("_x"), F.avg(y).alias("_y"))
    th = cm.agg(F.percentile("_x", 0.5).alias("_tx"), F.percentile("_y", 0.5).alias("_ty"))
    j = products.crossJoin(th)
    hx, hy = F.col(x) > F.col("_tx"), F.col(y) > F.col("_ty")
    n = PORTFOLIO_NAMES
    seg = F.when(hx & hy, n[0]).when(~hx & hy, n[1]).when(hx & ~hy, n[2]).otherwise(n[3])
    return j.withColumn("segment", seg).drop("_tx", "_ty")


def portfolio_summary(seg: DataFrame, x: str = "margin_amount", y: str = "sales_volume") -> DataFrame:
    """Products, mean margin, mean volume and total margin x volume per segment."""
    return seg.groupBy("segment").agg(
        F.count(F.lit(1)).alias("num_products"), F.avg(x).alias("avg_margin"), F.avg(y).alias("avg_volume"),
        F.sum(F.col(x) * F.col(y)).alias("total_profit"))


def cluster_profile(assigned: DataFrame, mean_cols: Sequence[str], median_cols: Sequence[str] = (),
                    cluster: str = "cluster_id", key: str | None = None) -> DataFrame:
    """Size, medians, means and share of the base per cluster."""
    total = assigned.agg(F.count(F.lit(1)).alias("_n"))
    g = assigned.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n_customers"), *[F.avg(c).alias(c) for c in mean_cols])
    if median_cols:
        m = group_quantiles(assigned, median_cols, [0.5], [cluster])
        m = m.select(F.col(cluster).alias("_c"), *[F.col(f"{c}_q0").alias(f"median_{c}") for c in median_cols])
        g = g.join(m, F.col(cluster).eqNullSafe(F.col("_c"))).select(cluster, "n_customers", *[f"median_{c}" for c in median_cols], *mean_cols)
    return g.crossJoin(total).withColumn("pct_of_base", F.col("n_customers") * 100.0 / F.col("_n")).drop("_n")


TIER_NAMES = ["Budget", "Mid-range", "Premium"]


def product_tiers(margin: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """C11: k-means on price, cost, margin; clusters named by mean price."""
    cols = ["retail_price", "cost", "margin_pct"]
    model, stats = fit_kmeans(margin, cols, k, seed)
    scored = predict(model, margin, cols, stats)
    named = label_by_rank(scored, "retail_price", TIER_NAMES[:k] if k == 3 else [f"tier_{i}" for i in range(k)],
                          top_flag=None)
    return named.withColumnRenamed("segment", "price_tier")


def tier_summary(tiers: DataFrame) -> DataFrame:
    return tiers.groupBy("price_tier").agg(
        F.count(F.lit(1)).alias("num_products"), F.avg("retail_price").alias("avg_price"),
        F.avg("cost").alias("avg_cost"), F.avg("margin_pct").alias("avg_margin_pct"))


def top_categories_per_tier(tiers: DataFrame, n: int = 8) -> DataFrame:
    """Product counts per (tier, category) for the n largest categories."""
    big = tiers.groupBy("category").agg(F.count(F.lit(1)).alias("_c")) \
        .orderBy(F.desc("_c"), "category").limit(n).select("category")
    return tiers.join(big, "category", "left_semi").groupBy("price_tier", "category") \
        .agg(F.count(F.lit(1)).alias("num_products"))


def segments(df: DataFrame, cols: Sequence[str], k: int = 4, seed: int = 42, rank_metric: str | None = None,
             names: Sequence[str] | None = None) -> DataFrame:
    """K-means segments on any feature frame, optionally named by rank of a metric."""
    base = materialize(df.dropna(subset=list(cols)))
    model, stats = fit_kmeans(base, cols, k, seed)
    scored = predict(model, base, cols, stats)
    if rank_metric:
        scored = label_by_rank(scored, rank_metric, names or [f"segment_{i}" for i in range(k)])
    return scored


# ---------------------------------------------------------------- quality

def davies_bouldin(assigned: DataFrame, cols: Sequence[str], cluster: str = "cluster_id") -> DataFrame:
    """Mean over clusters of max_j (s_i + s_j) / d(c_i, c_j).

    Centroids and scatters are per-cluster aggregates; the k x k comparison
    happens on one row of collected (k-sized) arrays.
    """
    cen = assigned.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in cols])
    j = assigned.join(cen.select(cluster, *[F.col(c).alias(f"_c_{c}") for c in cols]), cluster)
    dist = F.sqrt(sum(((F.col(c) - F.col(f"_c_{c}")) * (F.col(c) - F.col(f"_c_{c}")) for c in cols), F.lit(0.0)))
    s = j.groupBy(cluster).agg(F.avg(dist).alias("s"))
    cs = cen.join(s, cluster).select(F.struct(cluster, "s", F.array(*cols).alias("v")).alias("c"))
    arr = cs.agg(F.collect_list("c").alias("cs"))
    expr = F.expr("""aggregate(transform(cs, a -> array_max(transform(filter(cs, b -> b.{k} != a.{k}),
        b -> (a.s + b.s) / sqrt(aggregate(zip_with(a.v, b.v, (x, y) -> (x - y) * (x - y)), 0D, (acc, z) -> acc + z))))),
        0D, (acc, z) -> acc + z) / size(cs)""".format(k=cluster))
    return arr.select(expr.alias("davies_bouldin"))


def inertia(assigned: DataFrame, model, cols: Sequence[str]) -> float:
    return float(model.summary.trainingCost)


def select_k(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = range(2, 8), seed: int = 42,
             sample: int | None = None, key: str | None = None, silhouette_sample: int = SAMPLE) -> DataFrame:
    """Inertia, Euclidean silhouette and Davies-Bouldin per k.

    The loop runs over the candidate k values (parameters); each fit is a
    distributed job over the (optionally sampled) rows. The silhouette is that
    of at most ``silhouette_sample`` rows (``functions.silhouette``).
    """
    from shopframe.operators.features import sample_customers
    x = sample_customers(df, sample, seed, key) if (sample and key) else df
    x = materialize(x.select(*cols))
    stats = scaling_stats(x, cols)
    z = materialize(_vec(standardize(x, cols, stats), cols))
    rows = []
    from pyspark.ml.clustering import KMeans
    for k in ks:
        m = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster_id").fit(z)
        p = m.transform(z)
        db = davies_bouldin(p, cols).first()[0]
        rows.append((int(k), float(m.summary.trainingCost), silhouette(p, cols, sample=silhouette_sample, seed=seed).first()[0], float(db)))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, davies_bouldin double")


def cluster_certificate(model, df: DataFrame, cols: Sequence[str], stats: DataFrame | None) -> DataFrame:
    """One row that proves a fit without knowing its centres: ``n_rows, n_clusters``, how many rows
    are not assigned to their nearest centre, and how many centres are off the mean of their rows.

    Lloyd's last step leaves centres at the means of the assignment before it,
    so a centre counts as off if it is more than 0.01 (of a standard deviation,
    where columns are scaled) from the mean in any column.
    """
    scored = predict(model, df, cols, stats)  # its columns are scaled
    zs, centres = list(cols), centroids_of(model, cols)
    near = assign_clusters(scored.withColumnRenamed("cluster_id", "_given"), centres, zs, "_nearest")
    gap = lambda c: sum(((F.col(n) - F.lit(v)) * (F.col(n) - F.lit(v)) for n, v in zip(zs, centres[c], strict=True)), F.lit(0.0))
    far = F.array(*[gap(c) for c in range(len(centres))])
    worse = F.get(far, F.col("_given")) > F.get(far, F.col("_nearest")) + 1e-9
    means = near.groupBy("_given").agg(*[F.avg(n).alias(n) for n in zs], F.count(F.lit(1)).alias("_n"), F.count_if(worse).alias("_worse"))
    off = F.lit(False)
    for i, n in enumerate(zs):
        off = off | (F.abs(F.col(n) - F.get(F.array(*[F.lit(c[i]) for c in centres]), F.col("_given"))) > 1e-2)
    return means.agg(F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_clusters"), F.sum("_worse").alias("n_not_nearest"), F.count_if(off).alias("n_centres_off"))


# ---------------------------------------------------------------- incremental

def update_clusters(batch: DataFrame, centroids: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One mini-batch step from the active centroids.

    ``centroids``: cluster_id, cols..., n (points absorbed so far). The batch
    is assigned to the nearest centroid; each centroid moves to the weighted
    mean of its old position (weight n) and its new points.
    """
    cen_rows = centroids.orderBy("cluster_id").collect()  # k rows of model parameters
    cvals = [[r[c] for c in cols] for r in cen_rows]
    a = assign_clusters(batch, cvals, cols)
    agg = a.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("_m"), *[F.sum(c).alias(f"_s_{c}") for c in cols])
    j = centroids.join(agg, "cluster_id", "left").na.fill(0, subset=["_m"])
    out = j.select("cluster_id", *[((F.col(c) * F.col("n") + F.coalesce(F.col(f"_s_{c}"), F.lit(0.0)))
                                   / F.greatest(F.col("n") + F.col("_m"), F.lit(1))).alias(c) for c in cols],
                   (F.col("n") + F.col("_m")).alias("n"))
    return out


def cluster_lookup(customers: DataFrame, stored: DataFrame, features: DataFrame,
                   centroids: Sequence[Sequence[float]], cols: Sequence[str]) -> DataFrame:
    """Stored assignment when present, else the nearest active centroid from features."""
    scored = assign_clusters(features, centroids, cols).select("customer_id", F.col("cluster_id").alias("_computed"))
    j = customers.select("customer_id").join(stored.select("customer_id", F.col("cluster_id").alias("_stored")),
                                             "customer_id", "left").join(scored, "customer_id", "left")
    return j.select("customer_id", F.coalesce("_stored", "_computed").alias("cluster_id"),
                    F.when(F.col("_stored").isNotNull(), "stored").when(F.col("_computed").isNotNull(), "computed")
                    .alias("source"))


def style_clusters(dna: DataFrame, k: int = 5, seed: int = 42, sample: int | None = None) -> tuple:
    """Scale, fit on an optional sample, name by thresholds, assign every customer.

    Returns ``(assignments, named_centroids, model, stats)``.
    """
    from shopframe.operators.features import sample_customers
    fit_on = sample_customers(dna, sample, seed) if sample else dna
    model, stats = fit_kmeans(fit_on, STYLE_COLS, k, seed)
    named = label_by_threshold(unscaled_centroids(model, STYLE_COLS, stats))
    scored = predict(model, dna, STYLE_COLS, stats)
    out = scored.join(named.select("cluster_id", "cluster_label"), "cluster_id")
    return out, named, model, stats
