"""Splits, weights, classifiers, exact metrics, incremental forests, scoring.

Training is Spark ML (distributed tree / linear learners). Metrics are exact
DataFrame computations: AUC is the rank-sum statistic with tied scores
sharing ranks, computed from per-score label counts and a distributed
running total (no single-partition window), so it scales with the number of
distinct scores, not with one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopframe.functions.exprs import draw
from shopframe.functions.prefix import row_numbers, running_total
from shopframe.session import Work, materialize


def _n() -> Column:
    return F.count(F.lit(1))


# ---------------------------------------------------------------- P1-P2

def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.2, seed: int = 42,
                     stratify: bool = True, store: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """Adds ``split`` ('train'/'test'): of every label the same share, to the row, is for training.

    Rows are ordered by a keyed draw and numbered within their label
    (distributed, a label may hold most rows); the first
    ``n_label - round(test_frac * n_label)`` train. ``stratify=False`` splits
    the whole frame that way. The ordered rows are kept by ``store``.
    """
    by = [label] if stratify else []
    r = row_numbers(df.withColumn("_u", draw(key, seed)), ["_u", key], "_rn", by=by, store=store)
    n = r.groupBy(*[F.col(c).alias("_l") for c in by]).agg(_n().alias("_n"))
    n = F.broadcast(n)  # one row per label, or one row; the rows are not dealt by label for this join
    r = r.join(n, F.col(label).eqNullSafe(F.col("_l"))) if stratify else r.crossJoin(n)
    n_test = F.floor(F.lit(test_frac) * F.col("_n") + 0.5)
    return r.withColumn("split", F.when(F.col("_rn") <= F.col("_n") - n_test, "train").otherwise("test")) \
        .drop("_u", "_rn", "_n", "_l")


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weight n / (classes * n_class) per row (the 'balanced' class weight)."""
    c = df.groupBy(label).agg(_n().alias("_nc"))
    tot = c.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = c.crossJoin(tot).select(label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label)  # one row per class


def pos_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives / positives (boosting's scale_pos_weight), one row."""
    return df.agg(F.try_divide(F.count_if(F.col(label) == 0).cast("double"), F.count_if(F.col(label) == 1))
                  .alias("pos_weight"))


# ---------------------------------------------------------------- P3-P10 learners

#: training rows of one task: a forest keeps a count per row and tree, so a row of 200 trees takes about 1 KB
FOREST_ROWS, BOOSTED_ROWS = 50_000, 500_000


def training_copy(df: DataFrame, *keys: str, rows: int = FOREST_ROWS, work: Work | None = None, spent: Sequence[str] = ()) -> DataFrame:
    """A stored copy for learners, which pass over it many times; no task of it holds many more than ``rows`` rows.

    Adaptive execution sizes its tasks by compressed bytes; a learner's copy of
    a row is many times larger. Rows are dealt by ``keys`` only where a task holds more.
    With ``work`` the copy is its table ``split``, which takes a fraction of a checkpoint's disk
    and is dropped once its rows are dealt; its tables ``spent``, from which ``df`` comes, go before.
    """
    stored = work.store(df, "split") if work else materialize(df)
    if work:
        work.drop(*spent)
    per = stored.groupBy(F.spark_partition_id().alias("_p")).agg(_n().alias("_n")).agg(F.sum("_n"), F.max("_n")).first()
    if (per[1] or 0) <= rows:
        return stored
    dealt = materialize(stored.repartition(-(-per[0] // rows), *keys))
    if work:
        work.drop("split")
    return dealt


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def train_forest(df: DataFrame, label: str, num_trees: int = 200, max_depth: int = 8, subsample: float = 0.4,
                 weight: str | None = None, seed: int = 42, min_leaf: int = 1):
    """Random forest (binary or multiclass) on an assembled ``features`` column."""
    from pyspark.ml.classification import RandomForestClassifier
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees, maxDepth=max_depth,
                                subsamplingRate=subsample, seed=seed, minInstancesPerNode=min_leaf)
    if weight:
        rf = rf.setWeightCol(weight)
    return rf.fit(df)


def train_tree(df: DataFrame, label: str, max_depth: int = 3, min_leaf: int = 50, weight: str | None = None,
               seed: int = 42):
    """Explanatory decision tree; ``model.toDebugString`` gives the rules."""
    from pyspark.ml.classification import DecisionTreeClassifier
    dt = DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=max_depth,
                                minInstancesPerNode=min_leaf, seed=seed)
    if weight:
        dt = dt.setWeightCol(weight)
    return dt.fit(df)


def train_logistic(df: DataFrame, label: str, weight: str | None = None, max_iter: int = 100):
    """P5: weighted logistic regression baseline (on standardised features)."""
    from pyspark.ml.classification import LogisticRegression
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter, standardization=True)
    if weight:
        lr = lr.setWeightCol(weight)
    return lr.fit(df)


def train_boosted(df: DataFrame, label: str, num_trees: int = 100, max_depth: int = 6, step: float = 0.1,
                  weight: str | None = None, seed: int = 42):
    """Gradient-boosted trees in place of XGBoost."""
    from pyspark.ml.classification import GBTClassifier
    gbt = GBTClassifier(labelCol=label, featuresCol="features", maxIter=num_trees, maxDepth=max_depth,
                        stepSize=step, seed=seed)
    if weight:
        gbt = gbt.setWeightCol(weight)
    return gbt.fit(df)


def tabular_pipeline(num_cols: Sequence[str], cat_cols: Sequence[str], learner):
    """Index text columns (sorted, unseen -> extra index), assemble, learn - one Pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_enc", handleInvalid="keep", stringOrderType="alphabetAsc")
           for c in cat_cols]
    va = VectorAssembler(inputCols=list(num_cols) + [f"{c}_enc" for c in cat_cols], outputCol="features",
                         handleInvalid="keep")
    return Pipeline(stages=idx + [va, learner])


def context_pipeline(cat_cols: Sequence[str], label: str, max_depth: int = 4, seed: int = 42):
    """One-hot contexts (unseen value -> all zeros) + depth-4 tree."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler
    from shopframe.operators.features import one_hot_pipeline
    oh = one_hot_pipeline(cat_cols)
    va = VectorAssembler(inputCols=[f"{c}_vec" for c in cat_cols], outputCol="features")
    dt = DecisionTreeClassifier(labelCol=label, featuresCol="features", maxDepth=max_depth, seed=seed)
    return Pipeline(stages=oh.getStages() + [va, dt])


def score_contexts(model, contexts: DataFrame) -> DataFrame:
    """P10: predicted label for each given context row."""
    return model.transform(contexts).select(*contexts.columns, "prediction")


def positive_probability(scored: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1 from a Spark ML ``probability`` vector."""
    from pyspark.ml.functions import vector_to_array
    return scored.withColumn(out, vector_to_array("probability")[1])


# ---------------------------------------------------------------- P11-P18 metrics

def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC (trapezoid = rank-sum with tied scores sharing ranks), one row.

    AUC * P * N = sum over distinct scores s of pos(s) * (neg(<s) + neg(s) / 2).
    """
    per = df.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_q"))
    cum = running_total(per, [score], "_q", "_qcum")
    num = cum.agg(F.sum(F.col("_p") * (F.col("_qcum") - F.col("_q") + F.col("_q") / 2.0)).alias("_num"),
                  F.sum("_p").alias("_tot_pos"), F.sum("_q").alias("_tot_neg"))
    return num.select(F.try_divide(F.col("_num"), F.col("_tot_pos") * F.col("_tot_neg")).alias("auc"),
                      F.col("_tot_pos").alias("n_pos"), F.col("_tot_neg").alias("n_neg"))


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, thresholds descending."""
    per = df.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_q"))
    c1 = running_total(per, [F.col(score).desc()], "_p", "_tp")
    c2 = running_total(c1, [F.col(score).desc()], "_q", "_fp")
    tot = per.agg(F.sum("_p").alias("_tot_pos"), F.sum("_q").alias("_tot_neg"))
    return c2.crossJoin(tot).select(F.col(score).alias("threshold"),
                                    F.try_divide(F.col("_fp"), F.col("_tot_neg")).alias("fpr"),
                                    F.try_divide(F.col("_tp"), F.col("_tot_pos")).alias("tpr"))


def macro_ovr_auc(df: DataFrame, label: str, prob: str = "probability", classes: Sequence = (0, 1, 2),
                  gate: float = 0.70) -> DataFrame:
    """One-vs-rest AUC per class and their mean; ``passed`` when the mean exceeds ``gate``."""
    from pyspark.ml.functions import vector_to_array
    arr = df.withColumn("_pa", vector_to_array(prob)) if dict(df.dtypes)[prob] != "array<double>" else \
        df.withColumn("_pa", F.col(prob))
    parts = []
    for i, c in enumerate(classes):
        x = arr.select((F.col(label) == c).cast("int").alias("_y"), F.col("_pa")[i].alias("_s"))
        parts.append(auc(x, "_y", "_s").select(F.lit(str(c)).alias("class"), "auc"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    mean = out.agg(F.lit("macro").alias("class"), F.avg("auc").alias("auc"))
    return out.unionByName(mean).withColumn("passed", F.when(F.col("class") == "macro", F.col("auc") > gate))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Label x prediction counts."""
    return df.groupBy(label, pred).agg(_n().alias("n"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Precision, recall, F1, support per class; accuracy; macro and weighted averages.

    Zero divisions give 0. Built from the confusion counts (one small aggregate).
    """
    cm = confusion_matrix(df, label, pred)
    tp = cm.filter(F.col(label) == F.col(pred)).select(F.col(label).alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy(F.col(label).alias("cls")).agg(F.sum("n").alias("support"))
    predn = cm.groupBy(F.col(pred).alias("cls")).agg(F.sum("n").alias("predicted"))
    classes = sup.select("cls").union(predn.select("cls")).distinct()
    j = classes.join(tp, "cls", "left").join(sup, "cls", "left").join(predn, "cls", "left").na.fill(0)
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    per = j.select(F.col("cls").cast("string").alias("class"), p.alias("precision"), r.alias("recall"), "support",
                   "tp")
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    tot = per.agg(F.sum("support").alias("_n"), F.sum("tp").alias("_tp"))
    acc = tot.select(F.lit("accuracy").alias("class"), (F.col("_tp") / F.col("_n")).alias("precision"),
                     (F.col("_tp") / F.col("_n")).alias("recall"), (F.col("_tp") / F.col("_n")).alias("f1"),
                     F.col("_n").alias("support"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    wt = per.agg(F.lit("weighted avg").alias("class"),
                 (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                 (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                 (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
                 F.sum("support").alias("support"))
    cols = ["class", "precision", "recall", "f1", "support"]
    return per.select(*cols).unionByName(acc.select(*cols)).unionByName(macro.select(*cols)) \
        .unionByName(wt.select(*cols))


def feature_importance(model, names: Sequence[str], spark) -> DataFrame:
    """Features by importance (model parameters, not data)."""
    imp = model.featureImportances.toArray().tolist()
    rows = sorted(zip(names, [float(x) for x in imp]), key=lambda x: -x[1])
    return spark.createDataFrame(rows, "feature string, importance double")


def compare_models(rows: Sequence[tuple], spark) -> DataFrame:
    """(model, auc_train, auc_test, recall) rows -> gap and best-by-test-AUC flag."""
    df = spark.createDataFrame(list(rows), "model string, auc_train double, auc_test double, recall double")
    best = df.agg(F.max("auc_test").alias("_b"))
    return df.crossJoin(best).withColumn("gap", F.col("auc_train") - F.col("auc_test")) \
        .withColumn("is_best", F.col("auc_test") == F.col("_b")).drop("_b")


def auc_gate(auc_df: DataFrame, lo: float = 0.55, hi: float = 0.85) -> DataFrame:
    """PASS when lo < AUC < hi."""
    return auc_df.withColumn("gate", F.when((F.col("auc") > lo) & (F.col("auc") < hi), "PASS").otherwise("FAIL"))


def label_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per label value."""
    from shopframe.functions.exprs import share
    return df.groupBy(label).agg(_n().alias("n")).withColumn("pct", share("n"))


# ---------------------------------------------------------------- P19-P20

class ForestEnsemble:
    """A forest grown in steps; old trees are kept, new trees are trained on current data.

    Spark ML has no warm start, so each step trains an n-tree forest and the
    ensemble scores with the tree-count-weighted mean of member probabilities
    (the same as averaging all trees). ``parent`` records the previous version.
    """

    def __init__(self, members=None, parent: str | None = None):
        self.members = list(members or [])  # (model, n_trees)
        self.parent = parent

    @property
    def n_trees(self) -> int:
        return sum(n for _, n in self.members)

    def extend(self, df: DataFrame, label: str, n: int = 20, **kw) -> ForestEnsemble:
        m = train_forest(df, label, num_trees=n, **kw)
        return ForestEnsemble(self.members + [(m, n)], parent=self.parent)

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        total = float(self.n_trees)
        x = df
        terms = []
        for i, (m, n) in enumerate(self.members):
            x = m.transform(x).withColumn(f"_p{i}", vector_to_array("probability")[1] * (n / total)) \
                .drop("rawPrediction", "probability", "prediction")
            terms.append(F.col(f"_p{i}"))
        s = terms[0]
        for t in terms[1:]:
            s = s + t
        return x.withColumn(out, s).drop(*[f"_p{i}" for i in range(len(self.members))])


def score_will_buy(model, features: DataFrame, cols: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """P20: probability and 0/1 for every customer; missing features count as 0."""
    x = assemble(features.na.fill(0, subset=list(cols)), cols)
    s = positive_probability(model.transform(x), "proba")
    return s.select("customer_id", "proba", (F.col("proba") >= threshold).cast("int").alias("will_buy"))
