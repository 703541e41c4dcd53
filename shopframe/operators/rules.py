"""Frequent itemsets, association rules, per-segment mining, recommendations.

Mining runs for every segment (cluster, department, tier, ...) in one plan:
the segment columns ``by`` are carried as grouping keys, never looped over
on the driver.

Itemsets up to three items (or any length with ``method="bitmap"``) use a
level-wise count over *distinct basket patterns* (identical baskets are counted
once with a weight) turned into vertical bitmaps (``functions.itemsets``): no
pair or triple of a basket is listed. Longer itemsets use Spark ML FP-Growth
(parallel FP-growth) with segment-prefixed items, so all segments share one
run. Rules take any split of an itemset into antecedent and consequent
(multi-item consequents), unlike ``FPGrowthModel.associationRules``; the
consequents are grown item by item. A null segment is a segment of its own
throughout.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopframe.functions.baskets import item_sets, patterns, pair_array
from shopframe.functions.exprs import rnd
from shopframe.functions.itemsets import groups_of, support_counts
from shopframe.session import materialize

RULE_COLS = ["antecedent", "consequent", "antecedent_support", "consequent_support", "support",
             "confidence", "lift", "leverage", "conviction"]


def _join_by(a: DataFrame, b: DataFrame, by: Sequence[str], how: str = "inner", on: Sequence[str] = ()) -> DataFrame:
    """Joins on the segment columns (a null segment is a segment of its own) and on the columns ``on``."""
    if not by and not on:
        return a.crossJoin(b) if how == "inner" else a.join(b, how=how)
    names = {c: f"_by_{c}" for c in (*by, *on)}
    other = b.select(*[F.col(c).alias(names.get(c, c)) for c in b.columns])
    same = [F.col(c).eqNullSafe(F.col(names[c])) for c in by] + [F.col(c) == F.col(names[c]) for c in on]
    return a.join(other, same, how).drop(*names.values())


def _checked(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """A stored frame, broadcast if it has at most ``limit`` rows; otherwise it is joined by a shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def basket_counts(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of baskets per segment (``n_baskets``)."""
    return sets.groupBy(*by).agg(F.count(F.lit(1)).alias("n_baskets"))


def frequent_itemsets(sets: DataFrame, min_support: float, max_len: int | None = 3,
                      by: Sequence[str] = (), items: str = "items", method: str = "auto", min_baskets: int = 0) -> DataFrame:
    """A1: all itemsets with support >= ``min_support`` per segment.

    ``sets`` has one row per basket with a sorted distinct ``items`` array.
    Output: ``by..., items, count, support`` (support base = baskets of the segment).
    ``method``: ``auto`` counts up to three items by bitmaps and longer sets by
    FP-Growth, ``bitmap`` and ``fpgrowth`` choose one for any length. Segments
    with fewer than ``min_baskets`` baskets are left out.
    """
    if method == "fpgrowth" or (method == "auto" and (max_len is None or max_len > 3)):
        # baskets are made once: the counts, every size class and its passes read them again
        sets = materialize(sets.select(*by, items))
        return materialize(_fpgrowth_itemsets(_enough(sets, by, min_baskets), min_support, max_len, by, items))
    # distinct patterns and per-level results are stored: each level reads a
    # small table instead of re-planning the baskets (bounded by distinct patterns)
    pats = materialize(patterns(sets.select(*by, F.col(items).alias("items")), "items", by))
    # one pass counts the items and, under a null item, the baskets of each segment
    single = materialize(pats.select(*by, "weight", F.size("items").alias("_size"), F.explode(F.array_append(F.array_compact("items"), F.lit(None))).alias("item"))
                         .groupBy(*by, "item").agg(F.sum("weight").alias("count"), groups_of("_size").alias("_groups")))
    segments = single.filter("item IS NULL").select(*by, F.col("count").alias("n_baskets"), "_groups")
    segments = _checked(segments.filter(F.col("n_baskets") >= min_baskets))
    dealt = _join_by(pats, segments, by).withColumn("_salt", F.pmod(F.xxhash64("items"), F.col("_groups")).cast("int"))

    def keep(df):
        df = _join_by(df, segments, by).withColumn("support", F.col("count") / F.col("n_baskets"))
        return df.filter(F.col("support") >= min_support).select(*by, "items", "count", "support")

    out = found = keep(single.filter("item IS NOT NULL").select(*by, F.array("item").alias("items"), "count"))
    level = 1
    while max_len is None or level < max_len:
        if level > 2 and found.isEmpty():
            break
        level += 1
        # sets of the level below that differ in their last item only
        groups = found.groupBy(*by, F.slice("items", 1, level - 2).alias("prefix")).agg(
            F.sort_array(F.collect_list(F.element_at("items", -1))).alias("lasts")).filter(F.size("lasts") > 1)
        groups = _join_by(groups, segments, by).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))
        found = materialize(keep(support_counts(dealt, groups, by, level)))
        out = out.unionByName(found)
    return out


def _fpgrowth_itemsets(sets, min_support, max_len, by, items):
    """FP-Growth for itemsets of any length.

    FP-Growth has one global threshold, so segments are grouped into size
    classes (powers of two of their basket count) and each class is mined in
    one run with segment-prefixed items at the threshold of its smallest
    segment - at most twice too low for any segment of the class, never a
    tiny segment's threshold applied to a huge one. The loop is over size
    classes (at most ~40), not segments; supports are then filtered exactly
    per segment.
    """
    from pyspark.ml.fpm import FPGrowth
    n = basket_counts(sets, by)
    if not by:
        rows = n.first()["n_baskets"]
        model = FPGrowth(itemsCol="items", minSupport=_threshold(min_support, rows, rows), minConfidence=1.0) \
            .fit(sets.select(F.col(items).alias("items")))
        fi = model.freqItemsets.withColumn("items", F.sort_array("items"))
        return _finish_fp(fi, n, by, min_support, max_len)
    n = n.withColumn("_class", F.floor(F.log2(F.col("n_baskets"))).cast("int"))
    classes = [r["_class"] for r in n.select("_class").distinct().collect()]  # <= ~40 values
    key = F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0003")) for c in by])
    out = None
    for cls in sorted(classes):
        seg = n.filter(F.col("_class") == cls)
        stats = seg.agg(F.sum("n_baskets").alias("tot"), F.min("n_baskets").alias("lo")).first()
        ids = F.broadcast(seg.select(*[F.col(c).alias(f"_s_{c}") for c in by]))  # segments of one class
        part = sets.join(ids, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in by], "left_semi")
        tagged = part.select(F.transform(items, lambda x: F.concat(key, F.lit("\u0002"), x)).alias("items"))
        thr = _threshold(min_support, stats["lo"], stats["tot"])
        fi = FPGrowth(itemsCol="items", minSupport=thr, minConfidence=1.0).fit(tagged).freqItemsets
        fi = fi.withColumn("_key", F.substring_index(F.element_at("items", 1), "\u0002", 1)) \
            .withColumn("items", F.sort_array(F.transform("items", lambda x: F.substring_index(x, "\u0002", -1))))
        parts = F.split("_key", "\u0001")
        for i, c in enumerate(by):
            fi = fi.withColumn(c, F.nullif(F.element_at(parts, i + 1), F.lit("\u0003")).cast(sets.schema[c].dataType))
        fi = fi.drop("_key")
        out = fi if out is None else out.unionByName(fi)
    return _finish_fp(out, n.drop("_class"), by, min_support, max_len)


def _threshold(min_support: float, smallest: int, rows: int) -> float:
    """Support over all ``rows`` that keeps every itemset of at least ``min_support`` in the smallest segment.

    The learner multiplies the support back and rounds up; half a basket less
    than the least count keeps floating point from ending one basket too high.
    """
    return max(math.ceil(min_support * smallest - 1e-9) - 0.5, 0.5) / rows


def _finish_fp(fi, n, by, min_support, max_len):
    if max_len:
        fi = fi.filter(F.size("items") <= max_len)
    fi = _join_by(fi.withColumnRenamed("freq", "count"), n, by).withColumn("support", F.col("count") / F.col("n_baskets"))
    return fi.filter(F.col("support") >= min_support).select(*by, "items", "count", "support")


def _least_confidence(metric: str, t: float) -> Column:
    """Confidence that a rule of a set with support s needs, whatever its consequent, to reach ``metric >= t``.

    A consequent is at least as frequent as the whole set, so a metric that also
    depends on the consequent's support is bounded by the set's. Growing a
    consequent lowers the confidence: below this bound no larger one can pass.
    """
    s = F.col("support")
    if metric == "confidence":
        return F.lit(float(t))
    if metric == "lift":
        return s * t
    if metric == "conviction" and t > 0:
        return 1 - (1 - s) / t
    if metric == "leverage":
        return F.when(s > t, s * s / (s - t)).otherwise(F.lit(2.0))
    return F.lit(0.0)


def association_rules(itemsets: DataFrame, metric: str = "confidence", min_threshold: float = 0.8,
                      by: Sequence[str] = ()) -> DataFrame:
    """A2: the splits of each frequent itemset into antecedent -> consequent with ``metric >= min_threshold``.

    Supports of both sides come from ``itemsets``; by downward closure they are
    there, a split with a side that is not gives no rule. Consequents grow item
    by item: one that falls below the least confidence that any rule of its set
    needs is not extended, nor is one without its antecedent's support. So the
    work follows the rules that are found, not the 2^n splits of a set of n items.
    """
    known = _checked(itemsets)
    sa = known.select(*by, F.col("items").alias("antecedent"), F.col("support").alias("antecedent_support"))
    bound = _least_confidence(metric, min_threshold) - 1e-9  # the exact test follows

    def held(candidates: DataFrame) -> DataFrame:
        c = candidates.withColumn("antecedent", F.array_except("items", "consequent"))
        c = _join_by(c, sa, by, on=["antecedent"]).withColumn("confidence", F.col("support") / F.col("antecedent_support"))
        return c.filter(F.col("confidence") >= bound)

    multi = itemsets.filter(F.size("items") >= 2).select(*by, "items", "support")
    longest = multi.agg(F.max(F.size("items"))).first()[0] or 0
    level = held(multi.select("*", F.explode(F.transform("items", lambda x: F.array(x))).alias("consequent")))
    found = level
    for size in range(2, longest):  # consequents of ``size`` items
        if longest > 3:  # deep sets: stored, and left when no consequent can grow
            level = materialize(level)
            found = level if size == 2 else found
            if level.isEmpty():
                break
        kept = level.filter(F.size("items") > size).groupBy(*by, "items", "support").agg(F.sort_array(F.collect_list("consequent")).alias("_k"))
        grown = F.flatten(F.transform("_k", lambda x, i: F.transform(
            F.filter(F.slice("_k", i + 2, F.size("_k")), lambda y: F.slice(y, 1, size - 2) == F.slice(x, 1, size - 2)),
            lambda y: F.concat(x, F.array(F.element_at(y, -1))))))
        level = held(kept.select(*by, "items", "support", F.explode(grown).alias("consequent")))
        if longest > 3:
            level = materialize(level)
        found = found.unionByName(level)
    sc = known.select(*by, F.col("items").alias("consequent"), F.col("support").alias("consequent_support"))
    r = _join_by(found, sc, by, on=["consequent"])
    r = r.withColumn("lift", F.col("confidence") / F.col("consequent_support"))
    r = r.withColumn("leverage", F.col("support") - F.col("antecedent_support") * F.col("consequent_support"))
    r = r.withColumn("conviction", F.try_divide(F.lit(1.0) - F.col("consequent_support"),
                                                F.lit(1.0) - F.col("confidence")))
    return r.filter(F.col(metric) >= min_threshold).select(*by, *RULE_COLS)


def rule_key(c: str) -> Column:
    return F.array_join(F.col(c), "|")


def top_rules(rules: DataFrame, n: int, by: Sequence[str] = (), order: Sequence[Column] | None = None) -> DataFrame:
    """Keep the first ``n`` rules per segment (lift desc by default; text keys break ties).

    Metrics are compared at 9 decimals, so rules whose lifts are equal up to
    rounding noise (a->b and b->a) are ordered by their text, deterministically.
    """
    order = list(order or [F.desc(rnd("lift", 9))]) + [rule_key("antecedent"), rule_key("consequent")]
    if not by:  # a distributed top-n; only its rows are numbered in one task
        return rules.orderBy(*order).limit(n).withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    w = Window.partitionBy(*by).orderBy(*order)
    return rules.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def _enough(sets: DataFrame, by: Sequence[str], min_baskets: int) -> DataFrame:
    if min_baskets <= 0:
        return sets
    ok = basket_counts(sets, by).filter(F.col("n_baskets") >= min_baskets).drop("n_baskets")
    return _join_by(sets, _checked(materialize(ok)), by, "left_semi") if by else \
        sets.crossJoin(ok.select(F.lit(1).alias("_ok"))).drop("_ok")


def mine_app(sets: DataFrame, by: Sequence[str] = (), min_support: float = 0.01,
             min_confidence: float = 0.20, min_baskets: int = 50, top: int = 50) -> DataFrame:
    """A3/A4: segments with >= 50 baskets; itemsets <= 3; confidence >= .2, lift > 1; top 50 by lift."""
    r = association_rules(frequent_itemsets(sets, min_support, 3, by, min_baskets=min_baskets), "confidence", min_confidence, by)
    return top_rules(r.filter(F.col("lift") > 1.0), top, by)


def rules_count(rules: DataFrame, by: Sequence[str]) -> DataFrame:
    """A4: number of rules kept per segment."""
    return rules.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rules"))


def mine_notebook(sets: DataFrame, by: Sequence[str] = (), min_support: float = 0.01, min_lift: float = 1.2,
                  min_baskets: int = 100, top: int = 5, max_len: int | None = None) -> DataFrame:
    """A5: segments with >= 100 baskets; no length cap; lift >= 1.2; top 5 by lift then confidence."""
    r = association_rules(frequent_itemsets(sets, min_support, max_len, by, min_baskets=min_baskets), "lift", min_lift, by)
    return top_rules(r, top, by, [F.desc(rnd("lift", 9)), F.desc(rnd("confidence", 9))])


def rules_vip(sets: DataFrame, min_support: float = 0.01, fallback_support: float = 0.005,
              min_confidence: float = 0.05) -> DataFrame:
    """Support .01 (falls back to .005 when no rule survives), <= 3 items, lift > 1, confidence >= .05.

    Mined once at the lower threshold: the rules of the higher one are those
    with its support. The others are kept only when there are none of these
    (decided in the plan, no driver check).
    """
    r = association_rules(frequent_itemsets(sets, fallback_support, 3), "lift", 1.0)
    r = materialize(r.filter((F.col("lift") > 1.0) & (F.col("confidence") >= min_confidence)))
    best = r.agg(F.coalesce(F.max(F.col("support") >= min_support), F.lit(False)).alias("_hp"))
    return r.crossJoin(best).filter(~F.col("_hp") | (F.col("support") >= min_support)) \
        .withColumn("min_support_used", F.when(F.col("_hp"), F.lit(min_support)).otherwise(F.lit(fallback_support))).drop("_hp")


def rules_by_segment(sets: DataFrame, by: Sequence[str], min_support: float, metric: str = "lift",
                     min_threshold: float = 1.0, min_baskets: int = 0, top: int | None = None,
                     max_len: int | None = 3) -> DataFrame:
    """Per segment (department, tier, ...) mining with a minimum basket count and top-n."""
    r = association_rules(frequent_itemsets(sets, min_support, max_len, by, min_baskets=min_baskets), metric, min_threshold, by)
    return top_rules(r, top, by) if top else r


def niche_product_rules(sets: DataFrame, min_support: float = 0.002, min_confidence: float = 0.1,
                        top: int = 5) -> DataFrame:
    """A10: product-id baskets, support .002, confidence >= .1, top 5 by lift."""
    r = association_rules(frequent_itemsets(sets, min_support, 3), "confidence", min_confidence)
    return top_rules(r, top)


def profit_rules(sets: DataFrame, min_support: float = 0.005, min_lift: float = 1.2,
                 targets: Sequence[str] = ("Stars", "Question Marks"), top: int = 10) -> DataFrame:
    """Rules whose consequent holds a label of a target segment; top 10 by lift (whole sets kept)."""
    r = association_rules(frequent_itemsets(sets, min_support, 3), "lift", min_lift)
    hit = F.exists("consequent", lambda x: _any([x.endswith(f"({t})") for t in targets]))
    return top_rules(r.filter(hit), top)


def _any(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def lift_matrix(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lift for ordered item pairs that co-occur, 1.0 on the diagonal.

    Pairs that never co-occur have lift 0 and are left implicit (a sparse
    matrix): emitting them would be a cross product of the vocabulary.
    """
    pats = patterns(sets, "items", by)
    n = pats.groupBy(*by).agg(F.sum("weight").alias("n_baskets"))
    single = pats.select(*by, F.explode("items").alias("item"), "weight").groupBy(*by, "item") \
        .agg(F.sum("weight").alias("cnt"))
    pairs = pats.filter(F.size("items") >= 2).select(*by, F.explode(pair_array("items")).alias("p"), "weight") \
        .groupBy(*by, F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("weight").alias("n_ab"))
    both = pairs.unionByName(pairs.select(*by, F.col("b").alias("a"), F.col("a").alias("b"), "n_ab"))
    sa = single.select(*by, F.col("item").alias("a"), F.col("cnt").alias("n_a"))
    sb = single.select(*by, F.col("item").alias("b"), F.col("cnt").alias("n_b"))
    j = _join_by(_join_by(_join_by(both, sa, by, on=["a"]), sb, by, on=["b"]), n, by)
    off = j.select(*by, "a", "b", (F.col("n_ab") * F.col("n_baskets") / (F.col("n_a") * F.col("n_b"))).alias("lift"))
    diag = single.select(*by, F.col("item").alias("a"), F.col("item").alias("b"), F.lit(1.0).alias("lift"))
    return off.unionByName(diag)


def item_support(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of baskets holding each item."""
    n = basket_counts(sets, by)
    c = sets.select(*by, F.explode("items").alias("item")).groupBy(*by, "item").agg(F.count(F.lit(1)).alias("n"))
    return _join_by(c, n, by).select(*by, "item", "n", (F.col("n") / F.col("n_baskets")).alias("support"))


def matrix_density(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Filled cells of the basket x item matrix over all cells."""
    g = sets.groupBy(*by).agg(F.count(F.lit(1)).alias("n_baskets"), F.sum(F.size("items")).alias("n_filled"))
    v = sets.select(*by, F.explode("items").alias("item")).groupBy(*by).agg(F.count_distinct("item").alias("n_items"))
    return _join_by(g, v, by).withColumn("density", F.col("n_filled") / (F.col("n_baskets") * F.col("n_items")))


def recommend(rules: DataFrame, baskets: DataFrame, key: str = "customer_id", by: Sequence[str] = ("cluster_id",),
              top_k: int = 5) -> DataFrame:
    """Per basket, consequents of its segment's rules whose antecedent is inside the basket.

    A containment join: each rule is filed under its antecedent's rarest item,
    and a basket meets only the rules filed under its own items. Of the rules
    that recommend an item the first by lift (then rule text) stands; a
    consequent already in the basket is skipped; the first ``top_k`` remain.
    Both choices are aggregates that combine map-side, the second over the few
    items that a basket can be recommended.
    """
    r = materialize(rules.select(*by, "antecedent", "consequent", "support", "confidence", "lift"))  # read several times
    longest = r.agg(F.max(F.size("antecedent"))).first()[0] or 0
    if longest > 1:
        baskets = materialize(baskets.select(key, *by, "items"))
    each = baskets.select(key, *by, "items", F.explode("items").alias("_item"))
    filed = r.withColumn("_item", F.element_at("antecedent", 1))
    if longest > 1:  # how many baskets of the segment hold an item of a longer antecedent
        inner = r.filter(F.size("antecedent") > 1).select(*by, F.explode("antecedent").alias("_item")).distinct()
        held = _join_by(each.select(*by, "_item"), _checked(inner), by, "left_semi", on=["_item"]).groupBy(*by, "_item").agg(F.count(F.lit(1)).alias("_n"))
        filed = _join_by(r.withColumn("_item", F.explode("antecedent")), held, by, "left", on=["_item"]) \
            .groupBy(*r.columns).agg(F.min_by("_item", F.struct(F.coalesce("_n", F.lit(0)), "_item")).alias("_item"))
    filed = _checked(materialize(filed))
    met = _join_by(each, filed, by, on=["_item"]).filter(F.size(F.array_except("antecedent", "items")) == 0)
    e = met.select(key, *by, "items", F.explode("consequent").alias("recommend"), "antecedent", "support", "confidence", "lift") \
        .filter(~F.array_contains("items", F.col("recommend")))
    order = F.struct((-rnd("lift", 9)).alias("o"), rule_key("antecedent").alias("t"), F.col("recommend").alias("i"),
                     "antecedent", "support", "confidence", "lift")
    first = e.groupBy(key, *by, "recommend").agg(F.min(order).alias("_m"))
    best = first.groupBy(key, *by).agg(F.slice(F.sort_array(F.collect_list("_m")), 1, top_k).alias("_b"))
    return best.select(key, *by, F.posexplode("_b").alias("rank", "_m")).select(
        key, *by, (F.col("rank") + 1).alias("rank"), F.col("_m.i").alias("recommend"), F.col("_m.antecedent").alias("from_items"),
        "_m.support", "_m.confidence", "_m.lift")


def recent_basket(tx: DataFrame, articles: DataFrame, days: int = 30) -> DataFrame:
    """Product groups a customer bought in the ``days`` up to their own last purchase.

    The per-customer last date is an aggregate joined back (not a window), so a
    heavy customer is reduced map-side; AQE splits a skewed join partition.
    """
    last = tx.groupBy("customer_id").agg(F.max("t_dat").alias("_last"))
    j = tx.join(last, "customer_id").filter(F.col("t_dat") >= F.date_sub("_last", days)) \
        .join(articles.select("article_id", "product_group_name"), "article_id")
    return item_sets(j, "customer_id", "product_group_name")


def recommend_all(tx, articles, clusters, rules, top_k: int = 5, days: int = 30) -> DataFrame:
    """Recent basket + cluster + rules for every customer.

    A customer meets only the rules filed under the items of the own basket, so
    a cluster that holds a third of all customers is spread over its items.
    """
    b = recent_basket(tx, articles, days).join(clusters.select("customer_id", "cluster_id"), "customer_id")
    return recommend(rules, b, "customer_id", ["cluster_id"], top_k)
