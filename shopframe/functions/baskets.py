"""Basket helpers: distinct item sets, weighted basket patterns, pair counts, first-by-key.

Pair counting never self-joins a basket's rows. Each basket is reduced to a
sorted distinct item array (``collect_set`` combines map-side, so even a
basket holding a third of all rows ends as one small array bounded by the
item vocabulary), identical arrays are counted once with a weight, and only
the distinct patterns are expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dealt(df: DataFrame, key: str, parts: int = 1) -> DataFrame:
    """Rows dealt by ``key`` to ``parts`` tasks (1: as they are), whose hash tables then hold a fixed share of the keys.

    Adaptive execution sizes tasks by compressed shuffle bytes, of which sorted
    keys take few, and leaves a number that is given here as it is.
    """
    return df.repartition(parts, key) if parts > 1 else df


def item_sets(df: DataFrame, basket: str | Sequence[str], item, min_size: int = 1,
              alias: str = "items") -> DataFrame:
    """One row per basket with the sorted distinct items (``size >= min_size``)."""
    keys = [basket] if isinstance(basket, str) else list(basket)
    it = F.col(item) if isinstance(item, str) else item
    out = df.groupBy(*keys).agg(F.sort_array(F.collect_set(it)).alias(alias))
    return out.filter(F.size(alias) >= min_size) if min_size > 1 else out


def patterns(sets: DataFrame, items: str = "items", by: Sequence[str] = ()) -> DataFrame:
    """Distinct item arrays with their basket count ``weight`` (optionally per group)."""
    return sets.groupBy(*by, items).agg(F.count(F.lit(1)).alias("weight"))


def pair_array(items: str = "items") -> Column:
    """All (a, b) with a before b in a sorted array, as an array of structs."""
    arr = F.col(items)
    n = F.size(arr)
    return F.flatten(F.transform(
        F.sequence(F.lit(1), n - 1),
        lambda i: F.transform(F.slice(arr, i + 1, n - i),
                              lambda b: F.struct(F.element_at(arr, i).alias("a"), b.alias("b")))))


def pair_counts(pats: DataFrame, items: str = "items", by: Sequence[str] = (),
                cond=None) -> DataFrame:
    """Weighted pair counts ``(by..., a, b, n)`` from basket patterns.

    ``cond`` (a function of the pair struct column ``p``) filters pairs, e.g.
    a strict order on one field of struct items.
    """
    p = pats.filter(F.size(items) >= 2).select(*by, F.explode(pair_array(items)).alias("p"), "weight")
    if cond is not None:
        p = p.filter(cond(F.col("p")))
    return p.groupBy(*by, F.col("p.a").alias("a"), F.col("p.b").alias("b")) \
        .agg(F.sum("weight").alias("n"))


def first_by(df: DataFrame, key: str | Sequence[str], order: Sequence[str], values: Sequence[str],
             prefix: str = "") -> DataFrame:
    """Per key, the ``values`` of the row that is smallest by ``order`` (ties by later columns).

    A ``min(struct(...))`` aggregate: partial aggregation on the map side, so
    a hot key is reduced before the shuffle (no per-key window).
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(order) + [v for v in values if v not in order]
    m = df.groupBy(*keys).agg(F.min(F.struct(*cols)).alias("_m"))
    return m.select(*keys, *[F.col(f"_m.{c}").alias(prefix + c) for c in cols])
