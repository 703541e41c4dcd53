"""Exact quantiles of unbounded columns without gathering the values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopframe.functions.prefix import running_total
from shopframe.session import materialize


def quantiles(df: DataFrame, value: str, points: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by..., q0, q1, ...``: the linearly interpolated quantile of ``value`` at each point (nulls left out).

    Equal values are counted, the counts are summed up in the order of the
    values (range-partitioned, so a group may span many tasks), and the values
    at the two ranks around each point are the least ones whose running count
    exceeds the rank. A group without values has null quantiles.
    """
    return _of_counts(df.groupBy(*by, F.col(value).cast("double").alias("_x")).agg(F.count(value).alias("_c")), points, list(by))


def _of_counts(counts: DataFrame, points: Sequence[float], keys: list[str]) -> DataFrame:
    """``quantiles`` of counted values (``_x``, ``_c``)."""
    cum = running_total(counts, [F.col("_x").asc_nulls_first()], "_c", "_cum", by=keys)
    size = counts.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum("_c").alias("_n"))
    both = cum.join(size, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]) if keys else cum.crossJoin(size)  # one row
    aggs = []
    for i, p in enumerate(points):
        rank = F.lit(float(p)) * (F.col("_n") - 1)
        lo, hi = F.floor(rank), F.ceil(rank)
        aggs += [F.min(F.when(F.col("_cum") > lo, F.col("_x"))).alias(f"_lo{i}"), F.min(F.when(F.col("_cum") > hi, F.col("_x"))).alias(f"_hi{i}"),
                 F.max(rank - lo).alias(f"_w{i}")]
    out = both.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[(F.col(f"_lo{i}") * (1 - F.col(f"_w{i}")) + F.col(f"_hi{i}") * F.col(f"_w{i}")).alias(f"q{i}") for i in range(len(points))])


#: values that are sorted in one row at the end, and the sketches' accuracy while narrowing
LAST_VALUES, ACCURACY, GRID = 50_000, 10_000, 1000


def exact_quantiles(df: DataFrame, columns: Sequence[str], points: Sequence[float], by: Sequence[str] = (),
                    last: int = LAST_VALUES, grid: int = GRID) -> DataFrame:
    """``by..., <column>_q0, <column>_q1, ...``: linearly interpolated quantiles of several columns at once.

    Selection by narrowing. Each wanted rank has a bracket of values; a pass
    sketches what lies within the brackets of all columns and groups together
    (``percentile_approx`` merges map-side and is bounded in size), takes two
    values around the rank, and the next pass counts exactly what lies below,
    at, between and above them. These counts say which part holds the rank: one
    of the two values themselves, or a bracket that is smaller in any case. Where
    at most ``last`` values are left they are sorted and the rank is read off.
    A pass leaves about 3 values in ``grid``, so 10^12 rows take three; nothing
    is range-sorted, and no group's values meet in one task.

    Nulls and NaN are left out; a group without values has null quantiles. A
    null group is a group of its own.
    """
    keys = list(by)
    values = df.select(*keys, F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("_c", "_x")).where("_x IS NOT NULL AND NOT isnan(_x)")
    sized = values.groupBy(*keys, "_c").agg(F.count(F.lit(1)).alias("_in"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), f(F.lit(float(p)) * (F.col("_in") - 1)).cast("long").alias("k"))
                       for i, p in enumerate(points) for f in (F.floor, F.ceil)])
    state = sized.withColumn("_w", F.explode(F.array_distinct(F.transform(wanted, lambda w: w["k"])))) \
        .select(*keys, "_c", F.col("_w").alias("_k"), "_lo", "_hi", F.lit(0).cast("long").alias("_below"), "_in")
    sized, state = materialize(sized), materialize(state)
    ids = [*keys, "_c", "_k"]

    def within(brackets: DataFrame) -> DataFrame:
        """The values inside the brackets of their column and group, a row per bracket."""
        names = {c: f"_of_{c}" for c in (*keys, "_c")}
        b = brackets.select(*[F.col(c).alias(names.get(c, c)) for c in brackets.columns])
        b = F.broadcast(b) if b.limit(100_001).count() <= 100_000 else b
        return values.join(b, [*[values[c].eqNullSafe(b[n]) for c, n in names.items()], F.col("_x").between(F.col("_lo"), F.col("_hi"))]).drop(*names.values())

    found = []
    many = (F.col("_in") > last) & (F.col("_lo") < F.col("_hi"))
    while not (wide := state.where(many)).isEmpty():
        sketch = within(wide).groupBy(*state.columns).agg(F.percentile_approx("_x", [j / grid for j in range(grid + 1)], ACCURACY).alias("_g"))
        place = (F.col("_k") - F.col("_below")) / (F.col("_in") - 1) * grid
        cut = materialize(sketch.select(*state.columns, F.get("_g", F.greatest(F.floor(place).cast("int") - 1, F.lit(0))).alias("_a"),
                                        F.get("_g", F.least(F.ceil(place).cast("int") + 1, F.lit(grid))).alias("_b")))
        x, lo, hi = F.col("_x"), F.col("_a"), F.col("_b")
        parts = {"less": x < lo, "a": x == lo, "mid": (x > lo) & (x < hi), "b": (x == hi) & (lo < hi), "more": x > hi}
        told = within(cut).groupBy(*cut.columns).agg(
            *[F.count_if(c).alias(f"_n_{n}") for n, c in parts.items()],
            *[f(F.when(parts[n], x)).alias(f"_{e}_{n}") for n in ("less", "mid", "more") for e, f in (("lo", F.min), ("hi", F.max))])
        # the part that holds the rank, with what lies below it
        before, choice = F.col("_below"), None
        for n in parts:
            ends = (lo, lo) if n == "a" else (hi, hi) if n == "b" else (F.col(f"_lo_{n}"), F.col(f"_hi_{n}"))
            part = F.struct(ends[0].alias("lo"), ends[1].alias("hi"), before.alias("below"), F.col(f"_n_{n}").alias("n"))
            before = before + F.col(f"_n_{n}")
            choice = F.when(F.col("_k") < before, part) if choice is None else choice.when(F.col("_k") < before, part)
        told = told.withColumn("_p", choice).select(*ids, F.col("_p.lo").alias("_lo"), F.col("_p.hi").alias("_hi"), F.col("_p.below").alias("_below"), F.col("_p.n").alias("_in"))
        found.append(state.where(~many))
        state = materialize(told)
    for f in found:
        state = state.unionByName(f)
    one = F.col("_lo") == F.col("_hi")
    few = within(state.where(~one)).groupBy(*state.columns).agg(F.sort_array(F.collect_list("_x")).alias("_v"))
    at = few.select(*ids, F.get("_v", (F.col("_k") - F.col("_below")).cast("int")).alias("_v")).unionByName(state.where(one).select(*ids, F.col("_lo").alias("_v")))
    at = at.groupBy(*keys, "_c").agg(F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias("_m"))
    names = {c: f"_of_{c}" for c in (*keys, "_c")}
    n = sized.select(*[F.col(c).alias(a) for c, a in names.items()], "_in")
    both = at.join(n, [at[c].eqNullSafe(n[a]) for c, a in names.items()]).drop(*names.values())
    cols = []
    for i, p in enumerate(points):
        rank = F.lit(float(p)) * (F.col("_in") - 1)
        low, high = (F.element_at("_m", f(rank).cast("long")) for f in (F.floor, F.ceil))
        cols.append(F.when(F.floor(rank) == F.ceil(rank), low).otherwise((F.ceil(rank) - rank) * low + (rank - F.floor(rank)) * high).alias(f"_q{i}"))
    q = both.select(*keys, "_c", *cols)
    wide = q.groupBy(*keys).agg(*[F.max(F.when(F.col("_c") == c, F.col(f"_q{i}"))).alias(f"{name}_q{i}") for c, name in enumerate(columns) for i in range(len(points))])
    if not keys:
        return wide
    groups = df.select(*[F.col(k).alias(f"_of_{k}") for k in keys]).distinct()
    return groups.join(wide, [F.col(f"_of_{k}").eqNullSafe(F.col(k)) for k in keys], "left") \
        .select(*[F.col(f"_of_{k}").alias(k) for k in keys], *[c for c in wide.columns if c not in keys])


#: values of a group that one aggregation buffer may hold
SMALL_GROUP = 1_000_000


def counted_quantiles(df: DataFrame, column: str, points: Sequence[float], small: int = SMALL_GROUP) -> DataFrame:
    """``q0, q1, ...`` of one column over all rows, for columns of few values: ``df`` is computed once.

    Equal values are counted and the counts stored; up to ``small`` of them go
    through one aggregate, more through ``quantiles``' running counts. Nulls and
    NaN are left out; without values the quantiles are null.
    """
    x = F.col(column).cast("double")
    counts = materialize(df.where(x.isNotNull() & ~F.isnan(x)).groupBy(x.alias("_x")).agg(F.count(F.lit(1)).alias("_c")))
    if counts.count() > small:
        return _of_counts(counts, points, [])
    g = counts.agg(F.percentile("_x", list(map(float, points)), F.col("_c")).alias("_q"))
    return g.select(*[F.get("_q", F.lit(i)).alias(f"q{i}") for i in range(len(points))])


def group_quantiles(df: DataFrame, columns: Sequence[str], points: Sequence[float], by: Sequence[str] = (),
                    small: int = SMALL_GROUP) -> DataFrame:
    """``by..., <column>_q0, ...``: one aggregate where every group is counted to be small, else ``exact_quantiles``."""
    keys = list(by)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) > small:
        return exact_quantiles(df, columns, points, keys)

    def clean(c: str) -> Column:
        return F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    g = df.groupBy(*keys).agg(*[F.percentile(clean(c), list(map(float, points))).alias(f"_{c}") for c in columns])
    return g.select(*keys, *[F.get(f"_{c}", F.lit(i)).alias(f"{c}_q{i}") for c in columns for i in range(len(points))])
