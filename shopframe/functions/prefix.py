"""Distributed running totals and dense row numbers without a single-partition window.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task,
and ``Window.partitionBy(g)`` moves a whole group into one task. Here rows are
range-partitioned on (group, order key), each partition's total per group is
computed, the small table of offsets (partitions x groups) is joined back, and
the running total inside a partition is a window over that partition only.

The range partition of each row is stored before it is used: two range
exchanges would sample their bounds separately, and the totals and the rows
would then mean different ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopframe.session import materialize


#: offsets that are broadcast; more are joined by a shuffle (without groups there is one a partition)
MOST_OFFSETS = 100_000


def _parts(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_total(df: DataFrame, order: Sequence[str | Column], value: str | Column, out: str = "running",
                  num_partitions: int | None = None, by: Sequence[str] = (),
                  store: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """Inclusive running sum of ``value`` in ``order`` (within each ``by`` group when given).

    Rows are range-partitioned on (by, order), so one big group spans many
    partitions; each partition's total per group is computed and the
    earlier partitions' totals of the same group become that partition's
    offset (a table of at most partitions x groups-per-partition rows).
    The partitioned rows are stored (by ``store``, a reliable checkpoint unless
    told otherwise), so the frame is computed once. Ties: the order columns must
    make rows unique. A null group is a group of its own.
    """
    v = F.col(value) if isinstance(value, str) else value
    keys = list(by)
    r = store(df.repartitionByRange(_parts(df, num_partitions), *keys, *order)
              .withColumn("_pid", F.spark_partition_id()).withColumn("_v", v))
    tot = r.groupBy("_pid", *keys).agg(F.sum("_v").alias("_t"))
    wo = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    off = tot.withColumn("_off", F.coalesce(F.sum("_t").over(wo), F.lit(0)))
    w = Window.partitionBy("_pid", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    names = {c: f"_of_{c}" for c in ("_pid", *keys)}
    off = off.select(*[F.col(c).alias(a) for c, a in names.items()], "_off")
    if keys:
        off = materialize(off)
    if not keys or off.limit(MOST_OFFSETS + 1).count() <= MOST_OFFSETS:
        off = F.broadcast(off)  # the rows are then shuffled once, for the window, not for this join too
    same = [F.col(c).eqNullSafe(F.col(a)) for c, a in names.items()]
    j = r.join(off, same)
    return j.withColumn(out, F.sum("_v").over(w) + F.col("_off")).drop("_pid", "_v", "_off", *names.values())


def row_numbers(df: DataFrame, order: Sequence[str | Column], out: str = "row_id",
                num_partitions: int | None = None, by: Sequence[str] = (),
                store: Callable[[DataFrame], DataFrame] = materialize) -> DataFrame:
    """1..n in ``order`` (within each ``by`` group), distributed (E10 surrogate keys)."""
    return running_total(df, order, F.lit(1), out, num_partitions, by, store).withColumn(out, F.col(out).cast("long"))
