"""What the operators share: reading, stored intermediates, distributed numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from shopframe.session import Work  # noqa: F401

#: Words are runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, group: list[str], spread: str, name: str, n_buckets: int,
             order: list[str]) -> DataFrame:
    """Adds a gapless number from 0 within each group, without a task per group.

    ``spread`` is an expression (a hash) that deals the rows of a group over
    ``n_buckets``; only a bucket is sorted in one task, and the offsets of the
    buckets come from their counts. Rows that are equal in ``spread`` and
    ``order`` are numbered in any order.
    """
    b = df.withColumn("_b", F.expr(f"pmod({spread}, {int(n_buckets)})"))
    cond = [*group, "_b"]
    counts = b.groupBy(*cond).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"_g_{c}") for c in cond],
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    at = F.row_number().over(W.partitionBy(*cond).orderBy(*order))
    rows = b.withColumn("_at", at.cast("long"))
    on = [rows[c].eqNullSafe(starts[f"_g_{c}"]) for c in cond]
    return (rows.join(starts, on).withColumn(name, F.col("_start") + F.col("_at") - 1)
            .drop("_b", "_at", "_start", *[f"_g_{c}" for c in cond]))


def components(edges: DataFrame, work: Work) -> DataFrame:
    """(node, component): connected components of edges (a, b) of longs.

    Contraction rounds: every node moves to the member of its closed
    neighbourhood with the smallest hash of this round, and the edges between
    the nodes that are left form the next round's graph. The expected number
    of rounds is logarithmic also for chains; a group of any size is only ever
    met by map-side combined minima and by joins. The component is named by
    its smallest node. Nodes without an edge are not listed.
    """
    e = work.store(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges-0")
    moves: list[DataFrame] = []
    n = 0
    while not e.isEmpty():
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = F.min(F.struct(F.xxhash64(F.lit(n), "b").alias("h"), F.col("b").alias("v")))
        own = F.struct(F.xxhash64(F.lit(n), "a").alias("h"), F.col("a").alias("v"))
        move = both.groupBy("a").agg(low.alias("m")).select("a", F.least("m", own)["v"].alias("to"))
        move = work.store(move, f"cc-move-{n}")
        moves.append(move)
        ma = move.select(F.col("a"), F.col("to").alias("ta"))
        mb = move.select(F.col("a").alias("b"), F.col("to").alias("tb"))
        e = (e.join(ma, "a").join(mb, "b").where("ta <> tb")
             .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
        e = work.store(e, f"cc-edges-{n + 1}")
        work.drop(f"cc-edges-{n}")
        n += 1
    if not moves:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    at = moves[0].select(F.col("a").alias("node"), F.col("to").alias("cur"))
    for move in moves[1:]:
        at = at.join(move, at["cur"] == move["a"], "left").select("node", F.coalesce("to", "cur").alias("cur"))
    at = work.store(at, "cc-roots")
    named = at.groupBy("cur").agg(F.min("node").alias("component"))
    return at.join(named, "cur").select("node", "component")
