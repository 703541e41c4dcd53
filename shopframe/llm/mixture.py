"""Operator 3, mixing sources to target weights.

Tokens (words) are summed per source; a source's target is its weight's part of
all words, at most ``max_epochs`` times its size, with the excess reshared by
weight among the others. That is one water level: the sources whose cap lies
below ``level * weight`` stop at their cap, all others get ``level * weight``.
A source's repetition rate is target / size; each document is taken
floor(rate) times, plus one Bernoulli copy with probability equal to the
fraction, drawn from a hash of the document's id, so that reruns and retries
agree.

Edge cases: a null text has size 0; a null source is a source of its own and
comes last; a source without words has rate 0; repeated rows draw alike; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import WORD

WEIGHTS = (5, 2, 1)


def source_rates(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target, rate), one row per source.

    ``sizes`` has ``source`` and ``size``. The windows run over one row per
    source, after the rows have been summed map-side.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = W.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(by_name) - 1
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), n % len(weights) + 1))
    s = s.withColumn("cap", F.col("source_size").cast("double") * max_epochs)
    # sources in the order in which a rising level fills them up
    rising = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    to_here = rising.rowsBetween(W.unboundedPreceding, W.currentRow)
    first = F.col("total") / F.sum("weight").over(every)
    s = s.withColumn("total", F.sum("source_size").over(every).cast("double"))
    s = s.withColumn("at", F.row_number().over(rising))
    s = s.withColumn("open", F.sum("weight").over(every) - F.sum("weight").over(to_here))
    s = s.withColumn("after", F.when(F.col("open") > 0, (F.col("total") - F.sum("cap").over(to_here)) / F.col("open")))
    # full: reached by the level that the sources before it leave
    s = s.withColumn("full", F.col("cap") / F.col("weight") <= F.coalesce(F.lag("after").over(rising), first))
    s = s.withColumn("level", F.coalesce(F.max_by("after", F.when(F.col("full"), F.col("at"))).over(every), first))
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("level") * F.col("weight"))
    return (s.withColumn("target", F.when(F.col("total") > 0, target).otherwise(0.0))
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
            .select("source", "source_size", "target", "rate"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: str = "mix", salts: int = 256) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target`` and ``copies`` (how often the mix takes the row) to ``docs``.

    The join with the sources is salted on both sides: a source with a third of
    all rows is dealt over ``salts`` keys.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = docs.select(F.col(source_col).alias("source"), size.alias("size"))
    rates = source_rates(sizes, weights, max_epochs)
    rates = rates.select(F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("rate").alias("_rate"),
                         F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")).hint("merge")
    rows = docs.withColumn("_size", size).withColumn("_deal", F.pmod(F.xxhash64(id_col, "_size"), F.lit(salts)).cast("int"))
    both = rows.join(rates, rows[source_col].eqNullSafe(rates["_source"]) & (rows["_deal"] == rates["_salt"]))
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long") / F.lit(float(16**12))
    whole = F.floor(F.col("_rate"))
    copies = (whole + (draw < F.col("_rate") - whole).cast("long")).cast("long")
    return both.select(*[docs[c] for c in docs.columns if c not in ("size", "source_size", "target", "copies")],
                       F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), copies.alias("copies"))
