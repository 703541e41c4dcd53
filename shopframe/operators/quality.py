"""Q1-Q15: reconciliation, integrity checks and ETL log queries.

A check is a pair of one-row scalar aggregates; checks are stacked with
``unionByName`` so a whole report is one Spark job over the tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECK_SCHEMA = "name string, dw_value double, source_value double, is_match boolean, note string"


def scalar(df: DataFrame, agg: Column) -> DataFrame:
    """One-row frame with column ``v`` (double)."""
    return df.agg(agg.cast("double").alias("v"))


def constant(spark, value: float) -> DataFrame:
    """One-row scalar for an expected value (the reference's ``SELECT 0 FROM dual``)."""
    return spark.range(1).select(F.lit(value).cast("double").alias("v"))


def parse_number(c: Column) -> Column:
    """Text number with thousands separators -> double, null when not a number."""
    return F.regexp_replace(c.cast("string"), ",", "").try_cast("double")


def reconcile(name: str, dw: DataFrame, src: DataFrame | None, note: str = "",
              tol: float = 0.01) -> DataFrame:
    """Q1: compare two one-row scalars (column ``v``); match if |a-b| < tol.

    ``src=None`` (source unavailable) gives a null match, like a failed query.
    """
    a = dw.select(F.col("v").alias("dw_value"))
    if src is None:
        b = dw.sparkSession.range(1).select(F.lit(None).cast("double").alias("source_value"))
    else:
        b = src.select(F.col("v").alias("source_value"))
    return a.crossJoin(b).select(
        F.lit(name).alias("name"), "dw_value", "source_value",
        F.when(F.col("dw_value").isNull() | F.col("source_value").isNull(), F.lit(None).cast("boolean"))
         .otherwise(F.abs(F.col("dw_value") - F.col("source_value")) < tol).alias("is_match"),
        F.lit(note).alias("note"))


def reconcile_many(dw_row: DataFrame, src_row: DataFrame,
                   checks: Sequence[tuple[str, str, str | None, str]], tol: float = 0.01) -> DataFrame:
    """Q1 for many checks at once: one row of warehouse scalars, one row of source scalars.

    ``checks``: (name, dw column, source column or None, note). The two rows
    are aggregated once per table and unpivoted with ``stack``, so every table
    is scanned once however many checks read it.
    """
    row = dw_row.crossJoin(src_row)
    args = []
    for name, dw_col, src_col, note in checks:
        src = F.col(src_col).cast("double") if src_col else F.lit(None).cast("double")
        args += [F.lit(name), F.col(dw_col).cast("double"), src, F.lit(note)]
    out = row.select(F.stack(F.lit(len(checks)), *args).alias("name", "dw_value", "source_value", "note"))
    return out.select(
        "name", "dw_value", "source_value",
        F.when(F.col("dw_value").isNull() | F.col("source_value").isNull(), F.lit(None).cast("boolean"))
         .otherwise(F.abs(F.col("dw_value") - F.col("source_value")) < tol).alias("is_match"), "note")


def stack(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def orphan_count(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Q7: child rows whose key has no parent (anti join), as a one-row scalar."""
    pk = parent_key or key
    orphans = child.join(parent.select(F.col(pk).alias("__k")), F.col(key) == F.col("__k"), "left_anti")
    return scalar(orphans, F.count(F.lit(1)))


def negative_values(fact: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q8: rows with any negative measure."""
    cond = None
    for c in cols:
        cond = (F.col(c) < 0) if cond is None else cond | (F.col(c) < 0)
    return scalar(fact, F.count_if(cond))


def critical_nulls(fact: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q9: rows with a null in any key column."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return scalar(fact, F.count_if(cond))


def quality_summary(checks: DataFrame) -> DataFrame:
    """Q10: total / ok / failed / unavailable counts of a check report."""
    return checks.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_match") == F.lit(True)).alias("ok"),
        F.count_if(F.col("is_match") == F.lit(False)).alias("failed"),
        F.count_if(F.col("is_match").isNull()).alias("unavailable"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count (UNION ALL of counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    return stack(parts)


# ---------------------------------------------------------------- ETL log

LOG_SCHEMA = T.StructType([
    T.StructField("log_id", T.LongType()), T.StructField("job", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()), T.StructField("ended_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()), T.StructField("n_rows", T.LongType()),
    T.StructField("note", T.StringType())])


def last_run(log: DataFrame, job: str = "RUN_ALL") -> DataFrame:
    """Q12: newest row of one job (max_by, no sort)."""
    rows = log.filter(F.col("job") == job)
    return rows.agg(F.max_by(F.struct(*log.columns), F.struct("started_at", "log_id")).alias("r")).select("r.*") \
        .filter(F.col("log_id").isNotNull())


def last_run_per_job(log: DataFrame, prefix: str = "LOAD_") -> DataFrame:
    """Q13: newest row per job whose name starts with ``prefix``."""
    rows = log.filter(F.col("job").startswith(prefix))
    return rows.groupBy("job").agg(
        F.max_by(F.struct(*log.columns), F.struct("started_at", "log_id")).alias("r")).select("r.*")


def errors_last_day(log: DataFrame, asof) -> DataFrame:
    """Q14: failed runs in the 24 h before ``asof``."""
    a = F.lit(asof).cast("timestamp_ntz")
    return log.filter((F.col("status") == "FAILED") & (F.col("started_at") >= a - F.expr("INTERVAL 1 DAY"))
                      & (F.col("started_at") <= a))


def search_log(log: DataFrame, status: str | None = None, job: str | None = None,
               start=None, end=None, limit: int | None = 100) -> DataFrame:
    """Q15: optional conjunctive filters, newest first."""
    out = log
    if status:
        out = out.filter(F.col("status") == status)
    if job:
        out = out.filter(F.upper(F.col("job")).contains(job.upper()))
    if start is not None:
        out = out.filter(F.col("started_at") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        out = out.filter(F.col("started_at") <= F.lit(end).cast("timestamp_ntz"))
    out = out.orderBy(F.desc("started_at"), F.desc("log_id"))
    return out.limit(limit) if limit else out
