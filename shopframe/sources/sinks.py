"""Exports, upserts and atomic table replacement.

A "table" here is a folder of immutable versions ``<base>/v=<n>``; a version
counts only once its ``_SUCCESS`` marker exists (written last by the Spark
commit protocol), so readers never see a half-written table and a failed or
retried job leaves the previous version current. Upserts write a new version
instead of rewriting files in place.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopframe.functions.prefix import row_numbers


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def list_versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions of a versioned table, ascending."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def replace_table(df: DataFrame, base: str, version: int | None = None) -> int:
    """Write ``df`` as a new version; it becomes current when the write commits."""
    spark = df.sparkSession
    v = version if version is not None else max([int(time.time() * 1000)] + [x + 1 for x in list_versions(spark, base)])
    df.write.mode("errorifexists").parquet(f"{base}/v={v}")
    return v


def read_current(spark: SparkSession, base: str, schema=None) -> DataFrame | None:
    """The newest committed version (None when the table has none)."""
    vs = list_versions(spark, base)
    if not vs:
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{base}/v={vs[-1]}")


def upsert(target: DataFrame, updates: DataFrame, key: Sequence[str] | str, order: Sequence[str] = ()) -> DataFrame:
    """Rows of ``updates`` replace rows of ``target`` with the same key; others are kept.

    The last of several updates of a key wins by ``order`` (ties: the greater
    row). A null key is a key like any other.
    """
    from shopframe.sources.keyed import latest, same_key
    keys = [key] if isinstance(key, str) else list(key)
    u = latest(updates, keys, order).select(*target.columns)
    return target.join(u, same_key(target, u, keys), "left_anti").unionByName(u)


def upsert_table(spark: SparkSession, base: str, updates: DataFrame, key, order: Sequence[str] = ()) -> int:
    """S6 persisted as whole versions, for small tables; ``keyed.KeyedTable`` rewrites touched buckets only."""
    from shopframe.sources.keyed import latest
    cur = read_current(spark, base)
    return replace_table(latest(updates, key, order) if cur is None else upsert(cur, updates, key, order), base)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV of any answer."""
    df.write.mode(mode).option("header", True).csv(path)


def export_chunked(df: DataFrame, path: str, rows: int = 500_000, fmt: str = "csv") -> None:
    """S3: files of at most ``rows`` rows each (parallel writers, no driver loop)."""
    w = df.write.mode("overwrite").option("maxRecordsPerFile", rows)
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))


def sql_literal(c: Column, dtype: str) -> Column:
    """A value as SQL literal text: quoted strings with '' escaping, NULL for null."""
    if dtype in ("string",) or dtype.startswith("varchar") or dtype.startswith("char"):
        txt = F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))
    elif dtype in ("date", "timestamp", "timestamp_ntz"):
        txt = F.concat(F.lit("'"), c.cast("string"), F.lit("'"))
    elif dtype == "boolean":
        txt = F.when(c, F.lit("1")).otherwise(F.lit("0"))
    else:
        txt = c.cast("string")
    return F.coalesce(txt, F.lit("NULL"))


def insert_statements(df: DataFrame, table: str, batch: int = 100, order: Sequence[str] | None = None) -> DataFrame:
    """Text of multi-row INSERTs, ``batch`` rows per statement (1 = one per row).

    Rows are numbered with a distributed running count in ``order``; each
    statement collects at most ``batch`` rows.
    """
    cols = df.columns
    tup = F.concat(F.lit("("), F.concat_ws(", ", *[sql_literal(F.col(c), t) for c, t in df.dtypes]), F.lit(")"))
    num = row_numbers(df.withColumn("_tup", tup), list(order or cols), "_rn")
    g = num.groupBy(F.floor((F.col("_rn") - 1) / batch).alias("batch_id")) \
        .agg(F.array_sort(F.collect_list(F.struct("_rn", "_tup"))).alias("_rows"))
    head = f"INSERT INTO {table} ({', '.join(cols)}) VALUES\n"
    return g.select("batch_id", F.concat(F.lit(head), F.array_join(F.transform("_rows", lambda r: r["_tup"]), ",\n"),
                                         F.lit(";")).alias("statement"))


def export_sql_inserts(df: DataFrame, table: str, path: str, batch: int = 100) -> None:
    """S4 to files: one statement per line group, written in parallel."""
    insert_statements(df, table, batch).orderBy("batch_id").select("statement").write.mode("overwrite").text(path)
