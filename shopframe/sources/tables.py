"""Reading the source tables and SQL text as DataFrames."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

L, I, D, S, TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Declared schemas of the driver tables (never inferred).
SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(("c_custkey", L), ("c_name", S), ("c_nationkey", I),
                        ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
                    ("p_size", I), ("p_retailprice", D)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S),
                      ("o_totalprice", D), ("o_orderdate", TS), ("o_orderpriority", S)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS)),
    "events": _schema(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S),
                      ("value", D), ("props", S)),
    "labels": _schema(("doc_id", L), ("quality", I), ("toxic", I)),
}

TABLE_NAMES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()


#: rows of a table that one task groups by a key
TASK_ROWS = 500_000


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    path = os.path.join(base, f"{name}.parquet")
    r = spark.read
    if name in SCHEMAS:
        r = r.schema(SCHEMAS[name])
    return r.parquet(path)


def load_tables(spark: SparkSession, base: str,
                names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The named tables of a folder as DataFrames (lazy; nothing is read yet)."""
    return {n: read_table(spark, base, n) for n in (names or SCHEMAS.keys())}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S1 for CSV sources: header row, declared schema, empty string = null."""
    return (spark.read.schema(schema).option("header", True)
            .option("emptyValue", None).option("mode", "FAILFAST").csv(path))


def sql_source(spark: SparkSession, sql: str, args: dict | None = None,
               views: dict[str, DataFrame] | None = None) -> DataFrame:
    """SQL text over registered frames, with named bind parameters (``:name``)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args or {})


def jdbc_source(spark: SparkSession, url: str, table_or_query: str,
                properties: dict | None = None, partition_column: str | None = None,
                lower: int | None = None, upper: int | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """S2 against a database: a partitioned JDBC read (parallel range scans)."""
    r = spark.read.format("jdbc").option("url", url)
    # a query is read as a derived table: a partitioned read does not take the query option
    is_query = table_or_query.lstrip().lower().startswith(("select", "with"))
    r = r.option("dbtable", f"({table_or_query}) q" if is_query else table_or_query)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()


class Tables:
    """Lazy access to the source tables of one folder plus memoised derived views.

    ``t["orders"]`` reads a source table, ``t.view("transactions")`` builds a
    surrogate view once per ``Tables`` object, so that a plan using a view
    twice refers to the same logical subtree (Spark then reuses the exchange).
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._src: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}
        self._rows: dict[str, int] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._src:
            self._src[name] = read_table(self.spark, self.base, name)
        return self._src[name]

    def parts(self, name: str, rows: int = TASK_ROWS) -> int:
        """Tasks for work on keys of a table, so that none gets many more than ``rows`` rows (counted from the files' footers)."""
        if name not in self._rows:
            self._rows[name] = self[name].count()
        return max(1, -(-self._rows[name] // rows))

    def view(self, name: str, **params) -> DataFrame:
        from shopframe.plans import retail, star  # local import: plans import sources
        key = name + repr(sorted(params.items()))
        if key not in self._views:
            fn = getattr(retail, name, None) or getattr(star, name)
            self._views[key] = fn(self, **params)
        return self._views[key]
