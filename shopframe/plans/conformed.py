"""Conformed tables written once, bucketed on their join keys.

Every registered query rebuilds its views from the source tables (the join
of order lines and orders above all). On a cluster that serves many queries
over 100 TB, the views are written once as bucketed, sorted tables. Joins and
aggregations on the bucket key of two tables with the same bucket count then
read co-located files and skip the shuffle; the sort makes the merge join a
streaming merge. ``tables_from_catalog`` returns a ``Tables`` whose views are
read from these tables instead of being recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopframe.sources.tables import Tables

# view -> bucket key. Keys are what the operators group and join on most:
# per-customer features, per-user features, the star schema's customer join.
LAYOUT: dict[str, tuple[str, ...]] = {
    "transactions": ("customer_id",),
    "fashion_customers": ("customer_id",),
    "order_items": ("user_id",),
    "users": ("id",),
    "fact_order": ("customer_id",),
    "dim_customer": ("customer_id",),
    "shop_events": ("visitor_id",),
}


def write_bucketed(df: DataFrame, table: str, keys: tuple[str, ...], n_buckets: int, path: str | None = None) -> None:
    """Overwrite ``table`` bucketed and sorted by ``keys`` (files at ``path`` when given)."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(n_buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def build_conformed(t: Tables, database: str, n_buckets: int, base_path: str | None = None,
                    views: tuple[str, ...] | None = None) -> list[str]:
    """Write the conformed views of ``t`` as bucketed tables ``database.<view>``.

    ``n_buckets`` should give files of a few hundred MB at the target size
    (for example input bytes / 256 MB), and is the same for every table that
    is joined on the same key.
    """
    spark = t.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    done = []
    for view in views or tuple(LAYOUT):
        path = f"{base_path}/{view}" if base_path else None
        write_bucketed(t.view(view), f"{database}.{view}", LAYOUT[view], n_buckets, path)
        done.append(view)
    return done


class CatalogTables(Tables):
    """``Tables`` whose conformed views come from bucketed catalog tables when present."""

    def __init__(self, spark: SparkSession, base: str, database: str):
        super().__init__(spark, base)
        self.database = database

    def view(self, name: str, **params) -> DataFrame:
        if not params and name in LAYOUT and self.spark.catalog.tableExists(f"{self.database}.{name}"):
            return self.spark.table(f"{self.database}.{name}")
        return super().view(name, **params)


def tables_from_catalog(spark: SparkSession, base: str, database: str) -> Tables:
    return CatalogTables(spark, base, database)
