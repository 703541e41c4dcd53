"""A keyed table whose upserts rewrite only the hash buckets they touch.

Layout under ``base``::

    data/<write>/bucket=<b>/part-*   rows of bucket b, as one write left them
    manifest/v=<n>/                  one row per bucket: the write that holds it

A row's bucket is a hash of its key, so buckets are even whatever the data. An
upsert reads the buckets that hold an updated key, merges the updates into
them, and writes them under a new write id; the other buckets' files are not
opened. The manifest of the next version is written last and counts once its
``_SUCCESS`` marker exists, so readers see all of a write or nothing, and a
failed or retried write leaves only files that no manifest names (``prune``
removes them). One writer at a time: a second one that commits the same version
fails on the existing manifest folder.

Only bucket numbers reach the driver, at most the table's number of buckets.

Keys are compared null-safely: a null key is a key like any other. Several
updates of one key are reduced first: in ``replace`` the last one wins by the
stated order (ties: the greater row, so the result never depends on the order
of rows); in ``fill`` each column takes its last value that is not null.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopframe.sources.sinks import _fs, list_versions, read_current, replace_table

MANIFEST = "bucket int, write string, info string"


def _keys(key: Sequence[str] | str) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest(updates: DataFrame, key: Sequence[str] | str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last by ``order``, ties by the other columns. Combines map-side."""
    keys = _keys(key)
    rest = [c for c in updates.columns if c not in keys]
    if not rest:
        return updates.distinct()
    rank = F.struct(*order, *[c for c in rest if c not in order])
    m = updates.groupBy(*keys).agg(F.max(rank).alias("_m"))
    return m.select(*[F.col(c) if c in keys else F.col("_m")[c].alias(c) for c in updates.columns])


def latest_fields(updates: DataFrame, key: Sequence[str] | str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: for each column the last value by ``order`` that is not null (ties: the greater value)."""
    keys = _keys(key)
    rest = [c for c in updates.columns if c not in keys and c not in order]

    def last(c: str) -> Column:
        return F.max(F.when(F.col(c).isNotNull(), F.struct(*order, c)))[c].alias(c)
    return updates.groupBy(*keys).agg(*[last(c) for c in rest]) if rest else updates.select(*keys).distinct()


def same_key(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


class KeyedTable:
    """A table of rows with a unique key in hash buckets; see the module's text."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        rows = read_current(spark, f"{self.base}/manifest", MANIFEST)
        if rows is None:
            raise ValueError(f"no keyed table at {base}")
        self.version = list_versions(spark, f"{self.base}/manifest")[-1]
        got = rows.collect()  # one row per bucket, and one with the table's description
        info = json.loads(next(r["info"] for r in got if r["bucket"] < 0))
        self.keys, self.n_buckets = info["keys"], info["buckets"]
        self.schema = T.StructType.fromJson(info["schema"])
        self.writes = {r["bucket"]: r["write"] for r in got if r["bucket"] >= 0}

    @classmethod
    def create(cls, df: DataFrame, base: str, key: Sequence[str] | str, n_buckets: int, order: Sequence[str] = ()) -> KeyedTable:
        """A new table of the last row of each key. ``n_buckets`` stays fixed; aim at a few hundred MB each."""
        spark, keys = df.sparkSession, _keys(key)
        if list_versions(spark, f"{base}/manifest"):
            raise ValueError(f"there is a keyed table at {base}")
        info = {"keys": keys, "buckets": int(n_buckets), "schema": json.loads(df.schema.json())}
        t = cls.__new__(cls)
        t.spark, t.base, t.version, t.keys, t.n_buckets, t.schema, t.writes = spark, base.rstrip("/"), 0, keys, int(n_buckets), df.schema, {}
        t._commit(t._write(latest(df, keys, order)), info)
        return cls(spark, base)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.n_buckets)).cast("int")

    def _write(self, rows: DataFrame) -> dict[int, str | None]:
        """Writes rows by bucket; which buckets the write holds."""
        name = uuid.uuid4().hex
        path = f"{self.base}/data/{name}"
        rows.withColumn("bucket", self._bucket()).repartition("bucket").write.partitionBy("bucket").parquet(path)
        fs, p, _ = _fs(self.spark, path)
        found = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return {int(f[7:]): name for f in found if f.startswith("bucket=")}

    def _commit(self, changed: dict[int, str | None], info: dict | None = None) -> None:
        info = info or {"keys": self.keys, "buckets": self.n_buckets, "schema": json.loads(self.schema.json())}
        writes = {b: w for b, w in (self.writes | changed).items() if w is not None}
        rows = [(-1, None, json.dumps(info)), *((b, w, None) for b, w in sorted(writes.items()))]
        replace_table(self.spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{self.base}/manifest", self.version + 1)
        self.version, self.writes = self.version + 1, writes

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table's rows, or those of some buckets."""
        paths = [f"{self.base}/data/{w}/bucket={b}" for b, w in sorted(self.writes.items()) if buckets is None or b in set(buckets)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows with the given keys; only their buckets are read."""
        k = keys.select(*self.keys).distinct()
        rows = self.read(self._buckets_of(k))
        return rows.join(k, same_key(rows, k, self.keys), "left_semi")

    def _buckets_of(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(self._bucket()).distinct().collect())  # at most n_buckets

    def upsert(self, updates: DataFrame, order: Sequence[str] = (), mode: str = "replace") -> list[int]:
        """Merges updates in; returns the buckets that were rewritten.

        ``replace``: an updated row takes the place of the old one (columns that
        the updates lack become null). ``fill``: known rows take only the values
        that are not null. ``order`` columns that are not the table's are not stored.
        """
        if mode not in ("replace", "fill"):
            raise ValueError(f"unknown mode {mode}")
        fields = [c for c in self.schema.names if c not in self.keys]
        names = {*self.schema.names, *order}
        given = updates.select(*[c for c in updates.columns if c in names])
        u = (latest if mode == "replace" else latest_fields)(given, self.keys, [c for c in order if mode == "replace" or c not in fields])
        u = u.select(*[(F.col(f.name) if f.name in u.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema])
        touched = self._buckets_of(u)
        if not touched:
            return []
        old = self.read(touched)
        if mode == "replace":
            rows = old.join(u, same_key(old, u, self.keys), "left_anti").unionByName(u)
        else:
            new = u.select(F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in self.schema.names])
            there = old.withColumn("_old", F.lit(True))
            on = F.lit(True)
            for k in self.keys:
                on = on & there[k].eqNullSafe(new[f"_new_{k}"])
            j = there.join(new, on, "full_outer")
            rows = j.select(*[F.when(F.col("_old").isNull(), F.col(f"_new_{k}")).otherwise(F.col(k)).alias(k) for k in self.keys],
                            *[F.coalesce(f"_new_{c}", c).alias(c) for c in fields]).select(*self.schema.names)
        self._commit(dict.fromkeys(touched) | self._write(rows))
        return touched

    def delete(self, keys: DataFrame) -> list[int]:
        """Removes the rows with the given keys; returns the buckets that were rewritten."""
        k = keys.select(*self.keys).distinct()
        touched = [b for b in self._buckets_of(k) if b in self.writes]
        if touched:
            old = self.read(touched)
            self._commit(dict.fromkeys(touched) | self._write(old.join(k, same_key(old, k, self.keys), "left_anti")))
        return touched

    def prune(self, keep: int = 2) -> int:
        """Removes all but the last ``keep`` manifests, and writes that none of those names; returns how many writes."""
        versions = list_versions(self.spark, f"{self.base}/manifest")
        kept = versions[-keep:]
        named = {r["write"] for v in kept for r in self.spark.read.schema(MANIFEST).parquet(f"{self.base}/manifest/v={v}").select("write").distinct().collect()}
        fs, p, jvm = _fs(self.spark, f"{self.base}/data")
        gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName() not in named]
        for v in versions[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.base}/manifest/v={v}"), True)
        for path in gone:
            fs.delete(path, True)
        return len(gone)
