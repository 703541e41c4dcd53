"""Keyed tables: only touched buckets are rewritten; duplicates and null keys are defined."""

import os

import pytest

from shopframe.operators import ingest
from shopframe.sources import sinks
from shopframe.sources.keyed import KeyedTable, latest, latest_fields

ROWS = "id long, a int, b string"


def files(base):
    out = {}
    for d, _, names in os.walk(os.path.join(base, "data")):
        out |= {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return out


def test_one_percent_update_touches_its_buckets_only(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "k")
    rows = spark.range(20_000).selectExpr("id", "CAST(id % 7 AS INT) AS a", "CAST(id AS STRING) AS b")
    t = KeyedTable.create(rows, base, "id", 1000)
    before = files(base)
    assert len(before) == 1000
    up = spark.createDataFrame([(i * 2000 + 5, -1, "new") for i in range(10)], ROWS)
    touched = t.upsert(up)
    after = files(base)
    assert 0 < len(touched) <= 10 and len(after) == 1000 + len(touched)
    assert all(after[f] == m for f, m in before.items())  # nothing was written in place
    again = KeyedTable(spark, base)
    live = {b: w for b, w in again.writes.items() if b not in touched}
    assert set(live.values()) == {next(iter(live.values()))} and len(live) == 1000 - len(touched)
    got = {r.id: (r.a, r.b) for r in again.read().collect()}
    assert len(got) == 20_000 and all(got[i] == ((-1, "new") if i % 2000 == 5 else (i % 7, str(i))) for i in range(20_000))
    assert sorted(r.id for r in again.lookup(spark.createDataFrame([(5,), (99_999,)], "id long")).collect()) == [5]
    assert len(again.lookup(spark.createDataFrame([(5,)], "id long")).inputFiles()) == 1


def test_duplicates_nulls_and_order(spark, tmpdir_path):
    t = KeyedTable.create(spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (None, 3, "z"), (2, 4, None)], ROWS), os.path.join(tmpdir_path, "k"), "id", 8)
    got = lambda: sorted((tuple(r) for r in t.read().collect()), key=repr)
    assert got() == sorted([(1, 2, "y"), (None, 3, "z"), (2, 4, None)], key=repr)
    up = spark.createDataFrame([(1, 9, "late", 2), (1, 10, "early", 1), (None, 5, "null", 1), (7, None, "seven", 1), (7, None, "seven", 1)], ROWS + ", at int")
    t.upsert(up, ["at"])
    assert got() == sorted([(1, 9, "late"), (None, 5, "null"), (2, 4, None), (7, None, "seven")], key=repr)
    t.upsert(spark.createDataFrame([(1, None, "first", 1), (1, 11, None, 2), (8, None, None, 1), (None, None, "filled", 3)], ROWS + ", at int"), ["at"], "fill")
    assert got() == sorted([(1, 11, "first"), (None, 5, "filled"), (2, 4, None), (7, None, "seven"), (8, None, None)], key=repr)
    assert t.upsert(spark.createDataFrame([], ROWS)) == []
    t.delete(spark.createDataFrame([(None,), (8,), (77,)], "id long"))
    assert got() == sorted([(1, 11, "first"), (2, 4, None), (7, None, "seven")], key=repr)
    with pytest.raises(ValueError):
        t.upsert(up, mode="other")


def test_failed_write_is_not_seen_and_pruned(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "k")
    t = KeyedTable.create(spark.createDataFrame([(i, i, "") for i in range(50)], ROWS), base, "id", 4)
    t._write(spark.createDataFrame([(1, 100, "lost")], ROWS))  # a writer that died before its manifest
    assert KeyedTable(spark, base).read().where("b = 'lost'").count() == 0
    for i in range(3):
        t.upsert(spark.createDataFrame([(1, i, "kept")], ROWS))
    assert t.prune(1) == 3 and sinks.list_versions(spark, f"{base}/manifest") == [4]
    assert KeyedTable(spark, base).read().count() == 50
    stale = KeyedTable(spark, base)
    t.upsert(spark.createDataFrame([(2, 0, "a")], ROWS))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):  # a second writer of the same version
        stale.upsert(spark.createDataFrame([(2, 0, "b")], ROWS))


def test_several_key_columns(spark, tmpdir_path):
    s = "k string, day date, n int"
    t = KeyedTable.create(spark.createDataFrame([("a", None, 1), ("b", None, 2)], s), os.path.join(tmpdir_path, "k"), ["k", "day"], 3)
    t.upsert(spark.createDataFrame([("a", None, 5), (None, None, 6)], s))
    assert sorted((r.k or "", r.n) for r in t.read().collect()) == [("", 6), ("a", 5), ("b", 2)]


def test_frames(spark):
    u = spark.createDataFrame([(1, None, "b", 2), (1, 5, "a", 1), (1, 4, None, 3)], ROWS + ", at int")
    assert [tuple(r) for r in latest(u, "id", ["at"]).collect()] == [(1, 4, None, 3)]
    assert [tuple(r) for r in latest_fields(u, "id", ["at"]).collect()] == [(1, 4, "b")]
    target = spark.createDataFrame([(1, 0, "t"), (2, 0, "t"), (None, 0, "t")], ROWS)
    twice = spark.createDataFrame([(1, 3, "p"), (1, 2, "q"), (None, 7, "n"), (None, 7, "n")], ROWS)
    assert sorted(map(tuple, sinks.upsert(target, twice, "id").collect()), key=repr) == sorted([(1, 3, "p"), (2, 0, "t"), (None, 7, "n")], key=repr)
    got = sorted(map(tuple, ingest.upsert_customers(target, twice, "id").collect()), key=repr)
    assert got == sorted([(1, 3, "q"), (2, 0, "t"), (None, 0, "t")], key=repr)
