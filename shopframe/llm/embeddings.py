"""Operator 9, embedding near-duplicates: a forest of random-projection trees.

Each tree splits the vectors of a label by the median of their projection on a
random direction, again and again until a leaf is small. The upper splits are
fitted on a bounded sample of the labels' vectors (``sample`` rows), all rows
are routed through them, and a leaf that is still large is split further in its
task. A vector within ``spill`` of a threshold goes to both sides. Pairs within
a leaf are compared by cosine in double precision; pairs found by several trees
count once; links are united into components.

Equal vectors (equal after the cast to double, with equal label) are one class:
they are compared once, and their numbers enter ``n_links``. A leaf that no
direction can split is compared in blocks.

Defined results: a null label, or a vector that is null, empty, zero or holds a
null or non-finite component, links with nothing; vectors of different lengths
never link; rows without ``vec_id`` are compared but never name a component;
repeated rows are copies of each other; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, components

TREES, LEAF, SPILL, SAMPLE = 6, 256, 0.04, 40_000
COSINE = 0.98


def direction(seed: tuple[int, ...], dim: int) -> np.ndarray:
    r = np.random.Generator(np.random.PCG64([11, *[abs(s) for s in seed], dim])).standard_normal(dim)
    return r / np.linalg.norm(r)


def fit_tree(x: np.ndarray, seed: tuple[int, ...], leaf: int, depth: int = 12) -> dict:
    """A split tree over unit vectors: {} is a leaf."""
    if len(x) <= leaf or depth == 0:
        return {}
    p = x @ direction((*seed, depth), x.shape[1])
    t = float(np.median(p))
    left = p < t
    if not left.any() or left.all():
        return {}
    return {"at": depth, "t": t, "seed": seed, "kids": (fit_tree(x[left], (*seed, 1), leaf, depth - 1), fit_tree(x[~left], (*seed, 2), leaf, depth - 1))}


def route(node: dict, x: np.ndarray, rows: np.ndarray, path: int, spill: float) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf number, rows) of the leaves that the rows fall into; rows near a threshold go both ways."""
    if not len(rows):
        return
    if not node:
        yield path, rows
        return
    p = x[rows] @ direction((*node["seed"], node["at"]), x.shape[1]) - node["t"]
    yield from route(node["kids"][0], x, rows[p < spill], 2 * path, spill)
    yield from route(node["kids"][1], x, rows[p >= -spill], 2 * path + 1, spill)


def _pairs(x: np.ndarray, rows: np.ndarray, seed: tuple[int, ...], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of a leaf: split on while it is large and splits, else compared in blocks."""
    if len(rows) > LEAF and depth < 24:
        p = x[rows] @ direction((*seed, 100 + depth), x.shape[1])
        t = float(np.median(p))
        left, right = rows[p < t + SPILL], rows[p >= t - SPILL]
        if max(len(left), len(right)) < 0.9 * len(rows):
            yield from _pairs(x, left, (*seed, 1), depth + 1)
            yield from _pairs(x, right, (*seed, 2), depth + 1)
            return
    for i in range(0, len(rows), LEAF):
        for j in range(i, len(rows), LEAF):
            a, b = np.nonzero(x[rows[i: i + LEAF]] @ x[rows[j: j + LEAF]].T >= COSINE - 1e-6)
            a, b = rows[i + a], rows[j + b]
            yield a[a != b], b[a != b]


def _exact(v: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines in double precision from the vectors as they are."""
    x, y = v[a], v[b]
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def _units(vectors: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    scaled = v / np.abs(v).max(axis=1, keepdims=True)
    return scaled, scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as packed doubles; null where a vector links with nothing."""
    for b in batches:
        packed = []
        for label, e in zip(b.column("label").to_pylist(), b.column("embedding").to_pylist(), strict=True):
            v = None if label is None or not e or any(c is None for c in e) else np.asarray(e, np.float64) + 0.0
            packed.append(v.tobytes() if v is not None and np.isfinite(v).all() and v.any() else None)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(packed, pa.binary())], names=["vec_id", "label", "v"])


def _compare(table: pa.Table) -> pa.Table:
    """The links among the classes of one leaf, each once, smaller id first."""
    ids = table.column("cid").to_numpy()
    scaled, unit = _units(table.column("v").to_pylist())
    seed = (int(table.column("tree")[0].as_py()), int(table.column("leaf")[0].as_py()))
    found = set()
    for a, b in _pairs(unit, np.arange(len(ids)), seed, 0):
        a, b = np.where(ids[a] < ids[b], a, b), np.where(ids[a] < ids[b], b, a)
        good = _exact(scaled, a, b) >= COSINE
        found.update(zip(ids[a[good]].tolist(), ids[b[good]].tolist(), strict=True))
    a, b = zip(*sorted(found), strict=True) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_vectors(table: DataFrame, work: Work, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vector."""
    spark = table.sparkSession
    raw = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = work.store(raw.mapInArrow(_prepare, "vec_id long, label long, v binary"), "rows")
    # a class is named by its smallest id; classes of rows without ids get a negative one
    classes = rows.where("v is not null").groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = classes.withColumn("cid", F.coalesce("id", -1 - F.abs(F.xxhash64("label", "v") % (1 << 62)))).withColumn("dim", F.octet_length("v"))
    classes = work.store(classes, "classes")
    total = classes.count()
    # the sample: about `sample` rows, chosen by a hash, for the upper splits only
    part = min(1.0, sample / max(1, total))
    picked = classes.where(F.pmod(F.xxhash64("cid"), F.lit(1_000_000)) < part * 1_000_000).select("label", "dim", "v").limit(2 * sample).collect()
    by: dict[tuple[int, int], list[bytes]] = {}
    for r in picked:
        by.setdefault((r["label"], r["dim"]), []).append(bytes(r["v"]))
    forest = {}
    for key, vectors in by.items():
        unit = _units(vectors)[1]
        # deep enough that a leaf of the whole table is a task's work: several thousand rows
        forest[key] = [fit_tree(unit, (t, 0), max(8, int(4000 * part))) for t in range(trees)]
    shared = spark.sparkContext.broadcast(forest)  # at most 2 * sample / 8 nodes a tree

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, dim, v = b.column("label").to_numpy(), b.column("dim").to_numpy(), b.column("v").to_pylist()
            for key in sorted(set(zip(label.tolist(), dim.tolist(), strict=True))):
                at = np.flatnonzero((label == key[0]) & (dim == key[1]))
                unit = _units([v[i] for i in at])[1]
                for t in range(trees):
                    tree = shared.value.get(key, [{}] * trees)[t]
                    for leaf, got in route(tree, unit, np.arange(len(at)), 1, SPILL):
                        take = b.take(pa.array(at[got]))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), t, np.int32)), take.column("label"), take.column("dim"), pa.array(np.full(len(got), leaf, np.int64)), take.column("cid"), take.column("v")],
                                                         names=["tree", "label", "dim", "leaf", "cid", "v"])

    leaves = classes.select("label", "dim", "cid", "v").mapInArrow(deal, "tree int, label long, dim int, leaf long, cid long, v binary")
    links = leaves.groupBy("tree", "label", "dim", "leaf").applyInArrow(_compare, "a long, b long").distinct()
    links = work.store(links, "links")
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    size = classes.select(F.col("cid").alias("b"), "copies")
    others = both.join(size, "b").groupBy(F.col("a").alias("_a")).agg(F.sum("copies").alias("others"))
    # components are named by ids; the smallest cid of a component may belong to rows without ids
    groups = components(links, work)
    named = groups.withColumn("id", F.when(F.col("node") >= 0, F.col("node"))).groupBy("component").agg(F.min("id").alias("name")).withColumnRenamed("component", "_c")
    groups = groups.join(named, F.col("component") == F.col("_c")).select(F.col("node").alias("_node"), "name")
    known = (classes.join(others, F.col("cid") == F.col("_a"), "left").join(groups, F.col("cid") == F.col("_node"), "left")
             .select(F.col("label").alias("_label"), F.col("v").alias("_v"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("name", "id").alias("component_id")))
    out = rows.join(known, (F.col("label") == F.col("_label")) & (F.col("v") == F.col("_v")), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
