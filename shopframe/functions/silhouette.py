"""Euclidean silhouette of a bounded sample, by blocked distances in tasks.

The mean distance of a point to a cluster has no closed form for Euclidean
distances (for squared ones it has), so all pairs of the sample are compared.
The sample has at most ``sample`` rows, a documented parameter: it reaches the
driver once and is broadcast (rows x columns doubles). Tasks take the sample's
rows in blocks and compare each block with all of it, so a task holds ``BLOCK x
sample`` distances and the work is spread over ``sample / BLOCK`` rows of blocks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE, BLOCK = 30_000, 256


def widths(x: np.ndarray, own: np.ndarray, points: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Silhouette of each row of x (members of the sample ``points``, with clusters 0..k-1)."""
    size = np.bincount(cluster, minlength=k)
    order = np.argsort(cluster, kind="stable")
    first = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(len(x))
    for lo in range(0, len(x), BLOCK):
        part, mine = x[lo: lo + BLOCK], own[lo: lo + BLOCK]
        total = np.empty((len(part), k))
        for c in range(k):
            members = points[order[first[c]: first[c + 1]]]
            gap = np.zeros((len(part), len(members)))
            for d in range(x.shape[1]):
                gap += (part[:, d, None] - members[None, :, d]) ** 2
            total[:, c] = np.sqrt(gap).sum(1)
        rows = np.arange(len(part))
        a = total[rows, mine] / np.maximum(size[mine] - 1, 1)
        mean = np.where(size > 0, total / np.maximum(size, 1), np.inf)
        mean[rows, mine] = np.inf
        b = mean.min(1)
        top = np.maximum(a, b)
        alone = (size[mine] <= 1) | ~np.isfinite(b) | (top == 0)
        out[lo: lo + BLOCK] = np.where(alone, 0.0, (b - a) / np.where(alone, 1.0, top))
    return out


def silhouette(assigned: DataFrame, cols: Sequence[str], cluster: str = "cluster_id", sample: int = SAMPLE, seed: int = 42) -> DataFrame:
    """(silhouette, n_sample): mean Euclidean silhouette of at most ``sample`` rows, chosen by a hash of their values.

    A row alone in its cluster counts 0. Without two clusters the mean is 0, without rows null.
    """
    x = assigned.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)], F.col(cluster).alias("_c")).dropna()
    names = x.columns
    rows = x.orderBy(F.xxhash64(F.lit(seed), *names), *names).limit(sample).toArrow()
    points = np.column_stack([rows.column(n).to_numpy() for n in names[:-1]]) if rows.num_rows else np.zeros((0, len(cols)))
    ids, code = np.unique(rows.column("_c").to_numpy(), return_inverse=True)
    shared = assigned.sparkSession.sparkContext.broadcast((points, code))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_points, all_codes = shared.value
        for b in batches:
            for start in b.column("id").to_pylist():
                take = slice(start, start + BLOCK)
                w = widths(all_points[take], all_codes[take], all_points, all_codes, len(ids))
                yield pa.RecordBatch.from_arrays([pa.array([float(w.sum())]), pa.array([len(w)])], names=["s", "n"])

    blocks = assigned.sparkSession.range(0, len(points), BLOCK, max(1, -(-len(points) // BLOCK) // 4))
    return blocks.mapInArrow(run, "s double, n long").agg((F.sum("s") / F.sum("n")).alias("silhouette"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_sample"))
