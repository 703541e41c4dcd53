"""Operator 5, sharding by a k-d tree over document metadata.

The tree splits a node of m shards into m // 2 and the rest, at the weighted
quantile of its bytes along the dimension that is widest in it (its range over
the range in the whole table). All nodes of a level are split together; their
quantiles are found by histograms of 64-bit values that narrow down, pass by
pass, to the bin that holds the quantile. Only these histograms, of at most
``shards * BINS`` sums, reach the driver. Ties along a dimension are split by
the document's hash, so equal metadata does not stop the split.

The law is ``bytes``: leaves hold the target bytes within ``tolerance`` and the
largest document. Edge cases: null metadata sorts first; a null text has size
16; repeated rows fall together as long as that keeps the law (equal rows have
equal hashes; they are one point); an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopframe.functions.prefix import row_numbers

from .common import Work, numbered

BINS = 8192
#: rows of a shard that one task numbers
BUCKET_ROWS = 50_000


@dataclass
class Node:
    """A box of the tree: its conditions are those of its path."""

    shards: int
    first: int
    leaf: bool = False
    dim: str = ""
    lo: int = 0
    hi: int = 0
    cut: int = 0
    want: float = 0.0
    below: float = 0.0
    kids: list = field(default_factory=list)


def ranked(meta: DataFrame, c: str, work: Work) -> DataFrame:
    """``meta`` with the dense rank from 0 of its values in ``c`` instead of the values; null comes first."""
    ranks = row_numbers(meta.select(F.col(c).alias("_value")).distinct(), ["_value"], "_rank")
    ranks = work.store(ranks.select("_value", (F.col("_rank") - 1).alias("_rank")), f"ranks-{c}")  # most often few, and then broadcast
    both = meta.join(ranks, meta[c].eqNullSafe(ranks["_value"]))
    return both.select(*[F.col("_rank").alias(c) if x == c else F.col(x) for x in meta.columns])


def longs(values) -> Column:
    return F.array(*[F.lit(int(v)).cast("long") for v in values])


def flat(root: Node) -> list[Node]:
    """All nodes, the root first."""
    out = [root]
    for n in out:
        out += n.kids
    return out


def descend(root: Node, dims: list[str]) -> Column:
    """The place in ``flat(root)`` of the childless node that a point falls into.

    The tree is three short constant arrays that an ``aggregate`` walks down.
    """
    nodes = flat(root)
    if len(nodes) == 1:
        return F.lit(0)
    place, axes = {id(n): i for i, n in enumerate(nodes)}, [*dims, "tie"]
    axis, cut, kid = (longs(x) for x in ([axes.index(n.dim) if n.dim else 0 for n in nodes], [n.cut for n in nodes], [place[id(n.kids[0])] if n.kids else -1 for n in nodes]))
    depth = max(1, len(nodes).bit_length())
    values = F.array(*[F.col(c) for c in axes])

    def step(at: Column, _: Column) -> Column:
        i = at.cast("int")
        right = (F.get(values, F.get(axis, i).cast("int")) >= F.get(cut, i)).cast("long")
        return F.when(F.get(kid, i) < 0, at).otherwise(F.get(kid, i) + right)

    return F.aggregate(F.sequence(F.lit(0), F.lit(depth)), F.lit(0).cast("long"), step).cast("int")


def _frontier(points: DataFrame, root: Node, level: list[Node], dims: list[str]) -> DataFrame:
    """The points of the nodes of a level, with ``_node``, their place in it."""
    number = {id(n): i for i, n in enumerate(level)}
    at = F.get(longs(number.get(id(n), -1) for n in flat(root)), descend(root, dims))
    return points.withColumn("_node", at.cast("int")).where("_node >= 0")


def _pick(values: dict[int, float], want: float, below: float) -> tuple[int, float]:
    """The bin that holds the weight ``want``, and the weight below it."""
    for b in sorted(values):
        if below + values[b] >= want:
            return b, below
        below += values[b]
    b = max(values)
    return b, below - values[b]


def kd_tree(points: DataFrame, dims: list[str], shards: int, tolerance: float = 0.002) -> Node:
    """The fitted tree. ``points`` has long ``dims``, ``tie`` (a hash in [0, 2**40)) and ``size``."""
    total = points.agg(F.sum("size").alias("w"), *[F.min(c).alias(f"lo_{c}") for c in dims], *[F.max(c).alias(f"hi_{c}") for c in dims]).first()
    root = Node(shards, 0, leaf=shards == 1 or not total["w"])
    if root.leaf:
        return root
    spans = {c: max(1, total[f"hi_{c}"] - total[f"lo_{c}"]) for c in dims}
    target = total["w"] / shards
    level = [root]
    while level:
        box = _frontier(points, root, level, dims).groupBy("_node").agg(
            F.sum("size").alias("w"), *[F.min(c).alias(f"lo_{c}") for c in dims], *[F.max(c).alias(f"hi_{c}") for c in dims])
        found = {r["_node"]: r for r in box.collect()}
        for i, n in enumerate(level):
            if i not in found:
                n.dim, n.cut, n.lo, n.hi, n.want = "tie", 0, 0, 1, 0.0
                continue
            r = found[i]
            widest = max(dims, key=lambda c: (r[f"hi_{c}"] - r[f"lo_{c}"]) / spans[c])
            n.dim = widest if r[f"hi_{widest}"] > r[f"lo_{widest}"] else "tie"
            n.lo, n.hi = (r[f"lo_{widest}"], r[f"hi_{widest}"] + 1) if n.dim != "tie" else (0, 1 << 40)
            n.want, n.below = r["w"] * (n.shards // 2) / n.shards, 0.0
        _narrow(points, root, level, list(found), target * tolerance, dims)
        nxt = []
        for n in level:
            half = n.shards // 2
            n.kids = [Node(half, n.first, half == 1), Node(n.shards - half, n.first + half, n.shards - half == 1)]
            nxt += [k for k in n.kids if not k.leaf]
        level = nxt
    return root


def _narrow(points: DataFrame, root: Node, level: list[Node], live: list[int], slack: float, dims: list[str]) -> None:
    """Sets ``cut`` of every node: the value whose rank is nearest to the wanted weight."""
    open_, axes = set(live), [*dims, "tie"]
    points = _frontier(points, root, level, dims)
    while open_:
        of = lambda f: F.get(longs(f(n) for n in level), F.col("_node"))
        value = F.get(F.array(*[F.col(c) for c in axes]), of(lambda n: axes.index(n.dim)).cast("int"))
        p = points.where(F.col("_node").isin(sorted(open_)))
        p = p.select("_node", "size", value.alias("_v"), of(lambda n: n.lo).alias("_lo"), of(lambda n: n.hi).alias("_hi")).where("_v >= _lo and _v < _hi")
        step = F.greatest(F.lit(1).cast("long"), F.expr(f"(_hi - _lo + {BINS - 1}) div {BINS}"))
        p = p.withColumn("_step", step).withColumn("_bin", F.expr("(_v - _lo) div _step"))
        rows = p.groupBy("_node", "_bin").agg(F.sum("size").alias("w")).collect()
        by: dict[int, dict[int, float]] = {i: {} for i in open_}
        for r in rows:
            by[r["_node"]][r["_bin"]] = r["w"]
        for i in list(open_):
            n = level[i]
            step_ = max(1, (n.hi - n.lo + BINS - 1) // BINS)
            if not by[i]:
                n.cut = n.lo
                open_.discard(i)
                continue
            b, below = _pick(by[i], n.want, n.below)
            n.lo, n.hi, n.below = n.lo + b * step_, min(n.hi, n.lo + (b + 1) * step_), below
            w = by[i][b]
            if step_ == 1 or w <= slack:
                # the bin goes whole to the nearer side
                n.cut = n.hi if n.want - below > below + w - n.want else n.lo
                open_.discard(i)


def kd_shards(docs: DataFrame, work: Work, id_col: str = "doc_id", text_col: str = "text", shards: int = 40,
              overhead: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): one row per document, by law ``bytes``."""
    has = {c: c in docs.columns for c in ("lang", "source")}
    text = F.coalesce(F.col(text_col), F.lit(""))
    meta = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        *[(F.col(c) if has[c] else F.lit(0).cast("long")).alias(c) for c in has])
    for c in (c for c in has if has[c]):
        meta = ranked(meta, c, work)
    tie = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32", "size", F.lit(5)), 24)
    # every dimension carries the hash in its low bits: equal values split by it
    value = lambda c, bits: F.shiftleft(c, bits).bitwiseOR(F.shiftrightunsigned(tie, 40 - bits))
    meta = meta.select("doc_id", "size", "text_crc32", tie.alias("tie"), value(F.col("lang"), 14).alias("d_lang"), value(F.col("source"), 14).alias("d_source"),
                       value(F.col("size"), 24).alias("d_size"), value(F.coalesce(F.col("doc_id"), F.lit(-1)), 0).alias("d_id"))
    meta = work.store(meta, "meta")
    dims = ["d_lang", "d_source", "d_size", "d_id"]
    root = kd_tree(meta, dims, shards)

    out = meta.select("doc_id", "size", "text_crc32", "tie", F.get(longs(n.first for n in flat(root)), descend(root, dims)).cast("int").alias("shard"))
    buckets = max(1, -(-meta.count() // (shards * BUCKET_ROWS)))
    return numbered(out, ["shard"], "tie", "slot", buckets, ["tie", "doc_id"]).drop("tie")
