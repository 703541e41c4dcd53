"""Operator 10, MinHash near-duplicates with SuperMinHash signatures.

SuperMinHash gives each element of a set a random permutation of the slots and
a uniform number per step: at step j the element offers ``j + u`` to the slot
its permutation names, and a slot keeps the least offer. A set is finished at
the first step after which all its slots hold less than j + 1, since later
steps can only offer more. Signatures are cut into bands, equal bands put
documents into buckets.

Documents with equal word sequences are one class with one signature. Pairs
are confirmed on full shingle sets, in rounds, and a pair whose documents have
already met in one component is left out, since its link would change nothing:

1. every class against the smallest of the centres (smallest members) of its
   buckets;
2. against the other centres: one for each component, then whatever is left;
3. buckets that still span several components are compared within themselves,
   in blocks of bounded size that hold their members' sets: all pairs of
   different components are confirmed on the spot, and only links leave the task.

So a group of copies costs about one comparison a member, no link is lost to
the choice of centres, and a bucket of many documents that are alike but not
enough is never written out as pairs.

Defined results: a text without words (or null) has no shingles and is its own
component; a row without ``doc_id`` links like any other but names no component
(within, it gets an id after all others by its text; ids are below ``UNNAMED``);
rows that share a ``doc_id`` share a component; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Work, components
from .textwords import buffer_of, gram_hashes, mix, pieces, words_of

SHINGLE = 5
ROWS, BANDS = 6, 42
SLOTS = ROWS * BANDS
THRESHOLD = 75
#: ids from here on stand for rows without one
UNNAMED = 3 << 61
#: members that one task confirms against a centre, and bucket members that one task compares
GROUP, BLOCK = 256, 2048


def shingle_sets(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within it, and the rows' offsets."""
    n = len(first) - 1
    grams = gram_hashes(h, SHINGLE)
    out, off = [], np.zeros(n + 1, np.int64)
    for i in range(n):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= SHINGLE:
            s = np.unique(grams[a: b - SHINGLE + 1])
        elif b > a:
            s = mix(gram_hashes(h[a:b], b - a) + np.uint64(b - a))
        else:
            s = h[:0]
        out.append(s)
        off[i + 1] = off[i] + len(s)
    return (np.concatenate(out) if out else h[:0]), off


def super_minhash(x: np.ndarray, off: np.ndarray, slots: int = SLOTS, at_once: int = 1 << 16) -> np.ndarray:
    """Signatures (rows by slots, float64) of the sets ``x[off[i]:off[i + 1]]``; inf for empty sets."""
    n = len(off) - 1
    sig = np.full((n, slots), np.inf)
    lo = 0
    while lo < n:  # sets are taken together while their elements are few
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + at_once, "right")) - 1)
        _fill(x[off[lo]: off[hi]], np.repeat(np.arange(hi - lo), np.diff(off[lo: hi + 1])), sig[lo:hi], slots)
        lo = hi
    return sig


def _fill(x: np.ndarray, d: np.ndarray, sig: np.ndarray, slots: int) -> None:
    flat, perm = sig.reshape(-1), None
    for j in range(slots):
        if not len(x):
            return
        u = mix(x + np.uint64((0x9E3779B97F4A7C15 * (2 * j + 1)) % 2**64))
        k = j + (mix(u) % np.uint64(slots - j)).astype(np.int64)
        if perm is None:
            slot, k0 = k, k
        else:
            i = np.arange(len(x))
            slot = perm[i, k].astype(np.int64)
            perm[i, k] = perm[:, j]
        np.minimum.at(flat, d * slots + slot, j + (u >> np.uint64(11)) * 2.0**-53)
        going = np.bincount(d, minlength=len(sig)) > 0
        going[going] = sig[going].max(axis=1) >= j + 1
        keep = going[d]
        if perm is not None:
            perm = perm[keep]
        x, d = x[keep], d[keep]
        if perm is None and len(x):
            perm = np.tile(np.arange(slots, dtype=np.uint16), (len(x), 1))
            perm[np.arange(len(x)), k0[keep]] = 0


def bands_of(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; equal rows of a band give equal keys, and bands never share one by design."""
    v = sig.view(np.uint64).reshape(len(sig), BANDS, ROWS)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), 1))
    for r in range(ROWS):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + v[:, :, r])
    return key


def _class(h: np.ndarray) -> bytes:
    return hashlib.blake2b(h.tobytes(), digest_size=16).digest()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, off = buffer_of(batch.column("text"))
        for lo, hi in pieces(off):
            h, _, _, first = words_of(buf[off[lo]: off[hi]], off[lo: hi + 1] - off[lo], lower=True)
            x, sets = shingle_sets(h, first)
            some = np.diff(sets) > 0
            sig = super_minhash(x, sets)[some]
            keys = bands_of(sig).view(np.int64)
            at, none = np.cumsum(some) - 1, [None] * (hi - lo)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(lo, hi - lo),
                pa.array([_class(h[first[i]: first[i + 1]]) if some[i] else None for i in range(hi - lo)], pa.binary()),
                pa.array(np.diff(sets)),
                pa.array([keys[at[i]] if some[i] else None for i in range(hi - lo)] or none, pa.list_(pa.int64())),
            ], names=["doc_id", "cls", "n_shingles", "bands"])


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, bytes]]:
    """(batch, row, shingles) of the texts that are of the class that their row names."""
    for batch in batches:
        buf, off = buffer_of(batch.column("text"))
        cls = batch.column("cls").to_pylist()
        for lo, hi in pieces(off):
            h, _, _, first = words_of(buf[off[lo]: off[hi]], off[lo: hi + 1] - off[lo], lower=True)
            x, sets = shingle_sets(h, first)
            for i in range(lo, hi):
                if _class(h[first[i - lo]: first[i - lo + 1]]) == cls[i]:  # else another text under the same id
                    yield batch, i, x[sets[i - lo]: sets[i - lo + 1]].tobytes()


def _batched(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], limit: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Arrow batches of rows whose last value is binary, of about ``limit`` bytes."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1]) + 64
        if size >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)


def _roles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (centre, salt, member, shingles) for every role that a document has."""
    def rows() -> Iterator[tuple]:
        for batch, i, data in _shingles(batches):
            me = batch.column("doc_id")[i].as_py()
            for salt in range(batch.column("salts")[i].as_py() or 0):
                yield me, salt, None, data
            for r in batch.column("centres")[i].as_py() or ():
                yield r["centre"], me % r["salts"], me, data
    return _batched(rows(), ["centre", "salt", "member", "shingles"], [pa.int64(), pa.int32(), pa.int64(), pa.binary()])


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rep, shingles)."""
    return _batched(((batch.column("doc_id")[i].as_py(), data) for batch, i, data in _shingles(batches)), ["rep", "shingles"], [pa.int64(), pa.binary()])


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough; sets without elements never are."""
    if not len(x) or not len(y):
        return False
    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
    return 100 * both >= THRESHOLD * (len(x) + len(y) - both)


def _confirm(table: pa.Table) -> pa.Table:
    """The members of a centre whose sets are similar enough."""
    member, data = table.column("member").to_pylist(), table.column("shingles").to_pylist()
    centre = next((np.frombuffer(d, np.uint64) for m, d in zip(member, data, strict=True) if m is None), np.zeros(0, np.uint64))
    good = {m for m, d in zip(member, data, strict=True) if m is not None and similar(centre, np.frombuffer(d, np.uint64))}
    good = sorted(good)
    return pa.table({"a": pa.array([table.column("centre")[0].as_py()] * len(good), pa.int64()), "b": pa.array(good, pa.int64())})


def confirmed(pairs: DataFrame, texts: DataFrame, reps: DataFrame, work: Work, name: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar, stored.

    A centre ``a`` is dealt over as many tasks as its members need; every text
    travels once, and from there its shingles once per pair.
    """
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("salts"))
    roles = pairs.join(salts, "a").groupBy("b").agg(F.collect_list(F.struct(F.col("a").alias("centre"), "salts")).alias("centres"))
    want = (salts.withColumnRenamed("a", "rep").join(roles.withColumnRenamed("b", "rep"), "rep", "full")
            .join(reps.select("rep", "cls"), "rep"))
    rows = texts.join(want, texts["doc_id"] == want["rep"]).dropDuplicates(["doc_id", "text"]).select("doc_id", "text", "cls", "centres", "salts")
    sets = rows.mapInArrow(_roles, "centre long, salt int, member long, shingles binary")
    return work.store(sets.groupBy("centre", "salt").applyInArrow(_confirm, "a long, b long"), name)


def _block(table: pa.Table) -> pa.Table:
    """Links between different components within two blocks of a bucket."""
    t = table.select(["block", "lo", "hi", "rep", "comp", "n_shingles"]).to_pandas()
    sets = [np.frombuffer(d, np.uint64) for d in table.column("shingles").to_pylist()]
    own, lo, hi = t["block"].to_numpy(), int(t["lo"].iloc[0]), int(t["hi"].iloc[0])
    rep, comp, size = t["rep"].to_numpy(), t["comp"].to_numpy().copy(), t["n_shingles"].to_numpy()
    distinct, code = np.unique(np.concatenate(sets), return_inverse=True)
    code = np.split(code, np.cumsum([len(x) for x in sets])[:-1])
    right, out, mine = np.flatnonzero(own == hi), [], np.zeros(len(distinct), bool)
    held = np.concatenate([code[k] for k in right] or [np.zeros(0, np.int64)])
    end = np.cumsum([0, *(len(code[k]) for k in right)])
    for i in np.flatnonzero(own == lo):
        fits = (comp[right] != comp[i]) & (100 * np.minimum(size[right], size[i]) >= THRESHOLD * np.maximum(size[right], size[i]))
        if not fits.any():
            continue
        # the elements that each set on the right shares with this one
        mine[code[i]] = True
        both = np.diff(np.concatenate([[0], np.cumsum(mine[held])])[end])
        mine[code[i]] = False
        for k in right[fits & (both > 0) & (100 * both >= THRESHOLD * (size[right] + size[i] - both))].tolist():
            if comp[k] != comp[i]:
                out.append((min(rep[i], rep[k]), max(rep[i], rep[k])))
                comp[comp == comp[k]] = comp[i]
    a, b = zip(*out, strict=True) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def near_duplicates(docs: DataFrame, work: Work, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, cls, component_id, kept): one row per document."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    after = F.lit(UNNAMED) + F.shiftrightunsigned(F.xxhash64(text), 3)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), after).alias("doc_id"), text.alias("text"))
    sketch = work.store(texts.mapInArrow(_sketch, "doc_id long, cls binary, n_shingles long, bands array<long>"), "sketch")
    classes = sketch.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"))
    classes = work.store(classes, "classes")  # a stored table's partition of many copies can be split in the joins
    one = sketch.join(classes, "cls").where("doc_id = rep").dropDuplicates(["cls"]).select("rep", "cls", "n_shingles", "bands")
    reps = work.store(one, "reps")
    band = reps.select("rep", F.explode("bands").alias("band"))
    buckets = work.store(band.groupBy("band").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    inside = work.store(band.join(buckets, "band").select("band", "rep", "a", "n"), "inside")
    # a document that shares its id with another text links the two
    pairs = work.store(inside.where("rep <> a").select("a", F.col("rep").alias("b")).distinct(), "pairs")

    tested = work.store(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "tested-0")
    links = confirmed(tested, texts, reps, work, "links-0")
    groups = components(links, Work(spark, "minhash-0"))

    def labelled(df: DataFrame, node: str, name: str) -> DataFrame:
        g = groups.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        return df.join(g, F.col(node) == F.col("_n"), "left").withColumn(name, F.coalesce("_c", node)).drop("_n", "_c")

    def centres(one: bool) -> DataFrame:
        rest = labelled(labelled(pairs.join(tested, ["a", "b"], "left_anti"), "a", "ca"), "b", "cb").where("ca <> cb")
        return rest.groupBy("b", "ca").agg(F.min("a").alias("a")).select("a", "b") if one else rest.select("a", "b")

    for n, one in enumerate((True, False), 1):
        more = work.store(centres(one), f"more-{n}")
        if not more.isEmpty():
            links = links.unionAll(confirmed(more, texts, reps, work, f"links-{n}"))
            tested = tested.unionAll(more)
            groups = components(links, Work(spark, f"minhash-{n}"))

    comp = work.store(labelled(inside.where("n > 2").select("band", "rep"), "rep", "comp"), "comp")
    mixed = comp.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("n")).where("x <> y")
    blocks = work.store(mixed.select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "blocks")
    members = work.store(comp.join(blocks, "band"), "members")
    want = reps.join(members.select("rep").distinct(), "rep").select("rep", "cls")
    sets = texts.join(want, texts["doc_id"] == want["rep"]).dropDuplicates(["doc_id", "text"]).select("doc_id", "text", "cls").mapInArrow(_own, "rep long, shingles binary")
    sets = work.store(sets, "sets")
    rows = members.join(reps.select("rep", "n_shingles"), "rep").join(sets, "rep").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rep", "comp", "n_shingles", "shingles")
    last = work.store(rows.groupBy("band", "lo", "hi").applyInArrow(_block, "a long, b long").distinct(), "links-3")
    if not last.isEmpty():
        groups = components(links.unionAll(last), Work(spark, "minhash-3"))
    work.drop("buckets", "inside", "pairs", "comp", "blocks", "members", "sets")
    groups = groups.withColumnRenamed("component", "component_id")
    known = classes.join(groups, F.col("rep") == F.col("node"), "left").select(F.col("cls").alias("_cls"), F.coalesce("component_id", "rep").alias("component_id"))
    known = work.store(known, "known")
    out = sketch.select("doc_id", "n_shingles", "cls").join(known, F.col("cls") == F.col("_cls"), "left")
    named = lambda c: F.when(c < UNNAMED, c)
    out = out.select(named(F.col("doc_id")).alias("doc_id"), "n_shingles", "cls", named(F.coalesce("component_id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
