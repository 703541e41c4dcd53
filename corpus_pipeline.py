"""Corpus pipeline: quality rules, near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopframe.llm import minhash, mixture, packing, quality, secrets
from shopframe.llm.common import Work, read
from shopframe.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _texts(docs: DataFrame) -> DataFrame:
    """The documents with the two hashes that name a text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(*COLUMNS, F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"))


def _of_text(docs: DataFrame, by_text: DataFrame) -> DataFrame:
    """The documents joined with rows that are unique per (doc_id, h1, h2)."""
    v = by_text.select(*[F.col(c).alias(f"_{c}") if c in ("doc_id", "h1", "h2") else F.col(c) for c in by_text.columns])
    return _texts(docs).join(v, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines leave the others."""
    verdict = quality.quality(docs, Work(spark, "stage1")).where("kept").select("doc_id", "h1", "h2", "host", "cut")
    verdict = verdict.dropDuplicates(["doc_id", "h1", "h2", "host"])
    both = _of_text(docs, verdict).where(F.col("source").eqNullSafe(F.col("host")))
    text = quality.without_lines(F.col("text"), F.col("cut"))
    return both.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("cut").isNull(), F.col("n_chars")).otherwise(F.length(text)).cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays; rows without an id, which no group can name, stay as well.

    Rows that share an id are documents of their own where their texts differ:
    the text with the smallest hashes has the id, the others come after all ids.
    Of rows equal in id and text the smallest by (source, lang, n_chars) stays.
    """
    work, d = Work(spark, "stage2"), _texts(docs).where("doc_id is not null")
    hashes = F.struct("h1", "h2")
    clash = d.groupBy("doc_id").agg(F.min(hashes).alias("m"), F.max(hashes).alias("_last")).where("m <> _last")
    clash = work.store(clash.select(F.col("doc_id").alias("_doc_id"), "m"), "clash")  # most often empty, and then broadcast
    after = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("doc_id", "h1", "h2"), 3)  # below the ids of rows without one
    own = F.when(F.col("m").isNull() | (hashes == F.col("m")), F.col("doc_id")).otherwise(after)
    d = d.join(clash, F.col("doc_id") == F.col("_doc_id"), "left").select(own.alias("_id"), *COLUMNS)
    unnamed = docs.where("doc_id is null").select(*COLUMNS)
    rows = d.unionAll(unnamed.select(F.lit(None).cast("long").alias("_id"), *COLUMNS))
    kept = minhash.near_duplicates(rows, work, id_col="_id").where("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct()
    row = F.min(F.struct("source", "lang", "n_chars", "doc_id", "text")).alias("r")
    named = d.join(kept, F.col("_id") == F.col("_kept")).groupBy("_id").agg(row)
    return named.select(*[F.col(f"r.{c}").alias(c) for c in COLUMNS]).unionAll(unnamed)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of a secret is masked; a further candidate is one if one source holds all texts with its value."""
    spans = secrets.scan(docs, Work(spark, "stage3")).where(F.size("spans") > 0).dropDuplicates(["doc_id", "h1", "h2"])
    v = spans.select(F.col("doc_id").alias("_id"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "spans")
    d = _texts(docs)
    both = d.join(v, d["doc_id"].eqNullSafe(v["_id"]) & (d["h1"] == v["_h1"]) & (d["h2"] == v["_h2"]), "left")
    text = secrets.masked(F.col("text"), F.col("spans"))
    return both.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.length(text)).cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    m = mixture.mix(docs.select(*COLUMNS)).where("copies > 0")
    return m.select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")).drop("_copy")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    p = packing.pack(docs, Work(spark, "stage5"), tokenizer_path())
    return p.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("secret scan", secret_scan),
    ("mix", mix_sources),
    ("packing", pack_sequences),
]
#: Packing and verified near-duplicate grouping are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Work(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = work.store(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
