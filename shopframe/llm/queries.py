"""The registered queries of the operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpecount, embeddings, fmindex, lm, minhash, mixture, packing, periodic, phrases, quality, secrets, shards, suffixes
from .common import Work, read
from .oracles import ORACLES  # noqa: F401


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    training = docs.where(~lm.held_out()).select(F.coalesce("text", F.lit("")).alias("text"))
    model = lm.train(training, Work(spark, "op1"), order=3)
    s = lm.score(docs, model)
    return s.select("doc_id", lm.held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")


def op2_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fmindex.substring_dedup(read(spark, sf_dir, "documents"), Work(spark, "op2"))
    return s.select("doc_id", F.col("n").alias("n_words"), "n_removed", "kept_sha256")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixture.mix(read(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = suffixes.suffix_dedup(read(spark, sf_dir, "documents"), Work(spark, "op4"))
    return s.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


def op5_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = shards.kd_shards(read(spark, sf_dir, "documents"), Work(spark, "op5"))
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = packing.pack(read(spark, sf_dir, "documents"), Work(spark, "op6"), tokenizer_path())
    return p.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality.quality(read(spark, sf_dir, "documents"), Work(spark, "op7"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secrets.scan(read(spark, sf_dir, "documents"), Work(spark, "op8"), verdicts=True)
    base = F.filter("spans", lambda x: x["kind"] < len(secrets.BASE))
    n = [secrets.count_of(k).cast("long").alias(f"n_{k}") for k in secrets.BASE]
    return s.select("doc_id", *n, F.sha2(secrets.spelled(base), 256).alias("base_sha256"), secrets.spelled(F.col("spans")).alias("spans"),
                    secrets.listed("owners").alias("owners"), secrets.listed("repos").alias("repositories"), secrets.listed("live").alias("live"))


def op9_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read(spark, sf_dir, "embeddings"), Work(spark, "op9"))


def op10_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), Work(spark, "op10")).drop("cls")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top_phrases(phrases.collocations(read(spark, sf_dir, "documents"), Work(spark, "op11")))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path()) as f:
        vocabulary = bpecount.Vocabulary.read(f.read())
    n = bpecount.count_tokens(read(spark, sf_dir, "documents"), vocabulary)
    return n.withColumn("over_limit", F.col("n_tokens") > 512)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(read(spark, sf_dir, "documents"), reorder=periodic.planted_order))


QUERIES = {
    "op1_kneser_ney": op1_kneser_ney,
    "op2_fm_index": op2_fm_index,
    "op3_mixing": op3_mixing,
    "op4_suffix_array": op4_suffix_array,
    "op5_kd_sharding": op5_kd_sharding,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_secret_scan": op8_secret_scan,
    "op9_embedding_forest": op9_embedding_forest,
    "op10_superminhash": op10_superminhash,
    "op11_collocations": op11_collocations,
    "op12_token_counts": op12_token_counts,
    "op13_periodic_runs": op13_periodic_runs,
}

