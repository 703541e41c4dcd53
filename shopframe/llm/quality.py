"""Operator 7, quality rules: cross-document line frequency per host.

Every line is normalised (ASCII lower case, white space runs as one space,
trimmed) and hashed. For each host the documents that hold a line are counted;
documents of the same host with equal text count once, so copies of one text do
not turn its lines into boilerplate. A line above the limits is removed; a
document that loses more than ``max_lost`` of its words that way is depleted
and rejected, as is one that fails the base rules.

Edge cases: a null text has no words and fails the base rule; a null host is a
host of its own; repeated rows get the same verdict each; an empty table gives
no rows; columns other than ``doc_id``, ``text`` and the host are not read and
may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, Work

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = r"[#*$%&|<>]+"


def normal(line):
    """A line as it is compared with others."""
    return F.trim(F.regexp_replace(F.translate(line, UPPER, LOWER), SPACE, " "))


def line_hash(line):
    return F.xxhash64(normal(line))


def text_stats(docs: DataFrame) -> DataFrame:
    """Adds the word, symbol and repetition counts of each text (``text`` must not be null)."""
    d = docs.withColumn("_w", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    d = d.withColumn("_lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)))
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    # a window is its hash in the high bits and its place in the low ones, so
    # that one sort of longs brings equal windows together
    d = d.withColumn("_bits", F.length(F.bin("n_words")))
    bits, w = F.col("_bits"), F.col("_w")

    def keyed(x, i):
        h = F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
        return F.call_function("shiftleft", F.call_function("shiftrightunsigned", h, bits), bits).bitwiseOR(i.cast("long"))

    d = d.withColumn("_k", F.sort_array(F.transform(F.slice("_w", F.lit(1), F.greatest(F.size("_w") - 2, F.lit(0))), keyed)))
    k, low = F.col("_k"), F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

    def same(x, y):
        a, b = x.bitwiseAND(low).cast("int"), y.bitwiseAND(low).cast("int")
        equal = F.lit(True)
        for t in range(3):
            equal = equal & (F.get(w, a + t) == F.get(w, b + t))
        high = F.call_function("shiftrightunsigned", x, bits) == F.call_function("shiftrightunsigned", y, bits)
        return F.coalesce(high & equal, F.lit(False))

    twice = F.filter(k, lambda x, j: ((j > 0) & same(x, F.get(k, j - 1))) | same(x, F.get(k, j + 1)))
    d = d.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(low))))
    at = F.col("_at")
    covered = F.transform(at, lambda p, j: F.least(F.lit(3).cast("long"), F.coalesce(F.get(at, j + 1) - p, F.lit(3).cast("long"))))
    return d.select(
        *docs.columns, "_lines", "n_words",
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
    )


def quality(docs: DataFrame, work: Work, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            min_docs: int = 20, max_share: float = 0.01, max_lost: float = 0.5, min_words: int = 50,
            max_repeat: float = 0.5, salts: int = 64) -> DataFrame:
    """One row per document: its counts, ``base_failed``, ``n_removed_words``, ``cut`` (hashes of removed lines), ``kept``.

    A line is above the limits if more than ``min_docs`` distinct documents of
    its host hold it and these are more than ``max_share`` of the host's. The
    text is read once; what follows works on a stored table of hashes.
    ``h1`` and ``h2`` identify a text (two 64-bit hashes).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("text"))
    d = text_stats(d)
    d = d.select("doc_id", "host", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"),
                 "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 F.transform("_lines", lambda x: F.struct(line_hash(x).alias("h"), F.size(F.regexp_extract_all(x, F.lit(WORD), F.lit(0))).alias("n"))).alias("lines"))
    scan = work.store(d, "scan")
    key = ["host", "h1", "h2"]
    # each text of a host once; each of its lines once, with all its words
    lines = (scan.select(*key, "lines").dropDuplicates(key).select(*key, F.explode("lines").alias("l"))
             .groupBy(*key, F.col("l.h").alias("line")).agg(F.sum("l.n").alias("words")))
    lines = work.store(lines, "lines")
    hosts = scan.select(*key).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    often = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_docs)
    often = often.join(hosts.withColumnRenamed("host", "_h"), F.col("host").eqNullSafe(F.col("_h"))).where(F.col("n") > max_share * F.col("docs"))
    # a line of a large host may be in a third of all rows: both sides are salted
    often = often.select(F.col("host").alias("_h"), F.col("line").alias("_l"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s")).hint("merge")
    salted = lines.withColumn("salt", F.pmod(F.col("h1"), F.lit(salts)).cast("int"))
    hit = salted.join(often, (F.col("line") == F.col("_l")) & (F.col("salt") == F.col("_s")) & F.col("host").eqNullSafe(F.col("_h")))
    cut = hit.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.sum("words").alias("n_removed_words"), F.collect_list("line").alias("cut"))
    out = scan.drop("lines").join(cut, F.col("host").eqNullSafe(F.col("_host")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    lost = F.coalesce("n_removed_words", F.lit(0))
    return (out.withColumn("n_removed_words", lost).withColumn("base_failed", base)
            .withColumn("kept", ~base & (lost <= max_lost * F.col("n_words")))
            .drop(*[f"_{c}" for c in key]))


def without_lines(text, cut):
    """The text without the lines whose hashes ``cut`` lists (null: none)."""
    left = F.filter(F.split(text, "\n"), lambda x: ~F.coalesce(F.array_contains(cut, line_hash(x)), F.lit(False)))
    return F.when(cut.isNull(), text).otherwise(F.array_join(left, "\n"))
