"""Operator 8, secret scans with corpus-wide ownership frequency.

Base kinds (``assign``, ``access``, ``hex``) are spans wherever their pattern
holds. Further candidates (``token``, ``url``, ``mixed``) are judged by who owns
them: each candidate's value is hashed, and distinct repositories and owners
are counted over the whole corpus. A value that more than ``max_owners`` owners
hold is a widely copied example; a value of few owners that looks live (no
placeholder, varied characters) becomes a span of its own. Base spans stay
whatever the verdict, which every span carries with its counts.

Here an owner is a ``source`` and a repository a text wherever it stands: copies
of a text under several sources are one repository, held by the smallest of
them, and a value whose texts all stand under one source has one owner, whoever
else holds copies of them. There is no limit to the texts of an owner.

Positions count code points, ends are exclusive. A null text is empty, a null
owner is an owner of its own, repeated rows get the same spans each, an empty
table gives no rows, other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Work

QUOTE = "[\"']?"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KEY = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + either_case("api") + "_?" + either_case("key")
#: kind: (pattern, group that holds the value, least characters of the value)
BASE = {
    "assign": (rf"({KEY}){QUOTE}\x20*[:=]\x20*{QUOTE}([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
MORE = {
    "token": (r"(?:gh[pousr]_[A-Za-z0-9]+|xox[abprs]-[A-Za-z0-9-]+|sk-[A-Za-z0-9]+|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)", 0, 20),
    "url": (r"://[^\x00-\x20:/@]+:([^\x00-\x20@/]+)@", 1, 6),
    "mixed": (r"[A-Za-z0-9+/_-]{32,}", 0, 32),
}
KINDS = [*BASE, *MORE]
PLACEHOLDER = r"(?:example|sample|dummy|changeme|placeholder|redacted|xxxx|0000|1234|abcd|your[_-]?)"
SPAN = "array<struct<s:int,e:int,v:string>>"


def found(kind: str) -> Column:
    """The spans of a kind in ``text``: pieces between matches give the places."""
    pattern, group, least = (BASE | MORE)[kind]
    whole, value, gap = F.col(f"_m_{kind}"), F.regexp_extract_all("text", F.lit(pattern), F.lit(group)), F.split("text", pattern, -1)
    parts = F.zip_with(F.zip_with(whole, value, lambda m, v: F.struct(m.alias("m"), v.alias("v"))), F.slice(gap, F.lit(1), F.size(whole)),
                       lambda x, g: F.struct(x["m"].alias("m"), x["v"].alias("v"), F.length(g).alias("g")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")).cast(f"struct<at:int,out:{SPAN}>")

    def add(a: Column, x: Column) -> Column:
        s = a["at"] + x["g"]
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(a["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v")))).cast(SPAN).alias("out")).cast(f"struct<at:int,out:{SPAN}>")

    spans = F.filter(F.aggregate(parts, start, add, lambda a: a["out"]), lambda x: F.length(x["v"]) >= least)
    return F.when(F.size(whole) > 0, spans).otherwise(F.array().cast(SPAN))


def looks(x: Column) -> Column:
    """Whether a candidate is no placeholder and varied enough for a credential."""
    return (~F.translate(x["v"], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").rlike(PLACEHOLDER)
            & (F.size(F.array_distinct(F.split(x["v"], ""))) >= 6)
            & ((x["kind"] != KINDS.index("mixed")) | (x["v"].rlike("[0-9]") & x["v"].rlike("[A-Z]") & x["v"].rlike("[a-z]"))))


def candidates(docs: DataFrame) -> DataFrame:
    """Adds ``cands``: (s, e, kind number, base, value) of every candidate in ``text``, in order of place and kind.

    A further candidate that overlaps a span of a kind listed before its own is left out.
    """
    d = docs.withColumns({f"_m_{k}": F.regexp_extract_all("text", F.lit((BASE | MORE)[k][0]), F.lit(0)) for k in KINDS})
    d = d.select(*docs.columns, *[found(k).alias(f"_f_{k}") for k in KINDS])

    def tagged(kind: str) -> Column:
        n = KINDS.index(kind)
        return F.transform(f"_f_{kind}", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(n).alias("kind"), x["v"].alias("v")))

    d = d.select(*docs.columns, F.concat(*map(tagged, BASE)).alias("_base"), F.concat(*map(tagged, MORE)).alias("_more"))
    extra = F.when(F.size("_more") > 0, F.filter("_more", lambda x: looks(x) & ~F.exists(F.concat("_base", "_more"), lambda b: (b["kind"] < x["kind"]) & (x["s"] < b["e"]) & (b["s"] < x["e"])))).otherwise(F.col("_more"))
    return d.select(*docs.columns, F.array_sort(F.concat("_base", extra)).alias("cands"))


def frequency(value: DataFrame) -> DataFrame:
    """(value, owners, repos) of rows (value, owner, h1, h2)."""
    # every step is combined map-side: texts of an owner, owners of a text, texts and owners of a value
    texts = value.select("value", "owner", "h1", "h2").distinct()
    held = texts.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"))
    most = held.groupBy(F.col("value").alias("_v")).agg(F.max("repos").alias("most"))
    first = texts.groupBy("value", "h1", "h2").agg(F.min("owner").alias("owner")).groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"))
    freq = first.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos")).join(most, F.col("value") == F.col("_v"))
    return freq.select("value", F.when(F.col("most") == F.col("repos"), 1).otherwise(F.col("owners")).alias("owners"), "repos")


def scan(docs: DataFrame, work: Work, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         max_owners: int = 1, verdicts: bool = False) -> DataFrame:
    """(doc_id, h1, h2, spans): one row per document.

    ``spans`` is an array of (s, e, kind, live, v, owners, repos): all base
    spans and the further candidates whose owners make them live-looking. The
    counts of values of more than ``max_owners`` owners are given if
    ``verdicts`` asks for them, else null. ``h1`` and ``h2`` identify the text.
    The text is read once; candidates without their texts are stored and counted.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = candidates(docs.select(F.col(id_col).alias("doc_id"), F.col(owner_col).alias("owner"), text.alias("text")))
    d = d.select("doc_id", "owner", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"), "cands")
    d = work.store(d, "scan")
    value = d.where(F.size("cands") > 0).select("doc_id", "owner", "h1", "h2", F.explode("cands").alias("c"))
    value = value.withColumn("value", F.sha2(F.col("c.v"), 256))
    freq = frequency(value).select(F.col("value").alias("_v"), "owners", "repos")
    if not verdicts:
        freq = freq.where(F.col("owners") <= max_owners)
    # one row per value: Spark splits the partition of a value that many texts hold
    hit = value.select("h1", "h2", "value").distinct().join(freq, F.col("value") == F.col("_v"))
    counts = F.map_from_entries(F.collect_list(F.struct("value", F.struct("owners", "repos"))))
    mine = hit.groupBy(F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).agg(counts.alias("_freq"))
    out = d.join(mine, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")

    def judged(x: Column) -> Column:
        n = F.col("_freq")[F.sha2(x["v"], 256)]
        live = F.coalesce(n["owners"] <= max_owners, F.lit(False)) & ((x["kind"] >= len(BASE)) | looks(x))
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), live.alias("live"), x["v"].alias("v"), n["owners"].alias("owners"), n["repos"].alias("repos"))

    return out.select("doc_id", "h1", "h2", F.filter(F.transform("cands", judged), lambda x: (x["kind"] < len(BASE)) | x["live"]).alias("spans"))


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def listed(field: str, spans: str = "spans") -> Column:
    """A field of each span, comma-joined in the order of the spans."""
    return F.array_join(F.transform(spans, lambda x: x[field].cast("string")), ",")


def count_of(kind: str, spans: str = "spans") -> Column:
    """How many of the spans are of a kind."""
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda x: x["kind"] == number))


def masked(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span (overlapping ones merged) replaced by ``mark``."""
    kind = "struct<at:int,out:array<string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")).cast(kind)

    def add(a: Column, x: Column) -> Column:
        new = F.concat(a["out"], F.array(F.substr(text, a["at"] + 1, x["s"] - a["at"]), F.lit(mark)))
        return F.when(x["s"] >= a["at"], F.struct(x["e"].alias("at"), new.alias("out")).cast(kind)).otherwise(
            F.struct(F.greatest(a["at"], x["e"]).alias("at"), a["out"].alias("out")).cast(kind))

    whole = F.aggregate(F.array_sort(spans), start, add, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1, F.length(text))))
    return F.when(F.coalesce(F.size(spans), F.lit(0)) > 0, whole).otherwise(text)
