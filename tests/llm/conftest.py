import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
                       T.StructField("_w", T.StringType())])


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from shopframe.session import build_session
    s = build_session("local[4]", "shopframe-llm-tests", 4,
                      {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="llm-test-ckpt-"),
                       "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="llm-test-wh-")})
    yield s


def make_rows(seed: int = 3, n: int = 120) -> list[tuple]:
    """Documents with copies, near copies, shared passages, nulls, empty, odd and long texts."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(400)] + ["É", "naïve", "日本", "🙂x"]
    word = lambda: r.choice(vocab)
    passage = [word() for _ in range(90)]
    texts: list = [None, "", " ", "\n\t \n", "one", "one two three", "a a a a a a a a", "x" * 3000, "é" * 700, " ".join("ab" for _ in range(300)),
                   "Aa bB cC dD eE fF", "aa bb cc dd ee ff", "\x85odd space  two em \r\n\x0bend", "<|endoftext|> it's 12 don't  "]
    while len(texts) < n:
        k = r.random()
        base = [word() for _ in range(r.choice([20, 60, 120, 300]))]
        if k < 0.15:
            base = passage[: r.choice([40, 60, 90])] + base
        if k > 0.7:
            prev = r.choice([t for t in texts if t]).split(" ")
            for _ in range(r.choice([0, 1, 3])):
                prev[r.randrange(len(prev))] = word()
            base = prev
        out = ""
        for w in base:
            out += w + r.choice([" "] * 12 + ["\n", ".\n", "  ", ", "])
        texts.append(out if k < 0.9 or k > 0.97 else " ".join(base))
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["s1", "s1", "s1", "s2", "s10", None]), None if t is None else len(t), "clash", "w") for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, "a row without an id " * 9, "en", "s2", 1, None, None), (9000, " ".join(word() for _ in range(9000)), "en", "s1", 1, "x", None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture()
def work(spark):
    from shopframe.llm.common import Work
    return Work(spark, "test")
