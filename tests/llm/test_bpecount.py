"""Operator 12 against the library itself."""

import json
import random

import numpy as np
import pytest

from shopframe.llm import bpecount

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
POOL = ["the", "ing", " ", " ", "  ", "\n", "\t", "'s", "'t", "'LL", "'", "é", "ção", "日本", "🙂", "12", "3", "²", "Ⅷ", "\x85", "\xa0", " ", "　", "\x1c", "\x1f", "​",
        "﻿", "x", "X", "aaaa", "==", "!!", "<|endoftext|>", "<|endof", "\x00", "ः", "́", "᠎", "\r\n", "١"]


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH) as f:
        return bpecount.Vocabulary.read(f.read())


def column(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)


@pytest.mark.parametrize("seed", range(4))
def test_texts(model, vocabulary, seed):
    r = random.Random(seed)
    texts = ["", " ", "x" * 3000, "ab" * 2000, " " * 500, "<|endoftext|>", "é" * 700, "".join(r.choice("abcdefgh") for _ in range(4000))]
    texts += ["".join(r.choice(POOL) for _ in range(r.randint(1, 25))) for _ in range(700)]
    counter = bpecount.Counter(vocabulary)
    for _ in range(2):  # the second time from memory
        assert counter.of_rows(*column(texts)).tolist() == [len(model.encode(t, add_special_tokens=False).ids) for t in texts]


def test_memory_is_bounded(model, vocabulary, monkeypatch):
    monkeypatch.setattr(bpecount, "REMEMBERED", 10)
    counter = bpecount.Counter(vocabulary)
    for i in range(5):
        texts = [f"word{i}{j} and more" for j in range(30)]
        assert counter.of_rows(*column(texts)).tolist() == [len(model.encode(t).ids) for t in texts]
        assert len(counter.keys) <= 10 + 100


def test_documents(docs, rows, no_docs, model, vocabulary):
    want = sorted(((r[0], len((r[1] or "").encode()), len(model.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows), key=repr)
    assert sorted(map(tuple, bpecount.count_tokens(docs, vocabulary).collect()), key=repr) == want
    assert bpecount.count_tokens(no_docs, vocabulary).collect() == []


def test_other_kinds_are_refused():
    with open(PATH) as f:
        j = json.load(f)
    j["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError):
        bpecount.Vocabulary.read(json.dumps(j))
    with open(PATH) as f:
        j = json.load(f)
    j["model"]["merges"].reverse()
    with pytest.raises(ValueError):
        bpecount.Vocabulary.read(json.dumps(j))


def test_no_merges(vocabulary):
    bare = bpecount.Vocabulary(vocabulary.byte_id, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert bare.surviving([b"abc", b"", b"z"]).tolist() == [3, 0, 1]
