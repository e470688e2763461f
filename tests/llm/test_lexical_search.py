"""Ranked search against a plain scoring of every document for every item."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from safetymart.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    split = [(d, terms(t)) for d, t in docs]
    split = [(d, t) for d, t in split if t]
    count, length = len(split), sum(len(t) for _, t in split)
    tf = [Counter(t) for _, t in split]
    df = Counter(x for c in tf for x in c)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, words), c in zip(split, tf):
            m = 25 + (75 * len(words) * count) // length
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[x] + 1)))
                * ((1_000_000_000 * c[x]) // (1000 * c[x] + 8 * m))
                for x in terms(text)
                if x in c
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        scores = sorted(scores)[:k]
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(scores, 1)]
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abé1"), rng.integers(1, 4))) for _ in range(120)]
    docs = [" ".join(rng.choice(words, rng.integers(1, 40))) for _ in range(200)]
    docs += [d.upper() + "!" for d in docs[:30]] + [docs[3]] * 40 + [None, "", "...", "É x", "x" * 30_000]
    docs += [" ".join(rng.permutation(docs[5].split())) for _ in range(5)]
    rows = [(int(i), d) for i, d in zip(rng.permutation(len(docs)), docs)]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 9)))) for i in range(25)]
    items += [(25, docs[3]), (26, docs[3]), (26, docs[3]), (27, None), (28, "?"), (29, "nowhere"), (None, "x X")]
    return rows, items


@pytest.mark.parametrize("block", [100_000, 40])
def test_search(spark, corpus, rows, monkeypatch, block):
    monkeypatch.setattr(ls, "BLOCK_TERMS", block)
    docs, items = corpus
    docs = docs + [docs[0], (None, docs[7][1]), (None, docs[7][1])]
    table = spark.createDataFrame([(*d, 1, 2.0) for d in docs], "doc_id long, text string, n int, score double")
    bench = spark.createDataFrame([(*i, "m") for i in items], "item_id long, text string, bag string")
    assert rows(ls.search(table, bench)) == sorted(plain(docs, items), key=repr)


def test_fewer_and_other_names(spark, corpus, rows):
    docs, items = corpus
    table = spark.createDataFrame(docs, "key long, body string")
    bench = spark.createDataFrame([(f"q{i}", t) for i, t in items], "q string, words string")
    found = ls.search(table, bench, 3, "key", "body", "q", "words")
    assert rows(found) == sorted(plain(docs, [(f"q{i}", t) for i, t in items], 3), key=repr)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert ls.search(none, bench).collect() == []
    assert ls.search(spark.createDataFrame(docs, none.schema), bench.limit(0)).collect() == []


def test_long_text_in_pieces(monkeypatch):
    text = ("ab cde " * 500 + "f" * 300 + " ab").encode()
    vocabulary = {b"ab": 0, b"f" * 300: 1}
    whole = ls.term_counts(text, vocabulary)
    for size in (1, 2, 3, 100):
        monkeypatch.setattr(ls, "PIECE_BYTES", size)
        assert ls.term_counts(text, vocabulary) == whole == (1002, Counter({0: 501, 1: 1}))
