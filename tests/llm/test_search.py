"""Reversed search against a plain ranking of every document for every item."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termweave.llm import search as S
from termweave.llm.text import Flat

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, top=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(1 for _, c in counted if c)
    length = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            m = 25 + (75 * sum(c.values()) * n) // length if length else 25
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text)
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


WORDS = st.sampled_from(["The", "the", "cat", "Cat7", "é", "É", "_", "x-y", "42", "漢字", "dog", "a", "\x7f", "'s"])
TEXT = st.one_of(st.none(), st.lists(WORDS, max_size=8).map(" ".join))


@given(st.lists(TEXT, max_size=8))
@settings(max_examples=100, deadline=None)
def test_terms(texts):
    key, doc = S.terms(Flat.of(pa.array(texts, pa.string())))
    names = [t for x in texts for t in terms(x)]
    assert doc.tolist() == [k for k, x in enumerate(texts) for _ in terms(x)]
    assert len(set(zip(names, key.tolist(), strict=True))) == len(set(names)) == len(set(key.tolist()))


@pytest.fixture(scope="module")
def corpus():
    r = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "the", "The"]
    chance = 1 / np.arange(1, len(vocabulary) + 1)
    draw = lambda n: " ".join(r.choice(vocabulary, n, p=chance / chance.sum()))
    docs = [(int(k), draw(int(n))) for k, n in enumerate(r.integers(1, 40, 150))]
    docs += [(200, None), (201, ""), (202, " - "), (None, docs[3][1]), (4, docs[3][1]), (3, docs[3][1]), (300, "w1 " * 50_000 + "w59")]
    items = [(k, draw(5)) for k in range(12)] + [(3, "w1 w1 the"), (None, "w2"), (20, None), (21, ""), (22, "unseen"), (23, "w59")]
    return docs, items


def given_items(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, "b") for i, t in items], "item_id long, text string, row int, doc_id int, part string")


@pytest.mark.parametrize("postings", [S.POSTINGS, 8])
def test_ranked(documents, spark, corpus, monkeypatch, postings):
    monkeypatch.setattr(S, "POSTINGS", postings)
    docs, items = corpus
    got = S.ranked(documents(docs).repartition(3), given_items(spark, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_ties_go_by_id(documents, spark):
    docs = [(k, "same words") for k in range(40, 0, -1)]
    got = S.ranked(documents(docs), given_items(spark, [(1, "words")]), top=3)
    assert [tuple(r)[1:3] for r in got.orderBy("rank").collect()] == [(1, 1), (2, 2), (3, 3)]


def test_empty_tables(documents, spark):
    some, none = [(1, "a b")], []
    assert S.ranked(documents(none), given_items(spark, some)).collect() == []
    assert S.ranked(documents(some), given_items(spark, none)).collect() == []
