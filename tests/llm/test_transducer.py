"""Counts and matches against the library of the vocabulary."""

import functools

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from termweave.llm import text as T
from termweave.llm import transducer as X

PATH = public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def library():
    return Tokenizer.from_file(PATH)


@functools.cache
def counter():
    return X.Counter(X.Vocabulary.read(PATH))


def brute(texts):
    return [len(library().encode(t or "", add_special_tokens=False).ids) for t in texts]


def count(texts):
    return counter().count(T.Flat.of(pa.array(texts, pa.string()))).tolist()


PART = st.one_of(
    st.sampled_from([
        "'s", "'re", "'r", "'ll", "'l", "'v", "'", "''", " ", "  ", "\n", " \n ", "\t", " ", "　", "word", " Words", "1", " 23", "½", "é", "漢字",
        "<|endoftext|>", "<|endof", "!", "?!", "…", "\x00", "a" * 40, "-" * 70, "ab" * 90, "😀", "'t", "'d've", "x's",
    ]),
    st.text(max_size=6),
)
TEXT = st.one_of(st.none(), st.lists(PART, max_size=12).map("".join))


@given(st.lists(TEXT, max_size=6))
@settings(max_examples=400, deadline=None)
def test_matches(texts):
    flat = T.Flat.of(pa.array(texts, pa.string()))
    p = X.matches(flat)
    got = [(int(d), flat.data[a:b].tobytes().decode()) for d, a, b in zip(p.doc, p.starts, p.ends, strict=True)]
    assert got == [(k, m) for k, t in enumerate(texts) for m in regex.findall(public_tokenizers.PATTERN, t or "")]


def test_matches_do_not_depend_on_chunks(monkeypatch):
    text = "it's  we're\n\n 'l 'll 42nd\t… é's " * 30
    flat = T.Flat.of(pa.array([text, None, text[5:], ""]))
    want = X.matches(flat)
    for n in (1, 3, 1000):
        monkeypatch.setattr(X, "CHARS", n)
        assert np.array_equal(X.matches(flat).starts, want.starts)


@given(st.lists(TEXT, max_size=6))
@settings(max_examples=400, deadline=None)
def test_counts(texts):
    assert count(texts) == brute(texts)


def test_characters_that_the_library_s_unicode_lacks():
    newer = np.flatnonzero(X.library_classes() != X.classes())
    newer = newer[(newer < 0xD800) | (newer >= 0xE000)][::40]
    texts = [f"{chr(c)}'s a{chr(c)} {chr(c)}1" for c in [0x3D000, 0x558, *newer.tolist()]]
    assert count(texts) == brute(texts)


@given(st.lists(st.text("abeinrst'-=_", min_size=130, max_size=900), min_size=1, max_size=4), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_long_matches(texts, span):
    own, X.SPAN = X.SPAN, span
    try:
        assert count(texts) == brute(texts)
    finally:
        X.SPAN = own


@pytest.mark.parametrize("text", ["a" * 300_000, "ab" * 100_000, "-" * 99_999, "=" * 5_000 + "漢" * 5_000, " " * 70_000 + "x"])
def test_very_long_matches(text):
    assert count([text, None, text[1:]]) == brute([text, None, text[1:]])


def test_states_are_made_anew_when_there_are_too_many(monkeypatch):
    monkeypatch.setattr(X, "KEPT", 5)
    fresh = X.Counter(X.Vocabulary.read(PATH))
    for texts in (["one two", "three"], ["four five", None], ["six sevens"]):
        fresh.known = None
        assert fresh.count(T.Flat.of(pa.array(texts))).tolist() == brute(texts)


def test_counted(documents):
    rows = [(k, f"Words {k} that's <|endoftext|> é " * (k % 7)) for k in range(60)] + [(60, None), (61, ""), (None, "x"), (3, "again"), (3, "again")]
    got = X.counted(documents(rows).repartition(3), X.Vocabulary.read(PATH))
    want = [(i, len((t or "").encode()), n) for (i, t), n in zip(rows, brute([t for _, t in rows]), strict=True)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert X.counted(documents([]), X.Vocabulary.read(PATH)).collect() == []
