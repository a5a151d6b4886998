import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from termweave.llm import lm as M
from termweave.llm.text import Flat

PIECES = ["th", "he", "e", "in", "ing", " th", " a", " b", "an", "ca", "at"]


@pytest.fixture
def lattice():
    pieces = [b"", *(bytes([b]) for b in range(256)), *(p.encode() for p in PIECES if len(p) > 1)]
    logs = np.log(np.random.default_rng(0).random(len(pieces)) + 0.1)
    return M.Lattice(pieces, logs - np.log(np.exp(logs).sum()))


def brute(lattice, word):
    known = {p: v for p, v in zip(lattice.pieces, lattice.logs, strict=True) if p}
    s = b" " + word
    paths = [0.0] + [-math.inf] * len(s)
    for b in range(1, len(s) + 1):
        ways = [paths[a] + known[s[a:b]] for a in range(b) if s[a:b] in known]
        paths[b] = max(ways) + math.log(sum(math.exp(x - max(ways)) for x in ways))
    return paths[-1]


def test_forward_recursion_and_expected_counts(lattice):
    words = [b"the", b"thing", b"x", "caté".encode(), b"in" * 70, b"a"]
    flat = Flat.of(pa.array(words, pa.binary()))
    n = np.array([1.0, 2, 1, 1, 3, 1])
    logs, expected = lattice.recursions(flat, flat.bounds[:-1], flat.bounds[1:], n)
    assert np.allclose(logs, [brute(lattice, w) for w in words], atol=1e-9)
    # the pieces of all segmentations spell the words
    assert math.isclose((expected * [len(p) for p in lattice.pieces]).sum(), sum(k * (len(w) + 1) for k, w in zip(n, words, strict=True)))


def test_scores(documents, lattice):
    rows = [(k, t) for k, t in enumerate(["The thing", "a cat in the", "the the THE", "", None, "cat " * 3000, "heeein\tunseen é"])]
    rows += [(0, "The thing"), (None, "the cat")]
    docs = documents(rows).withColumn("train", F.coalesce(F.col("doc_id") != 6, F.lit(True)))
    got = M.scored(docs, lattice, "train").collect()
    assert len(got) == len(rows)
    low = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    c, ends = Counter(), 0
    for k, t in rows:
        if k != 6:
            c.update(low(t))
            ends += 1
    total, kinds = sum(c.values()) + ends, len(c) + 1
    base = lambda n: math.log10((n + 0.1) / (total + 0.1 * (kinds + 1)))
    want = {k: (len(low(t)) + 1, sum(c[w] > 0 for w in low(t)) + 1, sum(base(c[w]) for w in low(t)) + base(ends)) for k, t in rows}
    for x in got:
        n, known, score = want[x["doc_id"]]
        assert (x["n_tokens"], x["n_known"], x["train_tokens"]) == (n, known, total)
        assert math.isclose(x["base_score"], score, rel_tol=1e-9)
        assert x["score"] < 0 and math.isfinite(x["score"])


def test_expectation_maximisation_raises_the_likelihood(spark, lattice):
    words = spark.createDataFrame([(k, w, 1) for k, w in enumerate(["the", "then", "thing", "cat", "eating", "ang"])], "key long, word string, n long")
    flat = Flat.of(pa.array([r["word"] for r in words.collect()]))
    total = [M.trained(words, lattice, k).recursions(flat, flat.bounds[:-1], flat.bounds[1:]).sum() for k in (0, 1, 2, 4)]
    assert total == sorted(total)


def test_empty_table(documents, lattice):
    assert M.scored(documents([]).withColumn("train", F.lit(True)), lattice, "train").collect() == []
