"""Runs against every stretch of a text, and planted ones against the rule that plants them."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from termweave.llm import periodic as P
from termweave.llm import text as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if all(w[k] == w[k + q] for k in range(len(w) - q)))


def brute(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        a = 0
        while a + q < len(w):
            b = a + q
            while b < len(w) and w[b] == w[b - q]:
                b += 1
            if b - a >= max(6, 4 * q) and smallest_period(w[a:b]) == q:
                out.append((a, b - a, q))
            a = max(a + 1, b - q + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(i, w):
    h = zlib.crc32(str(i).encode())
    if i is None or h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def digest(i, text):
    w = planted(i, WORD.findall(text or ""))
    found = brute(w)
    drop = {k for a, n, q in found for k in range(a + q, a + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        i, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        sha("".join(f"{a},{n},{q}\n" for a, n, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in drop)),
    )


PART = st.builds(lambda w, n: w * n, st.lists(st.sampled_from("aabcé"), min_size=1, max_size=5), st.integers(1, 9))
TEXT = st.one_of(st.none(), st.lists(PART, max_size=6).map(lambda x: " \t".join(w for p in x for w in p)))


@given(st.lists(TEXT, max_size=5))
@settings(max_examples=300, deadline=None)
def test_runs(texts):
    flat = T.Flat.of(pa.array(texts, pa.string()))
    found = list(zip(*(x.tolist() for x in P.runs(flat, T.words(flat))), strict=True))
    assert found == [(k, *r) for k, t in enumerate(texts) for r in brute(WORD.findall(t or ""))]


def test_suffixes():
    r = np.random.default_rng(3)
    for n in (1, 2, 7, 60):
        names = r.integers(0, 3, n)
        order, shared = P.suffixes(names)
        all_ = names.tolist()
        assert order.tolist() == sorted(range(n), key=lambda k: all_[k:])
        for a, b, lcp in zip(order[:-1], order[1:], shared, strict=True):
            assert all_[a : a + lcp] == all_[b : b + lcp] and all_[a + lcp : a + lcp + 1] != all_[b + lcp : b + lcp + 1]


def rows():
    r = np.random.default_rng(9)
    prose = lambda n: " ".join(r.choice([f"w{k}" for k in range(40)], n))
    out = [(k, prose(int(n))) for k, n in enumerate(r.integers(0, 120, 300))]
    out += [(1000, None), (1001, ""), (1002, " \n"), (1003, "x " * 5), (1004, "x " * 6), (1005, "x y " * 30 + "z " * 9)]
    out += [(1006, "a b c d e " * 4 + "f " + "a b c d e " * 4), (None, "é è " * 8), (None, None), out[7], out[7]]
    return out


def test_digests(documents):
    given_ = rows()
    got = P.digests(P.with_planted(documents(given_).repartition(3)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {k for c, k in got.dtypes if c in got.columns[:6]} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == sorted((digest(i, t) for i, t in given_), key=str)


def test_very_long_text(documents):
    text = " ".join(f"u{k}" for k in range(30_000)) + " p q r" * 50_000 + " q" * 60_000
    row = P.periodic(documents([(1, text)])).first()
    assert [tuple(x) for x in row["runs"]] == [(30_000, 150_000, 3), (180_000, 60_000, 1)]
    assert row["collapsed"].endswith(" u29999 p q r q")


def test_no_documents(documents):
    assert P.digests(P.with_planted(documents([]))).collect() == []
