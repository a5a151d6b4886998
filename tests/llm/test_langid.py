import random

import numpy as np
import pyarrow as pa
import pytest

from termweave.llm import langid as G
from termweave.llm import text as T

SYLLABLES = {"aa": ["ka", "ro", "ti", "na"], "bb": ["sch", "ung", "keit", "ver"], "cc": ["ção", "lhe", "ñu", "é"]}


def text(lang, r, n=12):
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 4))) for _ in range(n))


def test_gradients():
    r = np.random.default_rng(1)
    m = G.BiGru(["a", "b", "c"])
    m.w = {k: v.astype(float) for k, v in m.w.items()}
    tokens, size = r.integers(0, 256, (5, 6)), np.array([6, 4, 3, 6, 2])
    mask = (np.arange(6) < size[:, None]).astype(float)
    target, weight = np.array([0, 1, 2, 1, 0]), np.array([1, 2, 1, 0.5, 1])
    _, g = m.gradients(tokens, mask, target, weight)
    for k, v in m.w.items():
        for _ in range(3):
            at = tuple(r.integers(0, s) for s in v.shape) if k != "E" else (tokens[r.integers(5), 0], r.integers(G.INPUT))
            old, step, losses = v[at], 1e-4, []
            for sign in (1, -1):
                v[at] = old + sign * step
                losses.append(m.gradients(tokens, mask, target, weight)[0])
            v[at] = old
            assert abs((losses[0] - losses[1]) / (2 * step) - g[k][at]) < 1e-4, k


def test_words_of_a_size_need_no_mask():
    r = np.random.default_rng(3)
    m = G.BiGru(["a", "b"])
    tokens, size = r.integers(0, 256, (40, G.WINDOW + 2)), r.integers(2, G.WINDOW + 2, 40)
    mask = (np.arange(G.WINDOW + 2) < size[:, None]).astype(np.float32)
    logp = m.log_probabilities(tokens, mask)
    want = np.einsum("tnl,nt->nl", logp, mask)
    assert np.allclose(m.word_scores(tokens, size)[:, :2], want, atol=1e-3)


@pytest.fixture(scope="module")
def model(spark):
    r = random.Random(1)
    rows = [(k, text(lang, r), lang) for k in range(60) for lang in SYLLABLES]
    rows += [(900, None, "aa"), (901, "x", None)]
    return G.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_held_out_accuracy_and_odd_texts(documents, model):
    r = random.Random(2)
    rows = [(k, text(lang, r)) for k, lang in enumerate(list(SYLLABLES) * 30)]
    odd = [(1000, None), (1001, ""), (1002, "12 345 -"), (1003, "keitung" * 30_000), (None, "karo tina"), (0, rows[0][1])]
    docs = documents(rows + odd)
    got = G.predicted(docs, model, ("doc_id",)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in got}
    assert np.mean([by[k][0] == list(SYLLABLES)[k % 3] for k in range(90)]) > 0.95
    assert [by[k] for k in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by[1003][0] == "bb" and by[None][0] == "aa"
    assert all(0 <= x["score"] <= 1 for x in got)


def test_nothing_to_learn_from(documents, spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert G.fit(empty) is None
    got = G.predicted(documents([(1, "words")]), None, ("doc_id",)).collect()
    assert [(x["lang_pred"], x["score"]) for x in got] == [("und", 0.0)]
    assert G.predicted(documents([]), None, ("doc_id",)).collect() == []


def test_training_reads_behind_a_shared_opening(documents, spark):
    r = random.Random(4)
    notice = text("bb", r, 700)
    assert len(notice) > 4000
    rows = [(k, f"{notice} {text('aa', r, 4000)}", "aa") for k in range(20)]
    rows += [(100 + k, text("bb", r, 700), "bb") for k in range(20)]
    model = G.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    new = [(k, text(lang, r)) for k, lang in enumerate(["aa", "bb"] * 20)] + [(99, notice)]
    got = {x["doc_id"]: x["lang_pred"] for x in G.predicted(documents(new), model, ("doc_id",)).collect()}
    assert got.pop(99) == "bb"
    assert np.mean([got[k] == ["aa", "bb"][k % 2] for k in got]) > 0.95


def test_windows_are_cut_at_characters_and_count_each_byte_once():
    texts = ["漢字かな" * 40 + " kurz " + "é" * 30, "", "\U0001f600" * 20 + "x" * 49, "a" * 24, "b" * 25, " "]
    flat = T.Flat.of(pa.array(texts))
    w = G.Windows(flat)
    for a, b, start, end in zip(w.read.starts, w.read.ends, w.start, w.end, strict=True):
        flat.data[a:b].tobytes().decode()
        (b" " + flat.data[a:b].tobytes() + b" ")[start:end].decode()
        assert b - a + 2 <= G.WIDE and end - start <= G.WINDOW + 5
    words = [len(x.encode()) + 2 for t in texts for x in t.split()]
    assert (w.end - w.start).sum() == sum(words)
    assert len(w) == sum(-(-(n - 2) // G.WINDOW) for n in words)


def test_windows_hold_their_bytes_in_context():
    r = np.random.default_rng(6)
    m = G.BiGru(["a", "b", "c"])
    flat = T.Flat.of(pa.array(["".join(map(chr, r.integers(0x4E00, 0x4E80, 90))), "short"]))
    w = G.Windows(flat)
    got = m.word_scores(*G.padded(flat, w.read.starts, w.read.ends), w.start, w.end)
    for k, (a, b) in enumerate(zip(w.read.starts, w.read.ends, strict=True)):
        tokens = np.frombuffer(b" " + flat.data[a:b].tobytes() + b" ", np.uint8)[None]
        want = m.log_probabilities(tokens, None)[w.start[k] : w.end[k], 0].sum(0)
        assert np.allclose(got[k, :-1], want, atol=1e-3)


def test_held_out_accuracy_without_blanks(documents, spark):
    """Languages of one script whose characters overlap; texts have no blank at all."""
    r = random.Random(8)
    signs = {lang: [chr(0x4E00 + 40 * k + j) for j in range(100)] for k, lang in enumerate(["aa", "bb", "cc"])}

    def text(lang, n):
        return "".join(r.choices(signs[lang], k=n))

    rows = [(100 * k + j, text(lang, 300), lang) for k, lang in enumerate(signs) for j in range(40)]
    model = G.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    new = [(k, text(list(signs)[k % 3], 60)) for k in range(120)]
    got = {x["doc_id"]: x["lang_pred"] for x in G.predicted(documents(new), model, ("doc_id",)).collect()}
    assert np.mean([got[k] == list(signs)[k % 3] for k in got]) > 0.95


def test_words_are_drawn_from_the_whole_text():
    texts = [" ".join(f"w{k}" for k in range(10_000)), "a b", "", "x" * 100]
    w = G.drawn(T.Flat.of(pa.array(texts)))
    assert np.bincount(w.doc, minlength=4).tolist() == [G.WORDS, 2, 0, 5]
    at = w.starts[w.doc == 0]
    assert np.histogram(at, 10, (0, len(texts[0])))[0].min() > G.WORDS / 20
