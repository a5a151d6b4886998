import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from termweave.llm import text as T

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t漢\x0b ", max_size=30)), max_size=8)


@given(TEXTS)
@settings(max_examples=60, deadline=None)
def test_words_and_lines(texts):
    flat = T.Flat.of(pa.array(texts, pa.string()))
    cut = lambda s: [flat.data[a:b].tobytes().decode() for a, b in zip(s.starts, s.ends, strict=True)]
    w = T.words(flat)
    assert cut(w) == [x for t in texts for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert w.doc.tolist() == [k for k, t in enumerate(texts) for _ in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert cut(T.lines(flat)) == [x for t in texts for x in (t or "").split("\n")]


@given(st.lists(st.text(alphabet="abAB", max_size=6), min_size=1, max_size=40))
@settings(max_examples=60, deadline=None)
def test_hashes_name_strings(texts):
    flat = T.Flat.of(pa.array(texts))
    h = T.slice_hash(flat.sums(lower=True), flat.bounds[:-1], flat.bounds[1:])
    names = {}
    for t, x in zip(texts, h.tolist(), strict=True):
        assert names.setdefault(t.lower(), x) == x
    assert len(set(names.values())) == len(names)


def test_memo_makes_every_key_once_and_survives_its_bound():
    memo, made = T.Memo(4), []

    def make_for(keys):
        def make(first):
            made.extend(keys[first].tolist())
            return [keys[first] * np.uint64(2)]

        return make

    for start in (1, 1, 4, 30):
        keys = np.arange(start, start + 20, dtype=np.uint64) % np.uint64(25) + np.uint64(1)
        rows = memo.rows_of(keys, make_for(keys))
        assert (memo.values[0][rows] == keys * np.uint64(2)).all()
    assert len(made) < 80


def test_chunks_keep_rows_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 50, None, "b" * 500, "", "c"])], names=["text"])
    parts = list(T.chunked([batch], "text", 60))
    assert [x for p in parts for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert len(parts) == 2
