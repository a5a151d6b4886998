import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from termweave.llm import bpe, packing
from termweave.llm.queries import ADDED
from termweave.llm.text import Flat


@pytest.fixture(scope="module")
def model():
    return bpe.Bpe(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), bits=14)


def test_pieces_and_sequences(documents, model, monkeypatch):
    r = random.Random(1)
    words = ["the", "internationalization", "<|endoftext|>", "naïve", "\n", "x9"]
    rows = [(k, " ".join(r.choices(words, k=r.choice([3, 50, 200, 400, 900])))) for k in range(120)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "a " * 9000), (503, " a" * 2047), (504, " a" * 4095)]
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}
    rows.append(rows[7])
    docs = documents(rows)
    monkeypatch.setattr(packing.packed, "__defaults__", (40,))  # several shards and levels
    got = packing.sequences(docs, model, added=ADDED).collect()
    assert sum(x["length"] for x in got) == sum(len(want[i]) for i, _ in rows)
    by = defaultdict(dict)
    for x in got:
        by[x["doc_id"]][x["piece"]] = x
    for i, ids in want.items():
        at = 0
        for k in range(len(by[i])):
            x = by[i][k]
            assert x["start"] == at and x["ids_crc32"] == zlib.crc32(np.array(ids[at : at + x["length"]], "<u4").tobytes())
            assert x["length"] == 2048 or k == 0
            at += x["length"]
        assert at == len(ids)
    assert (len(by[503]), len(by[504])) == (1, 2)
    bins = defaultdict(list)
    for x in got:
        bins[x["sequence_id"]].append((x["offset"], x["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.03 * fewest([x["length"] for x in got]) + 1


def fewest(sizes):
    """A lower bound of the number of bins: two pieces above half a bin never share one."""
    half = packing.LENGTH // 2
    bounds = [-(-sum(sizes) // packing.LENGTH)]
    for t in {x for x in sizes if x <= half}:
        alone = [x for x in sizes if x > packing.LENGTH - t]
        large = [x for x in sizes if half < x <= packing.LENGTH - t]
        rest = sum(x for x in sizes if t <= x <= half) - (len(large) * packing.LENGTH - sum(large))
        bounds.append(len(alone) + len(large) + max(0, -(-rest // packing.LENGTH)))
    return max(bounds)


def test_added_tokens_as_the_library_has_them(model):
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, mark * 3, f"{mark}x", None, "", f" {mark}\n", "<|endoftext|", f"é{mark}é", "plain"]
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids, first = model.encode_added(Flat.of(pa.array(texts)), ADDED)
    got = [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert got[0] == [64, 220, 50256, 275]


def packing_of(sizes, bins):
    fill = np.bincount(bins, sizes)
    assert len(bins) == len(sizes) and fill.max() <= packing.LENGTH
    return packing.fitness(sizes, bins)


def test_crossover_keeps_every_piece_once():
    r = np.random.default_rng(0)
    sizes = r.integers(1, 1500, 300)
    a = packing.best_fit(sizes, r.permutation(300))
    b = packing.best_fit(sizes, np.argsort(-sizes))
    for _ in range(20):
        packing_of(sizes, packing.crossover(sizes, a, b, r))


def test_evolution_beats_what_it_starts_from():
    r = np.random.default_rng(3)
    sizes = r.integers(300, 1100, 200)
    start = packing.best_fit(sizes, r.permutation(200))
    best = packing.evolve(sizes, [start], 1, crossings=40)
    assert packing_of(sizes, best) <= packing_of(sizes, packing.best_fit(sizes, np.argsort(-sizes)))
    assert packing_of(sizes, best)[0] < packing_of(sizes, start)[0]


def test_ones(documents, model):
    got = packing.sequences(documents([(k, "") for k in range(2100)]), model).collect()
    assert len({x["sequence_id"] for x in got}) == 2
    assert packing.sequences(documents([]), model).collect() == []


@pytest.mark.parametrize(
    ("sizes", "most"),
    [([1500] * 100, 100), ([700] * 100, 51), ([1500] * 60 + [700] * 60, 92), ([1500] * 50 + [548] * 20 + [90] * 30, 51), ([1] * 100, 3)],
)
def test_pools_that_fill_no_bins_end(spark, sizes, most):
    items = spark.createDataFrame(list(enumerate(sizes)), "row long, length long")
    got = packing.packed(items, 40).collect()
    assert sorted(x["row"] for x in got) == list(range(len(sizes)))
    fill = defaultdict(int)
    for x in sorted(got, key=lambda x: (x["sequence_id"], x["offset"])):
        assert x["offset"] == fill[x["sequence_id"]]
        fill[x["sequence_id"]] += sizes[x["row"]]
    assert max(fill.values()) <= packing.LENGTH and len(fill) <= most
