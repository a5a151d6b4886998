import hashlib
import pickle
import random
import tracemalloc

import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken

from termweave.llm import bpe
from termweave.llm.text import Flat

NAMES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


@pytest.fixture(scope="module")
def models():
    out = {}
    for name in NAMES:
        ranks = bpe.read_ranks(P.path(name))
        out[name] = bpe.Bpe(ranks, bits=14), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return out


def texts():
    rnd = random.Random(3)
    alphabet = "aab's tre'll ve'd'm  \n\t 　éß漢字12³½_-.,'\"!á🙂\x85\x1c'"
    out = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    words = ["internationalization", "donnée", "Straße", "the", "x" * 300, "  ", "\n\n", "ab" * 200, "0123456789" * 9]
    out += [" ".join(rnd.choice(words) for _ in range(20)) for _ in range(50)]
    return [*out, "'s", "''s", "a're'", " 's", "\n's", "it's'll", "", None]


@pytest.mark.parametrize("name", NAMES)
def test_ids_equal_the_library(models, name):
    own, library = models[name]
    all_texts = texts()
    ids, first = own.encode(Flat.of(pa.array(all_texts, pa.string())))
    for k, t in enumerate(all_texts):
        assert ids[first[k] : first[k + 1]].tolist() == library.encode_ordinary(t or ""), t
        assert own.decode(ids[first[k] : first[k + 1]]) == (t or "").encode()


def test_appends_and_edits(models):
    own, library = models[NAMES[0]]
    rnd = random.Random(5)
    grown = bpe.Prefixes(own)
    text = b""
    for _ in range(60):
        more = bytes(rnd.choice(b"thernationalizg") for _ in range(rnd.randint(1, 5)))
        text += more
        assert grown.append(more).ids() == bpe.Prefixes(own, text).ids()
    assert own.decode(grown.ids()) == text
    for _ in range(60):
        a = rnd.randint(0, len(text))
        b = min(len(text), a + rnd.randint(0, 6))
        new = bytes(rnd.choice(b"aeiou") for _ in range(rnd.randint(0, 4)))
        text = text[:a] + new + text[b:]
        assert grown.replace(a, b, new).ids() == bpe.Prefixes(own, text).ids()
        assert bytes(grown.data) == text and len(grown.last) == len(text)


def test_digests(documents, models):
    own, library = models[NAMES[0]]
    rows = [(1, "It's a test."), (1, "It's a test."), (2, None), (3, ""), (None, "x"), (5, "word " * 20_000)]
    got = bpe.digests(documents(rows), own).collect()
    assert len(got) == len(rows)
    want = {i: library.encode_ordinary(t or "") for i, t in rows}
    for r in got:
        ids = want[r["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert {r["doc_id"]: list(r["ids"]) for r in bpe.encoded(documents(rows), own).collect()} == want
    assert bpe.digests(documents([]), own).collect() == []


def test_character_classes_take_little_memory():
    """Every worker makes them: an object for each code point took 100 MB."""
    bpe.classes.cache_clear()
    tracemalloc.start()
    kinds = bpe.classes()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 30e6
    for c in ("a", "é", "中", "9", "²", " ", "\u3000", "!", "😀", chr(0xDFFF), chr(0xE000), chr(0x10FFFF)):
        kind = bpe.LETTER if regex.match(r"\p{L}", c) else bpe.NUMBER if regex.match(r"\p{N}", c) else bpe.SPACE if c in " \u3000" else bpe.OTHER
        assert kinds[ord(c)] == kind


def test_a_worker_s_vocabulary_takes_little_memory(models):
    """Dictionaries of tokens and pairs took 40 MB more in every worker: 70 MB of traced memory in all."""
    own, library = models[NAMES[1]]
    sent = pickle.dumps(own)
    bpe.classes()
    tracemalloc.start()
    worker = pickle.loads(sent)
    held = tracemalloc.get_traced_memory()[0]
    ids, _ = worker.encode(Flat.of(pa.array(["It's a short text."])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids.tolist() == library.encode_ordinary("It's a short text.")
    assert held < 10e6
    assert most < 50e6


def test_new_pieces_are_encoded_some_at_a_time(models, monkeypatch):
    own, library = models[NAMES[0]]
    largest = []
    suffixes = bpe.Bpe._suffixes
    monkeypatch.setattr(bpe.Bpe, "_suffixes", lambda self, data, *more: largest.append(len(data)) or suffixes(self, data, *more))
    monkeypatch.setattr(bpe, "AT_ONCE", 100)
    own.close()
    ids, first = own.encode(Flat.of(pa.array(texts(), pa.string())))
    assert max(largest) < 100 + bpe.LONG
    for k, t in enumerate(texts()):
        assert ids[first[k] : first[k + 1]].tolist() == library.encode_ordinary(t or ""), t
