import random
import re

import pytest

from termweave.llm import jaccard as J
from termweave.llm.components import components


def brute(rows):
    """n_shingles and component of each id."""
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", low(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = [i for i in sets if i is not None and sets[i]]
    for k, a in enumerate(ids):
        for b in ids[:k]:
            n = len(sets[a] & sets[b])
            if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i) if i is not None else None) for i, s in sets.items()}


def near_copies(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdef", k=4))
    passage = [word() for _ in range(40)]
    rows, i = [], 0
    for _ in range(12):
        base = [word() for _ in range(r.choice([3, 4, 5, 6, 30, 60, 120]))]
        if r.random() < 0.5:
            base += passage
        for _ in range(r.randint(1, 8)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                copy[r.randrange(len(copy))] = word()
            if r.random() < 0.2:
                copy += [word() for _ in range(r.randint(1, 12))]
            rows.append((i, " ".join(copy).upper() if r.random() < 0.2 else "\n ".join(copy)))
            i += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(documents, seed, monkeypatch):
    monkeypatch.setattr(J, "HOT", 3)  # as many shingles are common here as in a large corpus
    rows = near_copies(seed) + [(900, None), (901, ""), (902, " \n"), (None, "a b c d e f"), (903, "A b c d e f"), (904, "a B c d e f")]
    rows += [rows[0], rows[0]]
    got = J.classes(documents(rows)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == want
    assert want[904] == (2, 903) and want[901] == (0, 901)


def test_borders_of_similarity(documents):
    base = [f"w{k}" for k in range(14)]  # 10 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:12])), (3, " ".join(base[:11])), (4, "one"), (5, "ONE"), (6, "one two"), (7, "x " * 30_000)]
    got = {x["doc_id"]: x["component_id"] for x in J.classes(documents(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7}  # 8 of 10, 7 of 8


def test_empty_table(documents):
    assert J.classes(documents([])).collect() == []


def test_components(spark):
    chain = [(k, k + 1) for k in range(20, 60)] + [(60, 5), (70, 71), (71, 70), (72, 72), (None, 3)]
    star = [(200, k) for k in range(201, 260)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {5: 5} | {k: 5 for k in range(20, 61)} | {70: 70, 71: 70} | {k: 200 for k in range(200, 260)}
