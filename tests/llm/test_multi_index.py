import math

import numpy as np

from termweave.llm import multi_index as M


def brute(ids, x, least=0.95):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= least
    root = list(range(len(ids)))
    for _ in range(len(ids)):
        new = [min(root[j] for j in np.flatnonzero(close[k])) for k in range(len(ids))]
        if new == root:
            break
        root = new
    return {i: (int(close[k].sum()) - 1, min(ids[j] for j in range(len(ids)) if root[j] == root[k])) for k, i in enumerate(ids)}


def table(spark, rows):
    kind = "vec_id long, embedding array<float>, label int, rid string, region int"
    return spark.createDataFrame([(i, v, 1, "r", 2) for i, v in rows], kind)


def test_links_and_components(spark, monkeypatch):
    monkeypatch.setattr(M, "CELL", 4)
    monkeypatch.setattr(M, "SPAN", 2)
    monkeypatch.setattr(M, "MEMBERS", 8)
    monkeypatch.setattr(M, "CALLERS", 16)
    r = np.random.default_rng(1)
    centres = r.standard_normal((60, 16))
    group = np.repeat(np.arange(60), r.choice([1, 2, 6], 60))
    x = (centres[group] + 0.12 * r.standard_normal((len(group), 16))).astype(np.float32)
    x = np.concatenate([x, np.repeat(x[:1], 30, 0), x[5:6] * 3])  # copies, and a multiple
    ids = r.permutation(len(x)).tolist()
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [math.nan] + [1.0] * 15), (9003, [None] + [1.0] * 15), (9004, [math.inf] + [1.0] * 15), (9005, [])]
    rows = [(i, v.tolist()) for i, v in zip(ids, x, strict=True)]
    got = {}
    for y in M.classes(table(spark, rows + odd + [rows[0], (None, [1.0] * 16)])).collect():
        assert y["vec_id"] not in got
        got[y["vec_id"]] = (y["n_links"], y["component_id"])
        assert y["kept"] == (y["vec_id"] is not None and y["vec_id"] == y["component_id"])
    want = brute(ids, x.astype(float))
    links = sum(n for n, _ in want.values())
    found = sum(got[i][0] for i in want)
    assert 0.97 * links <= found <= links
    assert all(got[i][0] <= want[i][0] for i in want)
    assert np.mean([got[i] == want[i] for i in want]) > 0.95
    assert all(got[i] == (0, i) for i, _ in odd) and got[None] == (0, None)


def test_traversal_takes_the_nearest_cells():
    r = np.random.default_rng(2)
    x = r.standard_normal((500, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    grid = M.Grid(x, 4000)
    who, i, j = grid.visits(x[:50])
    a, b = grid.moves(x[:50])
    want = {(k, p, q) for k in range(50) for p in range(a.shape[1]) for q in range(b.shape[1]) if a[k, p] + b[k, q] <= grid.stop}
    assert set(zip(who.tolist(), i.tolist(), j.tolist(), strict=True)) == want and len(who) == len(want)
    own = grid.cells(x[:50])
    assert all((k, own[0][k], own[1][k]) in want for k in range(50))


def test_recall_of_neighbours_that_are_just_similar():
    r = np.random.default_rng(3)
    x = r.standard_normal((6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    grid = M.Grid(x[:4000], 20_000)
    turn = r.standard_normal((2000, 32))
    turn -= (turn * x[4000:]).sum(1, keepdims=True) * x[4000:]
    y = 0.95 * x[4000:] + math.sqrt(1 - 0.95**2) * turn / np.linalg.norm(turn, axis=1, keepdims=True)
    who, i, j = grid.visits(x[4000:])
    visited = set(zip(who.tolist(), i.tolist(), j.tolist(), strict=True))
    p, q = grid.cells(y)
    assert np.mean([(k, p[k], q[k]) in visited for k in range(2000)]) > 0.98


def test_small_tables(spark):
    assert M.classes(table(spark, [])).collect() == []
    assert [tuple(x) for x in M.classes(table(spark, [(4, [1.0, 2.0])])).collect()] == [(4, 0, 4, True)]
    assert [tuple(x) for x in M.classes(table(spark, [(4, None)])).collect()] == [(4, 0, 4, True)]
    got = sorted(map(tuple, M.classes(table(spark, [(4, [1.0, 2.0, 0.0]), (5, [1.0, 2.0])])).collect()))
    assert got == [(4, 1, 4, True), (5, 1, 4, False)]
