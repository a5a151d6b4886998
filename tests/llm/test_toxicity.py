import random

import numpy as np
import pytest

from termweave.llm import toxicity as X

FOUL = ["grubbler", "snidge", "vorkel"]
PLAIN = [f"word{k}" for k in range(300)]


def rows(n, seed):
    r = random.Random(seed)
    out = []
    for k in range(n):
        words = r.choices(PLAIN, k=r.randint(8, 60))
        bad = r.choice([0, 0, 1, 3, 6])
        for _ in range(bad):
            words.insert(r.randint(0, len(words)), r.choice(FOUL))
        out.append((k, " ".join(words), bad))
    return out


@pytest.fixture(scope="module")
def model(documents, spark):
    data = rows(400, 1)
    labels = [(k, int(bad > 0)) for k, _, bad in data] + [(3, 0), (None, 1), (7, None)]
    return X.fit(documents([(k, t) for k, t, _ in data]), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_severity_grows_with_what_is_foul(documents, model):
    data = rows(300, 2)
    odd = [(1000, None), (1001, ""), (1002, "word1 " * 30_000), (None, "GRUBBLER snidge"), (0, data[0][1])]
    got = X.scored(documents([(k, t) for k, t, _ in data] + odd), model).collect()
    assert len(got) == 305
    by = {x["doc_id"]: x for x in got}
    assert all(by[k]["toxic"] == (bad > 0) for k, _, bad in data)
    mean = [np.mean([by[k]["severity"] for k, _, bad in data if bad == n]) for n in (0, 1, 3, 6)]
    assert mean == sorted(mean) and mean[0] < 0.5 < mean[1] and mean[3] > 1.5
    assert all(0 <= x["severity"] <= X.GRADES for x in got)
    assert [by[k]["toxic"] for k in (1000, 1001, 1002, None)] == [False, False, False, True]


def test_thresholds_are_ordered_and_gradient_descends():
    r = np.random.default_rng(0)
    doc, column = np.arange(200), np.zeros(200, int)
    value = r.random(200) * 4
    grade = np.minimum(3, value.astype(int))
    m = X.Ordinal.train(np.array([1], np.uint64), doc, column, value, grade)
    assert (np.diff(m.thresholds) > 0).all() and m.weights[0] > 0
    up = m.at_least(m.weights[0] * value)
    assert (np.diff(up, axis=1) <= 0).all()
    assert np.mean(np.round(up.sum(1)) == grade) > 0.8


def test_without_labels_nothing_is_toxic(documents, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    m = X.fit(documents([(1, "a b")]), none)
    assert [x["toxic"] for x in X.scored(documents([(1, "a b"), (2, None)]), m).collect()] == [False, False]
    assert X.scored(documents([]), m).collect() == []
