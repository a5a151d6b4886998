"""Every stage against what a plain program makes of its input."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from termweave.llm import packing
from tests.llm.test_jaccard import brute
from tests.llm.test_secrets import brute as secret_spans

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


def prose(r, n):
    return " ".join("".join(r.choices("abcdefgh", k=r.randint(3, 7))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def raw():
    r = random.Random(7)
    rows = [(k, prose(r, 40)) for k in range(300)]
    rows += [(1000 + k, " ".join(f"{w}%%%" for w in prose(r, 40).split())) for k in range(40)]
    rows += [(2000 + k, prose(r, 20) + " snidge vorkel " + prose(r, 20)) for k in range(60)]
    rows += [(3000 + k, rows[k][1] + " and more") for k in range(10)]
    rows += [(3100 + k, rows[k][1]) for k in range(10)]
    rows += [(4000 + k, f"{prose(r, 30)} password: {k}abcdefgh{k} {prose(r, 10)}") for k in range(10)]
    rows += [(5000, None), (5001, ""), (5002, "short"), (None, prose(r, 40)), (7, rows[7][1])]
    return [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows]


@pytest.fixture(scope="module")
def folder(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(raw, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(2000 <= i < 3000)) for i, *_ in raw if i is not None and i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def results(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, step in P.STAGES:
        path = f"{folder}/{name}"
        step(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def number(i):
    return -1 if i is None else i


def texts(df):
    return sorted((number(r["doc_id"]), r["text"] or "") for r in df.collect())


def test_quality(raw, results):
    want = [(number(i), t) for i, t, *_ in raw if t and len(t.split()) >= 10 and "%%%" not in t]
    assert texts(results[0]) == sorted(want)
    assert results[0].columns == list(P.COLUMNS)


def test_toxicity(results):
    assert texts(results[1]) == [(i, t) for i, t in texts(results[0]) if "snidge" not in t]


def test_near_duplicates(results):
    rows = [(r["doc_id"], r["text"]) for r in results[1].collect()]
    classes = brute([x for x in rows if x[0] is not None])
    kept = {i: t for i, t in rows if i is not None and classes[i][1] == i}
    want = [(-1, t) for i, t in rows if i is None] + list(kept.items())
    assert texts(results[2]) == sorted(want)


def test_near_duplicates_by_id_and_text(spark):
    r = random.Random(3)
    t, u, v, w = (prose(r, 40) for _ in range(4))
    rows = [(1, t), (2, t), (2, u), (3, u + " x"), (4, v), (4, w), (4, w), (5, None), (5, None), (6, ""), (None, t), (None, t)]
    docs = spark.createDataFrame([(i, x, "en", "s", 1, "x") for i, x in rows], SCHEMA)
    kept = P.near_duplicates(spark, docs, "")
    assert texts(kept) == sorted([(1, t), (2, u), (4, v), (4, w), (5, ""), (6, ""), (-1, t), (-1, t)])
    assert P.near_duplicates(spark, docs.limit(0), "").collect() == []


def test_secrets(results):
    def masked(text):
        for a, _, b in reversed(secret_spans(text)):
            text = text[:a] + P.MASK + text[b:]
        return text

    assert texts(results[3]) == sorted((i, masked(t)) for i, t in texts(results[2]))
    assert all(r["n_chars"] == len(r["text"]) for r in results[3].collect())
    assert results[3].where(F.col("text").contains(P.MASK)).count() == 10


def test_sequences(results):
    pieces = results[4].groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r["n"] for r in pieces) <= packing.LENGTH
    assert sorted(number(r["doc_id"]) for r in results[4].where("piece = 0").collect()) == [i for i, _ in texts(results[3])]


def test_run_is_the_stages_one_after_another(spark, folder, results):
    got = P.run(spark, folder)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, results[4].select(columns).collect()))


def test_no_documents(spark, folder, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{path}/labels.parquet")
    assert P.run(spark, path).collect() == []
    assert re.fullmatch(r"\[.*\]", P.MASK)
