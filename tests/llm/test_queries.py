"""Registered queries: against SQL where there is some, and their columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from termweave.llm import queries as Q
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": ["vec_id", "n_links", "component_id", "kept"],
    "op2_": ["page_id", "url", "text", "n_chars"],
    "op3_": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op4_": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op5_": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op6_": ["doc_id", "held_out", "lang_pred", "score"],
    "op7_": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_": ["doc_id", "n_shingles", "component_id"],
    "op9_": ["doc_id", "severity"],
    "op10_": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op11_": ["item_id", "rank", "doc_id", "score"],
    "op12_": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op13_": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
}


def test_names():
    assert len(Q.QUERIES) == 13 and set(Q.ORACLES) <= set(Q.QUERIES)
    assert all(sum(name.startswith(prefix) for name in Q.QUERIES) == 1 for prefix in COLUMNS)


@pytest.mark.parametrize("name", Q.ORACLES)
def test_against_sql(compiled, name):
    assert compare(Q.QUERIES[name](compiled, SF), duck(SF), Q.ORACLES[name]) == ""


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n not in Q.ORACLES])
def test_one_row_for_each_row(compiled, name):
    df = Q.QUERIES[name](compiled, SF)
    prefix = next(p for p in COLUMNS if name.startswith(p))
    assert df.columns[: len(COLUMNS[prefix])] == COLUMNS[prefix]
    key = df.columns[0]
    given = compiled.read.parquet(f"{SF}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    if prefix == "op10_":
        df = df.where("piece = 0")
    assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in given.select(key).collect())


def test_language_of_held_out_documents(compiled):
    got = Q.QUERIES["op6_language_gru"](compiled, SF).where("held_out")
    known = compiled.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = got.join(known, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9


def test_toxic_documents(compiled):
    got = Q.QUERIES["op9_toxicity_ordinal"](compiled, "/root/testdata/sf0.01").select("doc_id", F.col("toxic").alias("found"))
    known = compiled.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = got.join(known, "doc_id").groupBy("toxic", "found").count().collect()
    n = {(r["toxic"], r["found"]): r["count"] for r in rows}
    assert n[1, True] >= 0.9 * (n[1, True] + n.get((1, False), 0))
    assert n.get((0, True), 0) <= 0.02 * n[0, False]


def test_stages_are_in_order():
    assert [k for k, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "toxicity_grades", "near_duplicates", "secret_scan", "sequence_packing",
    ]
