from datetime import date

import pytest
from pyspark.sql import functions as F

from termweave.operators.audit import record_count_audit, sentinel_counts
from termweave.operators.match import matched_records, missing_records
from termweave.operators.rollup import concat_per_record, dense_rank_values
from termweave.operators.schools import school_crosswalk, with_schools
from termweave.operators.terms import (
    nearest_terms_by_date,
    nearest_terms_by_span,
    term_match_counts,
    with_best_term_by_span,
    with_terms_by_date,
)
from tests.fixtures import SCHOOLS, SCORECARD, TERMS, frame


@pytest.fixture(scope="module")
def terms(spark):
    return frame(spark, "term", TERMS)


def days(spark, *values):
    return spark.createDataFrame([(d,) for d in values], "day date")


@pytest.mark.parametrize(
    "day, expected",
    [
        # Two terms that start together share rank 1; the test row never counts.
        (date(2022, 2, 1), {("SS", 1), ("WQ", 1)}),
        (date(2022, 5, 1), {("SQ", 1), ("SS", 2)}),
        # Both bounds belong to a term.
        (date(2022, 12, 31), {("NY", 1), ("FQ", 2)}),
        (date(2022, 8, 1), {("FS", 1)}),
        # A term of the year before does not count, nor does a day outside all terms.
        (date(2023, 1, 15), set()),
        (date(2022, 7, 15), set()),
    ],
)
def test_nearest_terms_by_date(spark, terms, day, expected):
    found = nearest_terms_by_date(days(spark, day, day), terms, "day").collect()
    assert {(r.GAS_id, r.term_rank) for r in found} == expected
    assert len(found) == len(expected)
    joined = with_terms_by_date(days(spark, day, day), terms, "day").collect()
    assert sorted(r.GAS_id for r in joined) == sorted(2 * [gas_id for gas_id, _ in expected])


def test_at_most_two_ranks_per_date(spark, terms):
    all_days = spark.range(730).select(
        F.date_add(F.lit(date(2022, 1, 1)), F.col("id").cast("int")).alias("day")
    )
    ranks = nearest_terms_by_date(all_days, terms, "day").groupBy("day").agg(
        F.max("term_rank").alias("top"), F.min("term_rank").alias("low")
    )
    assert ranks.where("top > 2 OR low <> 1").count() == 0


SPANS = [
    (1, date(2022, 8, 22), date(2022, 12, 16)),
    (2, date(2022, 1, 17), date(2022, 5, 11)),
    (3, date(2022, 1, 9), date(2022, 3, 31)),
    (4, date(2022, 9, 20), date(2022, 12, 16)),
    (5, date(2022, 8, 22), date(2022, 12, 16)),
    (6, date(2022, 3, 31), date(2022, 3, 31)),
    (7, date(2022, 11, 20), date(2023, 2, 1)),
    (8, None, date(2022, 3, 31)),
    (9, date(2022, 1, 9), None),
    (10, date(2022, 8, 22), date(2024, 1, 1)),
]


def test_best_term_by_span_equals_ranks_one_and_one(spark, terms):
    spans = spark.createDataFrame(SPANS, "id int, b date, e date")
    best = with_best_term_by_span(spans, terms, "b", "e")
    ranked = nearest_terms_by_span(spans, terms, "b", "e").where("start_rank = 1 AND end_rank = 1")
    expected = spans.join(ranked, ["b", "e"]).select("id", "GAS_id")
    found = {(r.id, r.GAS_id) for r in best.select("id", "GAS_id").collect()}
    assert found == {(r.id, r.GAS_id) for r in expected.collect()}
    assert {i for i, _ in found} >= {1, 3, 4, 5, 7}
    assert not {i for i, _ in found} & {8, 9, 10}


def test_span_without_one_nearest_term_is_dropped(spark):
    # The nearest start is term A, the nearest end term B.
    calendar = [dict(TERMS[0]), dict(TERMS[0])]
    calendar[0].update(GAS_id="A", GAS_start_date=date(2022, 8, 1), GAS_end_date=date(2022, 12, 31))
    calendar[1].update(GAS_id="B", GAS_start_date=date(2022, 7, 1), GAS_end_date=date(2022, 12, 1))
    spans = spark.createDataFrame([(date(2022, 8, 1), date(2022, 12, 1))], "b date, e date")
    assert with_best_term_by_span(spans, frame(spark, "term", calendar), "b", "e").count() == 0


def test_term_match_counts(spark, terms):
    spans = spark.createDataFrame(SPANS[:1], "id int, b date, e date")
    ranked = nearest_terms_by_span(spans, terms, "b", "e")
    counts = {
        (r.GAS_Name_short, r.start_rank, r.end_rank): r.num_terms
        for r in term_match_counts(ranked, "b", "e").collect()
    }
    assert counts[("Fall 2022", 1, 1)] == 1
    assert counts[("Fall 2022", 2, 1)] == 1


def test_crosswalk_keeps_accounts_without_scorecard(spark):
    schools = frame(spark, "school_account", SCHOOLS)
    rows = school_crosswalk(schools, frame(spark, "scorecard", SCORECARD)).collect()
    assert {(r.account_id, r.cs_college_branch_code_6) for r in rows} == {
        ("A1", "123400"),
        ("A2", "123400"),
        ("A3", None),
    }


def test_feed_rows_without_college_are_dropped(spark):
    feed = spark.createDataFrame([("123400",), ("",), (None,)], "nsc_college_code_branch string")
    rows = with_schools(
        feed, frame(spark, "school_account", SCHOOLS), frame(spark, "scorecard", SCORECARD)
    )
    assert sorted((r.account_id, r.college_academic_calendar) for r in rows.collect()) == [
        ("A1", "Semester"),
        ("A2", "Semester"),
    ]


def test_one_match_excludes_all_degrees_of_a_student(spark):
    records = spark.createDataFrame(
        [("S1", "T1"), ("S1", "T2"), ("S2", "T9"), ("S3", "T1")],
        "contact_id_mod string, PAT_GAS_id string",
    )
    mapped = spark.createDataFrame(
        [("S1", "T1"), ("S1", "T5"), ("S2", "T1"), ("S2", "T2"), ("s3", "T1"), (None, "T1")],
        "contact_id_nsc string, GAS_id string",
    )
    students = records.select("contact_id_mod").distinct()
    matched = matched_records(records, mapped).collect()
    missing = missing_records(students, mapped, records).collect()
    assert {(r.contact_id_nsc, r.GAS_id) for r in matched} == {("S1", "T1")}
    assert sorted((r.contact_id_nsc, r.GAS_id) for r in missing) == [("S2", "T1"), ("S2", "T2")]


ENTRIES = [
    ("r1", date(2022, 1, 2), "B", "x", 1),
    ("r1", date(2022, 1, 1), None, "y", 1),
    ("r1", date(2022, 1, 1), None, "y", 2),
    ("r1", None, "A", None, 1),
    ("r2", None, None, None, 3),
    (None, date(2022, 1, 1), "N", "n", 1),
]


@pytest.mark.parametrize("partitions", [1, 5])
def test_concat_per_record(spark, partitions):
    df = spark.createDataFrame(ENTRIES, "id string, day date, title string, major string, n int")
    lists = concat_per_record(
        df.repartition(partitions),
        ["id"],
        order=["day", "title", "major"],
        lists={"majors": "major", "titles": "title", "sorted_majors": "major"},
        by_value=("sorted_majors",),
        best={"best_title": "title", "best_n": "n"},
        copies=F.col("n"),
    )
    rows = {r.id: r for r in lists.collect()}
    # Ordered by date, title, major with NULLs first; three copies of y in all.
    assert rows["r1"].majors == "y|y|y|x"
    assert rows["r1"].titles == "A|B"
    assert rows["r1"].sorted_majors == "x|y|y|y"
    assert rows["r1"].best_title is None
    assert rows["r1"].best_n == 1
    assert (rows["r2"].majors, rows["r2"].titles) == (None, None)
    assert rows[None].majors == "n"


def test_dense_rank_values_puts_null_first(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", None), ("a", "x"), ("a", "y"), (None, "z")], "k string, v string"
    )
    ranks = dense_rank_values(df, ["k"], "v", "r").collect()
    assert sorted((str(r.k), str(r.v), r.r) for r in ranks) == [
        ("None", "z", 1),
        ("a", "None", 1),
        ("a", "x", 2),
        ("a", "x", 2),
        ("a", "y", 3),
    ]


def test_audits(spark):
    df = spark.createDataFrame(
        [("T1", "s1", "ERROR!"), ("T1", None, "Business"), ("T2", "s2", None)],
        "term string, id string, major string",
    )
    counts = record_count_audit(df, "term", "id").collect()
    assert sorted((r.term, r.n_students, r.n_records) for r in counts) == [
        ("T1", 1, 2),
        ("T2", 1, 1),
    ]
    assert sentinel_counts(df, ["major"]).first().n_major_sentinels == 1
