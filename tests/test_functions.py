from datetime import date

import pytest
from pyspark.sql import functions as F

from termweave.functions.carry import filled_when, null_when
from termweave.functions.codes import (
    calendar_of_name,
    decode_class,
    decode_status,
    degree_kind,
    normalise_calendar,
    school_type_rank,
)
from termweave.functions.dates import compact_date, parse_yyyymmdd, search_date, span_label
from termweave.functions.degrees import associate_filter, bachelor_filter, classify, major_rules
from termweave.functions.keys import branch_code, clean_return_key, first_token, first_word, match_key
from termweave.functions.names import (
    middle_initial,
    name_suffix,
    plain_name,
    without_initials,
    without_suffix,
)


def apply(spark, function, values, kind="string"):
    """The function's result per value."""
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, f"n int, v {kind}").select("n", function(F.col("v")).alias("r"))
    return [row.r for row in df.orderBy("n").collect()]


@pytest.mark.parametrize(
    "function, cases",
    [
        (clean_return_key, {"_AB_12_": "AB12", "ab": "ab", None: None}),
        (match_key, {"aB1": "AB1", None: None}),
        (first_word, {"Semester system": "Semester", "Quarter": "Quarter", "": "", None: None}),
        (branch_code, {"00123400-01": "123400", "00000000-00": "", "0120": "120", None: None}),
        (first_token, {"a|b": "a", "a": "a", None: None}),
        (normalise_calendar, {"Trimester": "Semester", "Quarter": "Quarter", None: None}),
        (degree_kind, {"CERTIFICATE": "Certificate", "AA ": "2-year degree", None: "2-year degree"}),
        (
            decode_status,
            {
                "F": "Full-time",
                "Q": "Part-time",
                "H": "Part-time",
                "L": "Part-time",
                "W": "Error or Not Enrolled",
                " ": "Error or Not Enrolled",
                None: "Error or Not Enrolled",
            },
        ),
        (
            decode_class,
            {
                **dict.fromkeys("FSJRCNB", "Undergraduate"),
                **dict.fromkeys("MDPL", "Graduate"),
                "A": "Associate's",
                "G": "Graduate or Professional",
                "T": "Graduate or Post-Bacc",
                "X": "Error",
                None: "Error",
            },
        ),
        (
            calendar_of_name,
            {
                "Fall (Semester) Ann": "Semester",
                "Fall (Quarter) Ann": "Quarter",
                "Fall Quarter": "Check",
                None: "Check",
            },
        ),
        (
            school_type_rank,
            {
                "Predominantly bachelor's-degree granting": 1,
                "Predominantly associate's-degree granting": 2,
                "Other": 3,
                None: 3,
            },
        ),
    ],
)
def test_text_functions(spark, function, cases):
    assert apply(spark, function, list(cases)) == list(cases.values())


def test_bachelor_titles_keep_missing_ones(spark):
    titles = {"BACHELOR OF ARTS": True, "MBA": True, "CABLE": True, "NURSING": False, None: True}
    assert apply(spark, bachelor_filter, list(titles)) == list(titles.values())


def test_associate_titles_drop_missing_ones(spark):
    titles = {
        "ASSOCIATE OF ARTS": True,
        "AA ": True,
        "AA": False,
        "CERTIFICATE": True,
        "UNDERGRADUATE CERTIFICATE": False,
        "POST-BACCALAUREATE CERTIFICATE": False,
        None: None,
    }
    assert apply(spark, associate_filter, list(titles)) == list(titles.values())


def test_major_rules_first_match_wins(spark):
    majors = {
        "NURSING": "Health Sciences",
        "PRE-NURSING": "Biological, Environmental, or Agricultural Sciences",
        "BIOTECHNOLOGY": "Computer Science or Information Technology",
        "MULTIMEDIA": "ERROR!",
        "MULTIMEDIA DESIGN & DEVELOPMENT": "Arts: Design, Performing, or Visual",
        "COMMUNICATION": "ERROR!",
        "COMMUNICATION STUDIES": "Communications or Marketing",
        "": "ERROR!",
        None: None,
    }
    rules = major_rules(any_multimedia=False)
    assert apply(spark, lambda c: classify(c, rules), list(majors)) == list(majors.values())


def test_major_rule_variants_differ_in_multimedia_only(spark):
    narrow, wide = major_rules(any_multimedia=False), major_rules(any_multimedia=True)
    assert [len(r) for r in (narrow, wide)] == [50, 50]
    assert sum(r.kind == "exact" for r in narrow) == 11
    assert sum(r.kind == "exact" for r in wide) == 10
    assert {r.pattern for r in set(narrow) ^ set(wide)} == {
        "MULTIMEDIA",
        "MULTIMEDIA DESIGN & DEVELOPMENT",
    }
    assert apply(spark, lambda c: classify(c, wide), ["MULTIMEDIA"]) == [
        "Arts: Design, Performing, or Visual"
    ]


def test_parse_dates(spark):
    parsed = apply(spark, parse_yyyymmdd, [20220822, 20240229, None], "bigint")
    assert parsed == [date(2022, 8, 22), date(2024, 2, 29), None]


@pytest.mark.parametrize("malformed", [20220230, 2022123, 0, 20221301, 120220101])
def test_malformed_dates_raise(spark, malformed):
    with pytest.raises(Exception, match="DATETIME|Invalid|invalid"):
        apply(spark, parse_yyyymmdd, [malformed], "bigint")


def test_dates_as_text(spark):
    days = [date(2004, 6, 1), None]
    assert apply(spark, compact_date, days, "date") == ["20040601", None]
    assert apply(spark, lambda c: span_label(c, c), days, "date") == [
        "2004-06-01 to 2004-06-01",
        None,
    ]
    assert apply(spark, search_date, [2014, None], "int") == [20140601, None]


@pytest.mark.parametrize(
    "last, suffix, rest",
    [
        ("Smith III", "III", "Smith "),
        ("Lee Jr.", "Jr", "Lee "),
        ("Lee Jr", "Jr", "Lee "),
        ("LeeIV", "IV", "Lee"),
        ("Jrx", "Jrx", ""),
        ("Val VIII", "VIII", "Val "),
        ("O'Neil", None, "O'Neil"),
        (None, None, None),
    ],
)
def test_suffix(spark, last, suffix, rest):
    assert apply(spark, name_suffix, [last]) == [suffix]
    assert apply(spark, without_suffix, [last]) == [rest]


@pytest.mark.parametrize(
    "first, middle, initial, rest",
    [
        ("Ana M.", "Lee", "M", "Ana "),
        ("Ana", "d4vid!", "D", "Ana"),
        ("Ana", "7", None, "Ana"),
        ("Ana", "", None, "Ana"),
        ("Ana", None, None, "Ana"),
        ("Zoë é.", None, "É", "Zoë "),
        ("J.R.", None, "J", ""),
        (None, "Lee", "L", None),
    ],
)
def test_initials(spark, first, middle, initial, rest):
    df = spark.createDataFrame([(first, middle)], "first string, middle string")
    row = df.select(
        middle_initial(F.col("first"), F.col("middle")).alias("initial"),
        without_initials(F.col("first")).alias("rest"),
    ).first()
    assert (row.initial, row.rest) == (initial, rest)


def test_plain_names_keep_accents_and_hyphens(spark):
    names = {"O'Neil": "O Neil", "José": "José", "Smith-Jones": "Smith-Jones", "A.B, C!": "AB C"}
    assert apply(spark, plain_name, list(names)) == list(names.values())


def test_carry_over_keeps_values_where_the_condition_is_null(spark):
    df = spark.createDataFrame(
        [("Active", "x"), ("Inactive", "x"), (None, "x"), ("Active", None)], "s string, v string"
    )
    kept = df.select(
        null_when(F.col("v"), F.col("s") != "Active").alias("v"),
        filled_when(F.col("v"), F.col("s") == "Active", F.lit("y")).alias("f"),
    ).collect()
    assert [r.v for r in kept] == ["x", None, "x", None]
    assert [r.f for r in kept] == ["x", "x", "x", "y"]
