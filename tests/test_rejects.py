"""Tolerant reading, read-back of written files, and counts that are taken while writing."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from termweave.functions.dates import try_yyyymmdd
from termweave.operators.audit import record_count_audit, sentinel_count_columns, sentinel_counts, term_count_rows, term_counts
from termweave.operators.rollup import rows_with_lists
from termweave.plans.degrees import FOUR_YEAR_UPDATE, degree_records
from termweave.plans.submission import SubmissionSpec, record_line, submission_records, write_submission
from termweave.sources.registry import MissingColumns, read_csv_text
from termweave.sources.rejects import split_rows
from termweave.sources.schemas import SCHEMAS
from termweave.sources.sinks import line_differences, read_positional, write_import
from tests.fixtures import SCHOOLS, SCORECARD, TERMS, degree, frame, record
from tests.test_sources_sinks import CONTACT, ansi

KEYS = ("Requester_Return_Field",)


def text_feed(spark, rows):
    """A feed of text cells, as a spreadsheet has it."""
    names = [f.name for f in SCHEMAS["nsc_feed"]]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names))


CELLS = [
    ("a", "20220822", None), ("b", " ", None), ("c", None, None), ("d", "20221316", "not a date"), ("e", "20220230", "not a date"),
    ("f", "202208", "not a date"), ("g", "0", "not a date"), ("h", "-20220822", "not a date"), ("i", "2022-08-22", "not a bigint"),
    ("j", "x", "not a bigint"), ("k", "120220822", "not a date"), ("m", "202208220", "not a date"), ("l", " 20220822 ", None),
]


@pytest.mark.parametrize("on", ["true", "false"])
def test_malformed_cells_are_set_aside(spark, on):
    with ansi(spark, on):
        feed = text_feed(spark, [{"Requester_Return_Field": k, "Graduation_Date": d, "Graduated_": "Y"} for k, d, _ in CELLS])
        split = split_rows(feed, "nsc_feed", KEYS)
        assert split.good.schema.simpleString() == SCHEMAS["nsc_feed"].simpleString()
        got = {r.Requester_Return_Field: r.Graduation_Date for r in split.good.collect()}
        assert got == {"a": 20220822, "b": None, "c": None, "l": 20220822}
        rejected = [tuple(r) for r in split.rejected.collect()]
        assert sorted(rejected) == [(k, "Graduation_Date", d, p) for k, d, p in CELLS if p]


def test_a_row_has_a_reject_for_each_bad_cell(spark):
    rows = [{"Requester_Return_Field": "a", "Graduated_": "perhaps", "Search_Date": "x", "Enrollment_End": "20229999"}, {}]
    split = split_rows(text_feed(spark, rows), "nsc_feed", KEYS)
    assert sorted((r.column, r.problem) for r in split.rejected.collect()) == [
        ("Enrollment_End", "not a date"), ("Graduated_", "not a boolean"), ("Search_Date", "not a bigint"),
    ]
    assert split.good.count() == 1
    only = split_rows(text_feed(spark, [rows[0] | {"Graduated_": "N", "Search_Date": "7"}]), "nsc_feed", KEYS, ("Graduation_Date",))
    assert only.rejected.count() == 0 and only.good.first().Enrollment_End == 20229999
    with pytest.raises(Exception, match="not a (boolean: perhaps|bigint: x)"):
        split_rows(text_feed(spark, rows), "nsc_feed", KEYS, ("Graduation_Date",)).good.collect()


def test_typed_sources_are_split_too(spark):
    split = split_rows(frame(spark, "nsc_feed", [degree("S1", 20221116, "BA", "X"), degree("S2", 20221399, "BA", "X")]), "nsc_feed", KEYS)
    assert [r.Requester_Return_Field for r in split.good.collect()] == ["S1"]
    assert [tuple(r) for r in split.rejected.collect()] == [("S2", "Graduation_Date", "20221399", "not a date")]
    empty = split_rows(frame(spark, "nsc_feed", []), "nsc_feed", KEYS)
    assert empty.good.collect() == empty.rejected.collect() == []
    with pytest.raises(MissingColumns):
        split_rows(frame(spark, "nsc_feed", []).drop("Search_Date"), "nsc_feed")


def test_a_product_over_what_is_good(compiled):
    rows = [degree("_S1_", 20221116, "BACHELOR OF ARTS", "SPANISH"), degree("_S2_", 20221399, "BACHELOR OF ARTS", "SPANISH")]
    feed = split_rows(frame(compiled, "nsc_feed", rows), "nsc_feed", KEYS).good
    others = [frame(compiled, n, r) for n, r in (
        ("student_term", [record("s1", "FS"), record("s2", "FS")]), ("school_account", SCHOOLS), ("scorecard", SCORECARD), ("term", TERMS),
    )]
    found = degree_records(feed, *others, FOUR_YEAR_UPDATE).collect()
    assert {r.Contact_Id for r in found} == {"s1"}
    with pytest.raises(Exception):
        degree_records(frame(compiled, "nsc_feed", rows), *others, FOUR_YEAR_UPDATE).collect()


def test_text_cells_of_a_spreadsheet(spark, tmp_path):
    write_import(text_feed(spark, [{"Requester_Return_Field": "a", "Graduation_Date": "soon"}]), str(tmp_path / "csv"), "csv")
    split = split_rows(read_csv_text(spark, "nsc_feed", str(tmp_path / "csv")), "nsc_feed", KEYS)
    assert [tuple(r) for r in split.rejected.collect()] == [("a", "Graduation_Date", "soon", "not a bigint")]


def test_dates_that_may_be_none(spark):
    df = spark.createDataFrame([(20220822,), (20220230,), (7,), (None,)], "n long")
    assert [r[0] for r in df.select(try_yyyymmdd(F.col("n"))).collect()] == [date(2022, 8, 22), None, None, None]


def test_lines_are_numbered_over_all_parts(compiled, tmp_path):
    path = str(tmp_path / "file")
    contacts = frame(compiled, "contact", [CONTACT | {"contact_id": f"c{k}"} for k in range(50)]).repartition(7)
    spec = SubmissionSpec(organisation="Some School")
    write_submission(contacts, path, spec)
    parts = [p.read_text().splitlines() for p in sorted(Path(path).glob("part-*"))]
    read = {r.number: r.line for r in read_positional(compiled, path).collect()}
    assert [read[k] for k in sorted(read)] == [line for p in parts for line in p]
    assert sorted(read) == list(range(1, 52)) and read[1].startswith("H1,")
    expected = submission_records(contacts, spec).select(record_line().alias("line"))
    assert line_differences(expected, path).collect() == []
    more = expected.union(expected.limit(1))
    assert [(r.n_expected, r.n_written) for r in line_differences(more, path).collect()] == [(2, 1)]
    assert line_differences(expected.where("line not like 'H1%'"), path).first().n_written == 1


def test_a_part_of_several_splits_is_numbered_in_order(compiled, tmp_path):
    (tmp_path / "part-0").write_text("".join(f"line {k}\n" for k in range(2000)))
    (tmp_path / "part-1").write_text("last\n")
    name = "spark.sql.files.maxPartitionBytes"
    compiled.conf.set(name, "1000")
    try:
        read = {r.number: r.line for r in read_positional(compiled, str(tmp_path)).collect()}
    finally:
        compiled.conf.unset(name)
    assert [read[k] for k in sorted(read)] == [*(f"line {k}" for k in range(2000)), "last"]


def test_counts_while_writing(compiled, tmp_path):
    rows = [("T1", "s1", "ERROR!"), ("T1", None, "x"), ("T2", "s2", None), (None, "s3", "ERROR!"), ("T9", "s4", "x")]
    df = compiled.createDataFrame(rows, "term string, id string, major string").repartition(3)
    counts = term_counts("term", "id", ["T1", "T2", "T3"]) | sentinel_count_columns(["major"])
    seen = write_import(df, str(tmp_path / "rows"), counts=counts)
    assert compiled.read.parquet(str(tmp_path / "rows")).count() == 5
    got = {tuple(r) for r in term_count_rows(compiled, seen, "term", ["T1", "T2", "T3"]).collect()}
    assert got == {("T1", 1, 2), ("T2", 1, 1), (None, 2, 2)}
    named = {tuple(r) for r in record_count_audit(df, "term", "id").collect() if r.term in ("T1", "T2")}
    assert named == {r for r in got if r[0]}
    assert seen["n_major_sentinels"] == sentinel_counts(df, ["major"]).first().n_major_sentinels == 2
    assert write_import(df.limit(0), str(tmp_path / "none"), counts=counts)["n_records_other"] == 0
    assert write_import(df, str(tmp_path / "plain")) == {}


ENTRIES = [
    ("r1", 2, "B", "x", "A1", 1), ("r1", 1, None, "y", "A1", 1), ("r1", 1, None, "y", "A2", 2), ("r1", None, "A", None, "A1", 1),
    ("r1", 3, "C", "z", "A1", None), ("r2", None, None, None, "A1", 3), (None, 1, "N", "n", None, 1),
]


@pytest.mark.parametrize("partitions", [1, 5])
def test_rows_with_lists(spark, partitions):
    df = spark.createDataFrame(ENTRIES, "id string, day int, title string, major string, account string, n int")
    arguments = {"order": ["day", "title", "major"], "lists": {"majors": "major", "titles": "title"}, "by_value": ("titles",), "copies": "n"}
    rows = rows_with_lists(df.repartition(partitions), ["id"], **arguments)
    assert rows.columns == ["id", "majors", "titles", "day", "title", "major", "account"]
    got = sorted(map(tuple, rows.collect()), key=str)
    assert len(got) == 6  # the row that nothing weighs is left out
    assert {r[:3] for r in got} == {("r1", "y|y|y|x", "A|B"), ("r2", None, None), (None, "n", "N")}
    assert ("r1", "y|y|y|x", "A|B", 1, None, "y", "A2") in got
    best = rows_with_lists(df.repartition(partitions), ["id"], **arguments, best={"first_title": "title"})
    assert {(r.id, r.account, r.majors) for r in best.collect()} == {
        ("r1", "A1", "y|y|y|x"), ("r1", "A2", "y|y|y|x"), ("r2", "A1", None), (None, None, "n"),
    }


def test_only_columns_to_keep_are_read_and_cells_worked_out_once(compiled):
    query = entry.queries()["degree_4yr_update_tolerant"]
    plan = query(compiled, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "CollectMetrics" in plan
    for unread in ("First_Name", "Search_Date", "Enrollment_Major", "Public___Private", "Class_Level"):
        assert unread not in plan
    # a condition that names the malformed date inlined would hold its text several times
    assert max(line.count("unknown") for line in plan.splitlines() if "Filter" in line) <= 1


def test_columns_to_keep(spark):
    rows = [{"Requester_Return_Field": "a", "Graduation_Date": "20220822"}, {"Requester_Return_Field": "b", "Graduation_Date": "x"}]
    split = split_rows(text_feed(spark, rows), "nsc_feed", KEYS, ("Graduation_Date",), keep=("Graduation_Date", "Requester_Return_Field"))
    assert [r.asDict() for r in split.good.collect()] == [{"Requester_Return_Field": "a", "Graduation_Date": 20220822}]
    assert [r.found for r in split.rejected.collect()] == ["x"]
