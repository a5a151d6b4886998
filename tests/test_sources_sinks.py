from contextlib import contextmanager
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalogue import product_queries
from termweave.functions.dates import parse_yyyymmdd
from termweave.plans.submission import SubmissionSpec, clearinghouse_submission, write_submission
from termweave.sources import sinks
from termweave.sources.registry import MissingColumns, Sources, conform, read_csv
from termweave.sources.schemas import SCHEMAS
from termweave.sources.sinks import write_import
from tests.fixtures import SCORECARD, frame

CONTACT = {
    "contact_id": "c1", "first_name": "Ana M.", "middle_name": "Lee", "last_name": "O'Neil III",
    "birthdate": date(1996, 6, 1), "high_school_graduating_class_c": 2014,
    "indicator_completed_ct_hs_program_c": True,
}


def lines(path):
    parts = sorted(Path(path).glob("part-*"))
    return [line for part in parts for line in part.read_text().splitlines()]


def test_submission_file(spark, tmp_path):
    contacts = [
        CONTACT,
        CONTACT | {"contact_id": "c2", "last_name": "José", "birthdate": None, "first_name": "Zoë"},
        CONTACT | {"contact_id": "c3", "indicator_completed_ct_hs_program_c": False},
        CONTACT | {"contact_id": "c4", "indicator_completed_ct_hs_program_c": None},
        CONTACT | {"contact_id": 'c,"5', "middle_name": None, "first_name": "Li"},
    ]
    path = str(tmp_path / "file")
    spec = SubmissionSpec(organisation="Some School")
    write_submission(frame(spark, "contact", contacts).repartition(3), path, spec)
    header, *details = lines(path)
    assert header == "H1,693622,0,Some School,20230308,DA,S,,,,00,"
    assert set(details) == {
        'D1,,Li,,O Neil ,III,19960601,20140601,,,00,"c,""5"',
        "D1,,Ana ,M,O Neil ,III,19960601,20140601,,,00,c1",
        "D1,,Zoë,L,José,,,20140601,,,00,c2",
    }


def test_submission_needs_no_shuffle(spark):
    plan = clearinghouse_submission(frame(spark, "contact", [CONTACT]))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_sources_check_columns(spark, tmp_path):
    scorecard = frame(spark, "scorecard", SCORECARD)
    assert Sources({"scorecard": scorecard})["scorecard"].schema == SCHEMAS["scorecard"]
    with pytest.raises(MissingColumns, match="scorecard: OPEID6"):
        Sources({"scorecard": scorecard.drop("OPEID6")})
    scorecard.write.parquet(str(tmp_path / "scorecard.parquet"))
    read = Sources.from_directory(spark, str(tmp_path), ["scorecard"])["scorecard"]
    assert [tuple(r) for r in read.collect()] == [("River College", 77, "123400")]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [{"college_app_id": "P1", "contact_id": "c1 ", "college_name": 'A "B", C'}]
    write_import(frame(spark, "application_fact", rows), path, "csv")
    read = read_csv(spark, "application_fact", path).collect()
    assert [r.asDict() for r in read] == rows


VALUES = {
    "string": "a,\"b\"", "bigint": 20220822, "int": 7, "double": 1.5, "boolean": True,
    "date": date(2022, 8, 22), "timestamp": datetime(2022, 8, 22, 1, 2, 3),
}


@pytest.mark.parametrize("source", SCHEMAS)
def test_every_schema_comes_back_from_csv(spark, tmp_path, source):
    schema = SCHEMAS[source]
    rows = [{f.name: VALUES[f.dataType.simpleString()] for f in schema}, {schema[0].name: VALUES[schema[0].dataType.simpleString()]}]
    df = frame(spark, source, rows)
    write_import(df, str(tmp_path / "csv"), "csv")
    read = read_csv(spark, source, str(tmp_path / "csv"))
    assert read.schema == df.schema
    assert sorted(map(str, read.collect())) == sorted(map(str, df.collect()))


@contextmanager
def ansi(spark, on):
    spark.conf.set("spark.sql.ansi.enabled", on)
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("on", ["true", "false"])
def test_flags_and_numbers_as_text(spark, on):
    names = [f.name for f in SCHEMAS["user"]]
    with ansi(spark, on):
        rows = [("1", "n", x) for x in ("Y", "yes", "TRUE", "1", "N", "No", "f", "0", " ", "", None)]
        got = [r.is_active for r in conform(spark.createDataFrame(rows, names), "user").collect()]
        assert got == [True] * 4 + [False] * 4 + [None] * 3
        with pytest.raises(Exception, match="not a boolean: maybe"):
            conform(spark.createDataFrame([("1", "n", "maybe")], names), "user").collect()
        codes = spark.createDataFrame([("a", "12x", "b")], "INSTNM string, UNITID string, OPEID6 string")
        with pytest.raises(Exception, match="not a bigint: 12x"):
            conform(codes, "scorecard").collect()


@pytest.mark.parametrize("on", ["true", "false"])
@pytest.mark.parametrize("bad", ["20221316", "202206", "20220230", "0", "-20220101", "2022-08-22", "x"])
def test_malformed_dates_raise(spark, on, bad):
    with ansi(spark, on):
        df = spark.createDataFrame([("20220822", None), (bad, None)], "d string, n string")
        good = df.select(parse_yyyymmdd(F.col("d")).alias("d"), parse_yyyymmdd(F.col("n")).alias("n"))
        assert [tuple(r) for r in good.limit(1).collect()] == [(date(2022, 8, 22), None)]
        with pytest.raises(Exception):
            good.collect()


def test_csv_with_other_columns_fails(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("UNITID,INSTNM,OPEID6\n1,a,2\n")
    with pytest.raises(Exception):
        read_csv(spark, "scorecard", str(path)).collect()


def test_a_compressed_export_is_read_back_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "PART_ROWS", 2)
    rows = frame(spark, "scorecard", [*SCORECARD, *SCORECARD, *SCORECARD]).coalesce(1)
    write_import(rows, str(tmp_path / "csv"), "csv", compression="lz4")
    parts = list((tmp_path / "csv").glob("part-*"))
    assert len(parts) == -(-rows.count() // 2) and all(p.name.endswith(".csv.lz4") for p in parts)
    back = read_csv(spark, "scorecard", str(tmp_path / "csv"))
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_the_feed_of_the_csv_query_is_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(product_queries, "scratch_folder", lambda _, name: str(tmp_path / name))
    product_queries.degree_4yr_update_from_csv(spark, "/root/testdata/sf0.001")
    parts = list((tmp_path / "feed").glob("part-*"))
    assert parts and all(p.name.endswith(".csv.lz4") for p in parts)
