"""Tables laid out by student."""

import re
import time
import uuid

import pytest
from pyspark.sql import functions as F

from catalogue import product_queries
from catalogue.standins import source
from termweave.plans.degrees import FOUR_YEAR_UPDATE, degree_records
from termweave.plans.enrolment import enrolment_discrepancies
from termweave.session import tune, within
from termweave.sources.columns import STUDENT_KEY, STUDENT_PART
from termweave.sources import layout
from termweave.sources.layout import counts_by_student, most_rows_of_a_student, read_by_student, stage_by_student, student_key, write_by_student
from termweave.sources.registry import Sources, conform

SF = "/root/testdata/sf0.001"


def laid_out(spark, df, name, folder, **how):
    table = f"t_{uuid.uuid4().hex}"
    done = write_by_student(df, name, table, 4, str(folder / table), **how)
    return done, table


@pytest.fixture(scope="module")
def tables(compiled, tmp_path_factory):
    """A session for laid-out tables, which can broadcast dimensions but not feed or records."""
    own = tune(compiled.newSession(), by_student=True)
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        own.conf.set(name, "20KB")
    folder = tmp_path_factory.mktemp("tables")
    names = ("nsc_feed", "student_term")
    return own, {n: read_by_student(own, n, laid_out(own, source(own, SF, n), n, folder)[1]) for n in names}


def others(spark, *names):
    return [source(spark, SF, n) for n in ("school_account", "scorecard", "term", *names)]


def by_student_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    return re.findall(r"Exchange hashpartitioning\((?:contact_id|state_contact|_student_key)[^)]*", plan)


def test_degrees_meet_records_without_a_shuffle(tables):
    spark, by = tables
    df = degree_records(by["nsc_feed"], by["student_term"], *others(spark), FOUR_YEAR_UPDATE)
    assert by_student_exchanges(df) == []
    plain = degree_records(source(spark, SF, "nsc_feed"), source(spark, SF, "student_term"), *others(spark), FOUR_YEAR_UPDATE)
    assert len(by_student_exchanges(plain)) == 2
    assert sorted(map(str, df.collect())) == sorted(map(str, plain.collect()))


def test_records_are_not_shuffled_to_meet_enrolments(tables):
    spark, by = tables
    df = enrolment_discrepancies(by["nsc_feed"], by["student_term"], *others(spark, "user"), True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # a student's states are made distinct and meet the feed where they lie
    assert not re.search(r"Exchange hashpartitioning\(state_contact", plan)


def test_the_table_is_whole_and_in_buckets(spark, tmp_path):
    feed = source(spark, SF, "nsc_feed")
    bucketed, table = laid_out(spark, feed, "nsc_feed", tmp_path)
    back = Sources.from_tables(spark, {"nsc_feed": table})["nsc_feed"]
    assert bucketed and back.columns == [*conform(feed, "nsc_feed").columns, STUDENT_KEY]
    assert back.where(~F.col(STUDENT_KEY).eqNullSafe(student_key(feed, "nsc_feed"))).isEmpty()
    plain = conform(feed, "nsc_feed")
    assert back.drop(STUDENT_KEY).exceptAll(plain).isEmpty() and plain.exceptAll(back.drop(STUDENT_KEY)).isEmpty()
    files = [p.name for p in (tmp_path / table).glob("*.parquet")]
    assert len(files) == 4


def test_a_hot_student_is_left_to_the_join(spark, tmp_path):
    feed = source(spark, SF, "nsc_feed")
    hot = feed.withColumn("Requester_Return_Field", F.when(F.crc32("Requester_Return_Field") % 3 == 0, "HOT_").otherwise(F.col("Requester_Return_Field")))
    most = most_rows_of_a_student(hot, "nsc_feed")
    assert most * 4 >= feed.count()
    bucketed, table = laid_out(spark, hot, "nsc_feed", tmp_path, most=most - 1)
    back = read_by_student(spark, "nsc_feed", table)
    assert not bucketed and STUDENT_KEY not in back.columns and back.count() == feed.count()
    assert laid_out(spark, hot, "nsc_feed", tmp_path, most=most)[0]


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "BUCKET_ROWS", 500)
    monkeypatch.setattr(product_queries, "scratch_folder", lambda _, name: str(tmp_path / f"{name}-{uuid.uuid4().hex}"))
    rows = source(spark, SF, "nsc_feed").count()
    assert -(-rows // 500) > 8
    feed, records = product_queries._by_student(spark, SF, "nsc_feed", "student_term")
    for df in (feed, records):  # the same number for both, so that they meet where they lie
        parts = [f.rpartition("_")[2].partition(".")[0] for f in df.inputFiles()]
        assert 8 < len(parts) <= -(-rows // 500) and max(map(int, parts)) < -(-rows // 500)
    assert feed.count() == rows
    assert layout.buckets_for(0) == layout.buckets_for(4000) == 8 and layout.buckets_for(216_000_000 // 1000) == 432
    assert counts_by_student(feed.limit(0), "nsc_feed") == (0, 0)


def test_no_rows_and_no_students(spark, tmp_path):
    feed = source(spark, SF, "nsc_feed")
    for rows in (feed.limit(0), feed.limit(5).withColumn("Requester_Return_Field", F.lit(None).cast("string"))):
        done, table = laid_out(spark, rows, "nsc_feed", tmp_path)
        assert done and read_by_student(spark, "nsc_feed", table).count() == rows.count()


def rows_of(students, each=3):
    """Feed rows of numbered students, of student 0 twice, and one without a student."""
    numbers = [0, *range(students), None]
    return [(None if n is None else f"C_{n}", f"College {n}", k) for n in numbers for k in range(each)]


def feed_of(spark, rows):
    given = {"Requester_Return_Field": 0, "College_Name": 1, "College_Sequence": 2}
    made = spark.createDataFrame(rows, "a string, b string, c int")
    fields = layout.conform(source(spark, SF, "nsc_feed").limit(0), "nsc_feed").schema
    return made.select([(F.col("abc"[given[f.name]]) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


@pytest.mark.parametrize("buckets", [4, layout.PARTS, 2 * layout.PARTS, layout.PARTS + 3])
def test_staged_rows_are_laid_out_whole(spark, tmp_path, buckets):
    feed = feed_of(spark, rows_of(400))
    staged = stage_by_student(feed, "nsc_feed", str(tmp_path / "staged"))
    table = f"t_{uuid.uuid4().hex}"
    assert counts_by_student(staged, "nsc_feed") == (402 * 3, 6)
    assert write_by_student(staged, "nsc_feed", table, buckets, str(tmp_path / table))
    back = read_by_student(spark, "nsc_feed", table)
    assert back.columns == [*feed.columns, STUDENT_KEY] and STUDENT_PART not in back.columns
    assert back.drop(STUDENT_KEY).exceptAll(feed).isEmpty() and feed.exceptAll(back.drop(STUDENT_KEY)).isEmpty()
    assert back.where(~F.col(STUDENT_KEY).eqNullSafe(student_key(feed, "nsc_feed"))).isEmpty()
    # a row is in a file of the bucket that Spark looks for it in, and a bucket of few rows is one file
    own = F.pmod(F.hash(STUDENT_KEY), F.lit(buckets))
    files = back.select(F.regexp_extract(F.input_file_name(), r"_(\d+)\.", 1).cast("int").alias("file"), own.alias("own"))
    assert files.where("file <> own").isEmpty() and files.select("own").distinct().count() == buckets
    assert len(back.inputFiles()) == buckets


@pytest.mark.parametrize("task_rows, tasks", [(20, 61), (1000, 24)])
def test_tasks_of_a_staged_table_have_few_buckets_and_no_shuffle(compiled, tmp_path, monkeypatch, task_rows, tasks):
    own = compiled.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", "1")  # so that small files are many tasks
    feed = feed_of(own, rows_of(400)).repartition(6)
    staged = stage_by_student(feed, "nsc_feed", str(tmp_path / "staged"))
    buckets = 2 * layout.PARTS
    monkeypatch.setattr(layout, "TASK_ROWS", task_rows)
    with within(own, layout.COPYING):
        rows = layout._by_buckets(staged, buckets)
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
        bucket = F.pmod(F.hash(STUDENT_KEY), F.lit(buckets))
        each = rows.groupBy(F.spark_partition_id()).agg(F.countDistinct(bucket).alias("n")).collect()
    assert layout.PARTS <= len(each) <= tasks and max(r.n for r in each) <= 2


def test_staged_tables_meet_where_they_lie(tables, tmp_path):
    spark, _ = tables
    plain = {n: source(spark, SF, n) for n in ("nsc_feed", "student_term")}
    laid = {}
    for name, df in plain.items():
        staged = stage_by_student(df, name, str(tmp_path / f"{name}-staged"))
        table = f"t_{uuid.uuid4().hex}"
        assert write_by_student(staged, name, table, 2 * layout.PARTS, str(tmp_path / table))
        laid[name] = read_by_student(spark, name, table)
    df = degree_records(laid["nsc_feed"], laid["student_term"], *others(spark), FOUR_YEAR_UPDATE)
    assert by_student_exchanges(df) == []
    expected = degree_records(plain["nsc_feed"], plain["student_term"], *others(spark), FOUR_YEAR_UPDATE)
    assert sorted(map(str, df.collect())) == sorted(map(str, expected.collect()))


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}


def test_the_layout_leaves_nothing_but_its_tables(compiled, tmp_path, monkeypatch):
    monkeypatch.setattr(product_queries, "scratch_folder", lambda _, name: str(tmp_path / f"{name}-{uuid.uuid4().hex}"))
    own = tune(compiled.newSession(), by_student=True)
    before = shuffle_files(own)
    laid = product_queries._by_student(own, SF, "nsc_feed", "student_term")
    until = time.time() + 20
    while shuffle_files(own) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(own) - before
    assert {p.name.partition("-")[0] for p in tmp_path.iterdir()} == {"nsc_feed", "student_term"} and len(list(tmp_path.iterdir())) == 2
    assert [df.count() for df in laid] == [source(own, SF, n).count() for n in ("nsc_feed", "student_term")]


def test_a_staged_hot_student_is_left_to_the_join(spark, tmp_path):
    feed = feed_of(spark, rows_of(50))
    staged = stage_by_student(feed, "nsc_feed", str(tmp_path / "staged"))
    for most, bucketed in ((5, False), (6, True)):
        table = f"t_{uuid.uuid4().hex}"
        assert write_by_student(staged, "nsc_feed", table, 4, str(tmp_path / table), most=most) == bucketed
        back = read_by_student(spark, "nsc_feed", table)
        assert (STUDENT_KEY in back.columns) == bucketed and back.drop(STUDENT_KEY).exceptAll(feed).isEmpty()
        assert back.count() == feed.count()


def test_no_staged_rows(spark, tmp_path):
    staged = stage_by_student(feed_of(spark, []), "nsc_feed", str(tmp_path / "staged"))
    assert counts_by_student(staged, "nsc_feed") == (0, 0)
    for buckets in (4, 2 * layout.PARTS):
        table = f"t_{uuid.uuid4().hex}"
        assert write_by_student(staged, "nsc_feed", table, buckets, str(tmp_path / table))
        assert read_by_student(spark, "nsc_feed", table).count() == 0


def test_settings_hold_within_only(compiled):
    own = compiled.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", "7")
    given = {"spark.sql.files.openCostInBytes": "8", "spark.sql.files.maxPartitionNum": "3"}
    with pytest.raises(ValueError), within(own, given):
        assert {name: own.conf.get(name) for name in given} == given
        raise ValueError
    assert own.conf.get("spark.sql.files.openCostInBytes") == "7"
    assert own.conf.get("spark.sql.files.maxPartitionNum", None) is None


def test_many_buckets_are_a_multiple_of_the_parts():
    rows = layout.BUCKET_ROWS
    assert [layout.buckets_for(n * rows) for n in (1, 9, 24, 25, 48, 49)] == [8, 9, 24, 48, 48, 72] and layout.PARTS == 24
