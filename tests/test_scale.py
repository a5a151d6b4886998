"""Plans without broadcasts and with a hot key."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalogue.standins import source
from termweave.operators.match import missing_records
from termweave.operators.sizes import small
from termweave.operators.terms import with_best_term_by_span
from termweave.session import SETTINGS
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
# What a cluster does with large data, at the size of a test.
SPLIT_HOT_KEYS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def settings(spark, values):
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in values:
            spark.conf.unset(name)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["degree_4yr_create", "enrolment_discrepancy", "next_term_fall", "region_visit_fanout",
     "best_term_per_span", "changed_rows_new_only", "next_term_enrolment", "feed_term_short"],
)
def test_dimensions_too_large_to_broadcast(compiled, name):
    with settings(compiled, {"spark.sql.autoBroadcastJoinThreshold": "-1",
                             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        df = entry.queries()[name](compiled, SF)
        assert "Broadcast" not in final_plan(df)
        assert compare(df, duck(SF), entry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", ["degree_4yr_update", "degree_2yr_update", "degree_4yr_create", "degree_2yr_create"])
def test_degrees_take_one_scan_of_feed_and_records(compiled, name):
    with settings(compiled, SPLIT_HOT_KEYS):
        df = entry.queries()[name](compiled, SF)
        df.collect()
        final = final_plan(df).partition("== Initial Plan ==")[0]
    # feed and records stand in with the same table, read once for each
    assert final.count("lineitem.parquet") == 2


def test_lists_are_not_joined_with_their_rows(compiled):
    plan = entry.queries()["degree_4yr_update"](compiled, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1 and not re.search(r"Join Inner, \(AT_Id#\d+ <=>", plan)


def test_short_term_names_take_one_scan_of_the_feed(compiled):
    plan = final_plan(entry.queries()["feed_term_short"](compiled, SF))
    # the feed and the student records stand in for each other's source once each
    assert plan.count("lineitem.parquet") == 2
    assert not re.search(r"Join \[[^]]*nsc_date_concat", plan)


def test_rows_are_distinct_before_they_meet_states(compiled):
    df = entry.queries()["enrolment_discrepancy"](compiled, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    join = re.search(r"\n[^\n]*Join Inner, \(contact_id_nsc#\d+ = state_contact#\d+\)", plan)
    assert "Aggregate" not in plan[: join.start()] and "Aggregate" in plan[join.end() :]


def test_records_without_a_calendar_are_left_out_before_the_join(compiled):
    plan = entry.queries()["next_term_fall"](compiled, SF)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("school_calendar") :]
    assert re.search(r"NOT CASE WHEN Contains.*\(Quarter\)", below)


def test_a_table_is_small_up_to_its_bound(compiled):
    ten = compiled.range(10)
    big = compiled.range(10_000_000)
    assert "BroadcastHashJoin" in final_plan(big.join(small(ten.groupBy("id").count(), 10), "id"))
    with settings(compiled, {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "1b"}):
        assert "BroadcastHashJoin" not in final_plan(big.join(small(ten.groupBy("id").count(), 9), "id"))


def test_events_are_not_gathered_by_year(compiled):
    """With a calendar too large to broadcast, and a year that holds a third of all rows."""
    terms = source(compiled, SF, "term")
    events = compiled.range(0, 60000, numPartitions=12).select(
        F.expr("CASE WHEN id % 3 = 0 THEN date'1998-01-20' ELSE date_add(date'1996-01-05', CAST(id % 1500 AS INT)) END").alias("b"),
        F.sha2(F.col("id").cast("string"), 256).alias("wide"),
    ).withColumn("e", F.date_add("b", 40))
    expected = with_best_term_by_span(events, terms, "b", "e").groupBy("b", "e", "GAS_id").count().collect()
    with settings(compiled, SPLIT_HOT_KEYS):
        best = with_best_term_by_span(events, terms, "b", "e")
        rows = best.groupBy("b", "e", "GAS_id").agg(F.count("wide").alias("count"))
        assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, expected)) and expected
        plan = final_plan(best)
        # only distinct spans and the calendar are shuffled by year
        by_year = plan[: plan.index("GAS_Year")]
        assert "wide" in plan and not re.search(r"Exchange hashpartitioning\(year\(b#", plan) and "Exchange" in by_year
        final = final_plan(rows).partition("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final


def test_a_hot_student_is_split(compiled):
    with settings(compiled, SPLIT_HOT_KEYS):
        feed = compiled.range(0, 60000, numPartitions=12).select(
            F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), "id")).alias(
                "contact_id_nsc"
            ),
            F.concat(F.lit("T"), F.col("id") % 2).alias("GAS_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("degree"),
        )
        records = feed.where("contact_id_nsc <> 'HOT'").select(
            F.col("contact_id_nsc").alias("contact_id_mod"), F.concat(F.lit("T"), F.length("degree") % 2).alias("PAT_GAS_id")
        )
        students = feed.select(
            F.col("contact_id_nsc").alias("contact_id_mod"), F.length("contact_id_nsc").alias("width")
        ).distinct()
        missing = missing_records(students, feed, records)
        rows = missing.groupBy("contact_id_nsc").agg(F.count("degree").alias("n"), F.max("degree"))
        counts = {r.contact_id_nsc: r.n for r in rows.collect()}
        assert counts["HOT"] == 20000
        # Every other of the remaining students has a record of the same term.
        assert sum(counts.values()) == 40000
        assert final_plan(rows).count("SortMergeJoin(skew=true)") >= 2


def test_a_shuffle_has_as_many_partitions_as_its_size_needs(compiled):
    small_ones = {"spark.sql.shuffle.partitions": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    own = compiled.newSession()
    for name, value in (SETTINGS | small_ones).items():
        own.conf.set(name, value)
    counts = own.range(100_000).groupBy(F.col("id").cast("string")).count()
    assert counts.rdd.getNumPartitions() > 8
    assert int(SETTINGS["spark.sql.adaptive.advisoryPartitionSizeInBytes"].removesuffix("MB")) <= 16
