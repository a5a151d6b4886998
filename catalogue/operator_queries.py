"""Single operators over the driver tables."""

import re

from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.standins import source, with_sources
from termweave.functions.carry import filled_when, null_when
from termweave.functions.codes import (
    FULL_TIME,
    PART_TIME,
    calendar_of_name,
    decode_class,
    decode_status,
    normalise_calendar,
)
from termweave.functions.dates import compact_date, parse_yyyymmdd, search_date, span_label
from termweave.functions.degrees import (
    Rule,
    associate_filter,
    bachelor_filter,
    classify,
    major_rules,
)
from termweave.functions.keys import branch_code, clean_return_key, first_token, first_word, match_key
from termweave.functions.names import (
    middle_initial,
    name_suffix,
    plain_name,
    without_initials,
    without_suffix,
)
from termweave.operators.audit import record_count_audit
from termweave.operators.importing import import_fields
from termweave.operators.match import matched_records, missing_records
from termweave.operators.rollup import concat_per_record, dense_rank_values, rows_with_lists
from termweave.operators.schools import account_calendars, school_crosswalk
from termweave.operators.terms import (
    nearest_terms_by_date,
    nearest_terms_by_span,
    term_match_counts,
    with_best_term_by_span,
    with_terms_by_date,
)


@query("""
    SELECT c_name AS full_name_c, c_mktsegment AS site__c, c_custkey AS id,
        c_acctbal AS "balance__c", '4-year degree' AS degree__c
    FROM customer
""")
def import_field_map(spark, sf):
    return import_fields(
        source(spark, sf, "customer"),
        [
            ("full_name_c", "c_name"),
            ("site__c", "c_mktsegment"),
            ("id", "c_custkey"),
            ("balance__c", "c_acctbal"),
            ("degree__c", F.lit("4-year degree")),
        ],
    )


@query("""
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice
    FROM orders
    WHERE o_orderstatus = 'F'
        OR (o_orderstatus IN ('O', 'P') AND o_orderpriority IN ('1-URGENT', '2-HIGH')
            AND o_totalprice < 250000.5)
""")
def status_phase_filter(spark, sf):
    status = F.col("o_orderstatus")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    cheap = F.col("o_totalprice") < F.lit(250000.5)
    return (
        source(spark, sf, "orders")
        .where((status == "F") | (status.isin("O", "P") & urgent & cheap))
        .select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    )


def _titles(spark, sf, keep):
    return (
        source(spark, sf, "nsc_feed")
        .where(keep(F.col("Degree_Title")))
        .groupBy("Degree_Title")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(with_sources("nsc_feed", """
    SELECT Degree_Title, count(*) AS n_rows FROM nsc_feed
    WHERE Degree_Title IS NULL OR regexp_matches(Degree_Title, 'BACHELOR|BS|BA|AB')
    GROUP BY Degree_Title
"""))
def title_filter_null_kept(spark, sf):
    return _titles(spark, sf, bachelor_filter)


@query(with_sources("nsc_feed", """
    SELECT Degree_Title, count(*) AS n_rows FROM nsc_feed
    WHERE regexp_matches(Degree_Title, 'ASSOCIATE|CERTIF|AA |AS |CA ')
        AND NOT regexp_matches(Degree_Title, 'POST-BACCALAUREATE|GRADUATE')
    GROUP BY Degree_Title
"""))
def title_filter_null_dropped(spark, sf):
    return _titles(spark, sf, associate_filter)


@query(with_sources("nsc_feed", """
    SELECT c_custkey, Requester_Return_Field, College_Code_Branch,
        ltrim(split_part(College_Code_Branch, '-', 1), '0') AS branch_code,
        split_part(c_name, '#', 1) AS name_word
    FROM nsc_feed JOIN customer
        ON replace(Requester_Return_Field, '_', '') = 'C' || CAST(c_custkey AS VARCHAR)
"""))
def key_normalise_join(spark, sf):
    feed = source(spark, sf, "nsc_feed").select(
        "Requester_Return_Field",
        "College_Code_Branch",
        clean_return_key(F.col("Requester_Return_Field")).alias("contact_id_nsc"),
        branch_code(F.col("College_Code_Branch")).alias("branch_code"),
    )
    students = source(spark, sf, "customer").select(
        "c_custkey",
        match_key(F.concat(F.lit("c"), F.col("c_custkey").cast("string"))).alias("contact_id_mod"),
        first_word(F.replace("c_name", F.lit("#"), F.lit(" "))).alias("name_word"),
    )
    return students.join(feed, F.col("contact_id_mod") == F.col("contact_id_nsc")).drop(
        "contact_id_mod", "contact_id_nsc"
    )


@query(with_sources("school_account scorecard", """
    SELECT account_id, ipeds_id_c AS sfdc_ipeds, INSTNM AS cs_college_name,
        OPEID6 AS cs_college_branch_code_6,
        CASE WHEN academic_calendar_value_c LIKE 'Trimester%' THEN 'Semester'
            ELSE split_part(academic_calendar_value_c, ' ', 1) END AS college_academic_calendar,
        CASE predominant_degree_awarded_c
            WHEN 'Predominantly bachelor''s-degree granting' THEN 1
            WHEN 'Predominantly associate''s-degree granting' THEN 2 ELSE 3 END
            AS rank_college_type
    FROM school_account LEFT JOIN scorecard ON ipeds_id_c = CAST(UNITID AS VARCHAR)
"""))
def school_crosswalk_fanout(spark, sf):
    schools = school_crosswalk(source(spark, sf, "school_account"), source(spark, sf, "scorecard"))
    return schools.select(
        "account_id",
        "sfdc_ipeds",
        "cs_college_name",
        "cs_college_branch_code_6",
        normalise_calendar(F.col("college_academic_calendar")).alias("college_academic_calendar"),
        "rank_college_type",
    )


@query(with_sources("student_term term", """
    SELECT s.AT_Id AS record_id, t.GAS_id AS term_id, t.GAS_Name AS term_name
    FROM student_term s JOIN term t
        ON t.GAS_start_date = make_date(1999, 7, 1)
        AND t.academic_calendar_category_c = CASE
            WHEN s.AT_Name LIKE '%(Semester)%' THEN 'Semester'
            WHEN s.AT_Name LIKE '%(Quarter)%' THEN 'Quarter' ELSE 'Check' END
"""))
def target_term_join(spark, sf):
    target = source(spark, sf, "term").where(
        F.col("GAS_start_date") == F.make_date(F.lit(1999), F.lit(7), F.lit(1))
    )
    records = source(spark, sf, "student_term").select(
        F.col("AT_Id").alias("record_id"), calendar_of_name(F.col("AT_Name")).alias("calendar")
    )
    return records.join(target, F.col("calendar") == F.col("academic_calendar_category_c")).select(
        "record_id", F.col("GAS_id").alias("term_id"), F.col("GAS_Name").alias("term_name")
    )


def _order_days(spark, sf):
    return source(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("order_day"),
    )


_DATE_RANKS = """
    candidates AS (
        SELECT DISTINCT order_day, GAS_id, academic_calendar_category_c AS calendar,
            abs(date_diff('day', order_day, GAS_start_date)) AS gap
        FROM (SELECT CAST(o_orderdate AS DATE) AS order_day FROM orders) AS days JOIN term
            ON year(order_day) = year(GAS_start_date)
            AND order_day BETWEEN GAS_start_date AND GAS_end_date
        WHERE GAS_Name <> 'TEST ONLY  WINTER PREV AT'
    ),
    ranked AS (
        SELECT *, dense_rank() OVER (PARTITION BY order_day ORDER BY gap) AS term_rank
        FROM candidates
    )
"""


@query(with_sources("term", f"""
    WITH {_DATE_RANKS}
    SELECT CAST(order_day AS VARCHAR) AS order_day, GAS_id, calendar,
        CAST(term_rank AS INTEGER) AS term_rank
    FROM ranked WHERE term_rank IN (1, 2)
"""))
def nearest_terms_by_date_map(spark, sf):
    terms = nearest_terms_by_date(_order_days(spark, sf), source(spark, sf, "term"), "order_day")
    return terms.select(
        "order_day", "GAS_id", F.col("academic_calendar_category_c").alias("calendar"), "term_rank"
    )


def _spans(spark, sf):
    lines = source(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("span_end")
    )
    orders = source(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("span_begin")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).where(
        F.col("span_end") >= F.col("span_begin")
    )


_SPAN_RANKS = """
    spans AS (
        SELECT l_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS span_begin,
            CAST(l_shipdate AS DATE) AS span_end
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_shipdate >= o_orderdate
    ),
    candidates AS (
        SELECT DISTINCT span_begin, span_end,
            CAST(span_begin AS VARCHAR) || ' to ' || CAST(span_end AS VARCHAR) AS label,
            GAS_id, GAS_Name_short,
            CAST(abs(date_diff('day', span_begin, GAS_start_date)) AS INTEGER) AS start_gap,
            CAST(abs(date_diff('day', span_end, GAS_end_date)) AS INTEGER) AS end_gap
        FROM spans JOIN term ON year(span_begin) = year(GAS_start_date)
        WHERE span_end <= GAS_end_date
    ),
    ranked AS (
        SELECT *,
            CAST(dense_rank() OVER (PARTITION BY label ORDER BY start_gap) AS INTEGER)
                AS start_rank,
            CAST(dense_rank() OVER (PARTITION BY label ORDER BY end_gap) AS INTEGER) AS end_rank
        FROM candidates
    )
"""


@query(with_sources("term", f"""
    WITH {_SPAN_RANKS}
    SELECT label AS nsc_date_concat, GAS_id, start_gap AS start_date_diff,
        end_gap AS end_date_diff, start_rank, end_rank
    FROM ranked
"""))
def nearest_terms_by_span_map(spark, sf):
    spans = nearest_terms_by_span(
        _spans(spark, sf), source(spark, sf, "term"), "span_begin", "span_end"
    )
    return spans.select(
        "nsc_date_concat", "GAS_id", "start_date_diff", "end_date_diff", "start_rank", "end_rank"
    )


@query(with_sources("term", f"""
    WITH {_SPAN_RANKS}
    SELECT l_orderkey, l_linenumber, GAS_id
    FROM spans JOIN ranked USING (span_begin, span_end)
    WHERE start_rank = 1 AND end_rank = 1
"""))
def best_term_per_span(spark, sf):
    rows = with_best_term_by_span(
        _spans(spark, sf), source(spark, sf, "term"), "span_begin", "span_end"
    )
    return rows.select("l_orderkey", "l_linenumber", "GAS_id")


@query(with_sources("term", f"""
    WITH {_SPAN_RANKS}
    SELECT label AS nsc_date_concat, GAS_Name_short, start_rank, end_rank,
        count(GAS_Name_short) AS num_terms
    FROM ranked GROUP BY ALL
"""))
def term_match_count(spark, sf):
    spans = nearest_terms_by_span(
        _spans(spark, sf), source(spark, sf, "term"), "span_begin", "span_end"
    )
    return term_match_counts(spans, "span_begin", "span_end").drop("span_begin", "span_end")


def _mapped_and_records(spark, sf):
    mapped = with_terms_by_date(_order_days(spark, sf), source(spark, sf, "term"), "order_day")
    events = mapped.select(
        F.col("o_custkey").alias("contact_id_nsc"), "o_orderkey", "order_day", "GAS_id", "o_orderstatus"
    )
    records = mapped.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("contact_id_mod"), F.col("GAS_id").alias("PAT_GAS_id")
    )
    return events.where("o_orderstatus = 'O'").drop("o_orderstatus"), records.distinct()


_MAPPED = f"""
    {_DATE_RANKS},
    mapped AS (
        SELECT o_orderkey, o_custkey, o_orderstatus, r.order_day, GAS_id
        FROM orders JOIN ranked r ON CAST(o_orderdate AS DATE) = r.order_day
        WHERE term_rank <= 2
    ),
    records AS (SELECT DISTINCT o_custkey, GAS_id FROM mapped WHERE o_orderstatus = 'F'),
    matched AS (
        SELECT m.* FROM mapped m JOIN records USING (o_custkey, GAS_id)
        WHERE m.o_orderstatus = 'O'
    )
"""


@query(with_sources("term", f"""
    WITH {_MAPPED}
    SELECT DISTINCT o_custkey AS student, o_orderkey, GAS_id FROM matched
"""))
def matched_order_records(spark, sf):
    events, records = _mapped_and_records(spark, sf)
    return (
        matched_records(records, events)
        .select(F.col("contact_id_nsc").alias("student"), "o_orderkey", "GAS_id")
        .distinct()
    )


@query(with_sources("term", f"""
    WITH {_MAPPED}
    SELECT c_custkey AS student, c_name, o_orderkey, GAS_id
    FROM mapped JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'O' AND o_custkey NOT IN (SELECT o_custkey FROM matched)
"""))
def missing_order_records(spark, sf):
    events, records = _mapped_and_records(spark, sf)
    students = source(spark, sf, "customer").select(
        F.col("c_custkey").alias("contact_id_mod"), "c_name"
    )
    return missing_records(students, events, records).select(
        F.col("contact_id_mod").alias("student"), "c_name", "o_orderkey", "GAS_id"
    )


@query(with_sources("school_account term", f"""
    WITH {_DATE_RANKS}
    SELECT o_orderkey, account_id, GAS_id
    FROM orders JOIN ranked ON CAST(o_orderdate AS DATE) = order_day
        JOIN school_account ON account_id = 'A' || CAST(o_custkey AS VARCHAR)
    WHERE term_rank <= 2
        AND (CASE WHEN academic_calendar_value_c = 'Trimester' THEN 'Semester'
                ELSE split_part(academic_calendar_value_c, ' ', 1) END = calendar
            OR academic_calendar_value_c IN ('Trimester', 'Semester', 'Semester System')
                AND o_orderpriority LIKE '%LOW%')
"""))
def calendar_alignment(spark, sf):
    days = source(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("school"),
        F.col("o_orderdate").cast("date").alias("order_day"),
    )
    schools = account_calendars(source(spark, sf, "school_account")).select(
        "account_id",
        normalise_calendar(F.col("college_academic_calendar")).alias("college_academic_calendar"),
    )
    rows = with_terms_by_date(days, source(spark, sf, "term"), "order_day").join(
        schools, F.col("school") == F.col("account_id")
    )
    college = F.col("college_academic_calendar")
    lenient = (college == "Semester") & F.col("o_orderpriority").contains("LOW")
    return rows.where((F.col("GAS_calendar") == college) | lenient).select(
        "o_orderkey", "account_id", "GAS_id"
    )


_PART_RULES = [
    Rule("exact", "old ring", "ring, old"),
    Rule("contains", "ring", "ring"),
    Rule("contains", "hot ", "hot"),
    Rule("contains", "bolt", "bolt"),
    Rule("exact", "hot gear", "never"),
    Rule("contains", "w", "with w"),
]


@query("""
    SELECT l_orderkey, l_linenumber, p_name,
        CASE WHEN p_name = 'old ring' THEN 'ring, old'
            WHEN strpos(p_name, 'ring') > 0 THEN 'ring'
            WHEN strpos(p_name, 'hot ') > 0 THEN 'hot'
            WHEN strpos(p_name, 'bolt') > 0 THEN 'bolt'
            WHEN strpos(p_name, 'w') > 0 THEN 'with w'
            ELSE 'ERROR!' END AS label
    FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def ordered_classifier(spark, sf):
    parts = source(spark, sf, "part").select(
        "p_partkey", "p_name", classify(F.col("p_name"), _PART_RULES).alias("label")
    )
    lines = source(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")


# Expected labels of the stand-in majors, without and with the wider multimedia rule.
_MAJOR_LABELS = """
    labels(major, label_u, label_b) AS (VALUES
        ('ASSOCIATE OF ARTS', 'Liberal Arts or History', 'Liberal Arts or History'),
        ('SPANISH', 'Literature or Languages', 'Literature or Languages'),
        ('NURSING', 'Health Sciences', 'Health Sciences'),
        ('PRE-NURSING', 'Biological, Environmental, or Agricultural Sciences',
            'Biological, Environmental, or Agricultural Sciences'),
        ('BIOLOGY', 'Biological, Environmental, or Agricultural Sciences',
            'Biological, Environmental, or Agricultural Sciences'),
        ('MULTIMEDIA', 'ERROR!', 'Arts: Design, Performing, or Visual'),
        ('MULTIMEDIA DESIGN & DEVELOPMENT', 'Arts: Design, Performing, or Visual',
            'Arts: Design, Performing, or Visual'),
        ('COMPUTER SCIENCE', 'Computer Science or Information Technology',
            'Computer Science or Information Technology'),
        ('BIOTECHNOLOGY', 'Computer Science or Information Technology',
            'Computer Science or Information Technology'),
        ('ECONOMICS', 'Sociology, Political Science, Economics, or other Social Sciences',
            'Sociology, Political Science, Economics, or other Social Sciences'),
        ('COMMUNICATION', 'ERROR!', 'ERROR!'),
        ('COMMUNICATION STUDIES', 'Communications or Marketing', 'Communications or Marketing'),
        ('GENERAL', 'ERROR!', 'ERROR!'),
        ('GENERAL STUDIES', 'Liberal Arts or History', 'Liberal Arts or History'),
        ('IGETC', 'Undeclared', 'Undeclared'),
        ('AMERICAN HISTORY', 'Liberal Arts or History', 'Liberal Arts or History'),
        ('BASKETRY', 'ERROR!', 'ERROR!'),
        ('CRIMINAL JUSTICE', 'Sociology, Political Science, Economics, or other Social Sciences',
            'Sociology, Political Science, Economics, or other Social Sciences'),
        ('MECHANICAL ENGINEERING', 'Engineering or Architecture', 'Engineering or Architecture'),
        ('APPLIED MATH', 'Math or Statistics', 'Math or Statistics')
    )
"""


@query(with_sources("nsc_feed", f"""
    WITH {_MAJOR_LABELS}
    SELECT Degree_Major_1, label_u, label_b, count(*) AS n_rows
    FROM nsc_feed LEFT JOIN labels ON Degree_Major_1 = major
    GROUP BY ALL
"""))
def major_labels(spark, sf):
    major = F.col("Degree_Major_1")
    return (
        source(spark, sf, "nsc_feed")
        .select(
            major,
            classify(major, major_rules(any_multimedia=False)).alias("label_u"),
            classify(major, major_rules(any_multimedia=True)).alias("label_b"),
        )
        .groupBy("Degree_Major_1", "label_u", "label_b")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def _order_majors(spark, sf):
    return source(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("major"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, major,
        CAST(dense_rank() OVER (PARTITION BY l_orderkey ORDER BY major NULLS FIRST) AS INTEGER)
            AS row_number_major
    FROM (
        SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS major FROM lineitem
    ) AS lines
""")
def major_rank(spark, sf):
    return dense_rank_values(_order_majors(spark, sf), ["l_orderkey"], "major", "row_number_major")


def _order_parts(spark, sf):
    parts = source(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    lines = source(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_shipdate").cast("date").alias("shipped"),
        F.when(F.col("l_linestatus") == "O", F.col("l_returnflag")).alias("flag"),
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


_ORDER_LISTS = """
    lines AS (
        SELECT l_orderkey, CAST(l_shipdate AS DATE) AS shipped, p_name, p_type,
            CASE WHEN l_linestatus = 'O' THEN l_returnflag END AS flag
        FROM lineitem JOIN part ON l_partkey = p_partkey
    ),
    lists AS (
        SELECT l_orderkey,
            string_agg(p_name, '|' ORDER BY shipped, p_name, p_type) AS list_names,
            string_agg(flag, '|' ORDER BY shipped, p_name, p_type, flag) AS list_flags,
            string_agg(p_type, '|' ORDER BY p_type) AS list_types,
            min(p_type) AS best_type
        FROM lines GROUP BY l_orderkey
    )
"""


def _order_lists(spark, sf):
    return concat_per_record(
        _order_parts(spark, sf),
        ["l_orderkey"],
        order=["shipped", "p_name", "p_type"],
        lists={"list_names": "p_name", "list_flags": "flag", "list_types": "p_type"},
        by_value=("list_types",),
        best={"best_type": "p_type"},
    )


@query(f"""
    WITH {_ORDER_LISTS}
    SELECT l_orderkey, list_names, list_flags, list_types,
        split_part(list_names, '|', 1) AS first_name
    FROM lists
""")
def record_concat_first(spark, sf):
    lists = _order_lists(spark, sf)
    return lists.select(
        "l_orderkey",
        "list_names",
        "list_flags",
        "list_types",
        first_token(F.col("list_names")).alias("first_name"),
    )


@query(f"""
    WITH {_ORDER_LISTS}
    SELECT DISTINCT l_orderkey, p_type, p_name, list_names
    FROM lines JOIN lists USING (l_orderkey)
    WHERE p_type = best_type
""")
def best_degree_rows(spark, sf):
    lists = _order_lists(spark, sf).withColumnRenamed("l_orderkey", "key")
    return (
        _order_parts(spark, sf)
        .join(lists, F.col("l_orderkey") == F.col("key"))
        .where(F.col("p_type") == F.col("best_type"))
        .select("l_orderkey", "p_type", "p_name", "list_names")
        .distinct()
    )


@query(f"""
    WITH {_ORDER_LISTS}
    SELECT DISTINCT l_orderkey, CAST(shipped AS VARCHAR) AS shipped, p_type, p_name, flag,
        list_names, list_flags, list_types
    FROM lines JOIN lists USING (l_orderkey)
    WHERE p_type = best_type
""")
def rows_carried_with_lists(spark, sf):
    """Rows of a record's best type with its lists, out of one group; copies are counted before."""
    parts = _order_parts(spark, sf).drop("p_partkey", "l_partkey")
    counted = parts.groupBy(*parts.columns).agg(F.count(F.lit(1)).alias("n"))
    return rows_with_lists(
        counted,
        ["l_orderkey"],
        order=["shipped", "p_name", "p_type"],
        lists={"list_names": "p_name", "list_flags": "flag", "list_types": "p_type"},
        by_value=("list_types",),
        best={"best_type": "p_type"},
        copies="n",
    )


@query(with_sources("student_term", """
    SELECT GAS_Name_short, count(type_of_degree_earned_c) AS n_students, count(*) AS n_records
    FROM student_term GROUP BY GAS_Name_short
"""))
def record_count_per_term(spark, sf):
    records = source(spark, sf, "student_term")
    return record_count_audit(records, "GAS_Name_short", "type_of_degree_earned_c")


@query(with_sources("term_enrolment", """
    SELECT ate_id,
        CASE WHEN current_ct_status_c <> 'Active' THEN NULL ELSE major_c END AS major_c,
        CASE WHEN current_ct_phase_c = 'Alumni' THEN NULL ELSE ate_school_id END AS school_c,
        CASE WHEN current_ct_status_c = 'Active' AND ate_enrollment_status IS NULL
            THEN 'Carried' ELSE ate_enrollment_status END AS enrollment_status
    FROM term_enrolment
"""))
def carry_over_reset(spark, sf):
    status = F.col("current_ct_status_c")
    return source(spark, sf, "term_enrolment").select(
        "ate_id",
        null_when(F.col("major_c"), status != "Active").alias("major_c"),
        null_when(F.col("ate_school_id"), F.col("current_ct_phase_c") == "Alumni").alias("school_c"),
        filled_when(F.col("ate_enrollment_status"), status == "Active", F.lit("Carried")).alias(
            "enrollment_status"
        ),
    )


@query(with_sources("nsc_feed", """
    WITH levels(code, level) AS (VALUES
        ('F', 'Undergraduate'), ('S', 'Undergraduate'), ('J', 'Undergraduate'),
        ('R', 'Undergraduate'), ('C', 'Undergraduate'), ('N', 'Undergraduate'),
        ('B', 'Undergraduate'), ('A', 'Associate''s'), ('M', 'Graduate'), ('D', 'Graduate'),
        ('P', 'Graduate'), ('L', 'Graduate'), ('G', 'Graduate or Professional'),
        ('T', 'Graduate or Post-Bacc'))
    SELECT Enrollment_Status, Class_Level,
        CASE WHEN Enrollment_Status = 'F' THEN 'Full-time'
            WHEN Enrollment_Status IN ('Q', 'H', 'L') THEN 'Part-time'
            ELSE 'Error or Not Enrolled' END AS status,
        coalesce(level, 'Error') AS class, count(*) AS n_rows
    FROM nsc_feed LEFT JOIN levels ON Class_Level = code
    GROUP BY ALL
"""))
def status_decode(spark, sf):
    return (
        source(spark, sf, "nsc_feed")
        .select(
            "Enrollment_Status",
            "Class_Level",
            decode_status(F.col("Enrollment_Status")).alias("status"),
            decode_class(F.col("Class_Level")).alias("class"),
        )
        .groupBy("Enrollment_Status", "Class_Level", "status", "class")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query(with_sources("nsc_feed", """
    SELECT Requester_Return_Field, College_Sequence,
        strftime(strptime(CAST(Enrollment_Begin AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') || ' to ' ||
            strftime(strptime(CAST(Enrollment_End AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS span,
        CAST(Enrollment_Begin // 10000 AS INTEGER) AS begin_year
    FROM nsc_feed
"""))
def span_labels(spark, sf):
    begin, end = (parse_yyyymmdd(F.col(c)) for c in ("Enrollment_Begin", "Enrollment_End"))
    return source(spark, sf, "nsc_feed").select(
        "Requester_Return_Field",
        "College_Sequence",
        span_label(begin, end).alias("span"),
        F.year(begin).alias("begin_year"),
    )


@query(with_sources("student_term", """
    SELECT AT_Id AS record_id,
        CASE WHEN enrollment_status_c <> AT_Enrollment_Status_c THEN 1 ELSE 0 END AS differs
    FROM student_term
    WHERE AT_Enrollment_Status_c NOT IN ('Full-time', 'Part-time')
        AND school_c <> 'School 1'
"""))
def discrepancy_flag(spark, sf):
    record, other = F.col("AT_Enrollment_Status_c"), F.col("enrollment_status_c")
    return (
        source(spark, sf, "student_term")
        .where(~record.isin(FULL_TIME, PART_TIME) & (F.col("school_c") != "School 1"))
        .select(
            F.col("AT_Id").alias("record_id"), F.when(other != record, 1).otherwise(0).alias("differs")
        )
    )


def _words(spark, sf):
    words = source(spark, sf, "documents").select(
        F.explode(F.split("text", r"[ \n\t]+")).alias("word")
    )
    return words.where("word <> ''").distinct()


_WORDS = r"""
    words AS (
        SELECT DISTINCT word
        FROM (SELECT unnest(regexp_split_to_array(text, '[ \n\t]+')) AS word FROM documents) AS w
        WHERE word <> ''
    )
"""


# Character by character, without the patterns of the functions that it checks. Letters of the
# documents are those with two cases, and the one that has no capital.
_IS_LETTER = "(upper(c) <> lower(c) OR c IN ('ß', '_'))"
_IS_WORD = f"({_IS_LETTER} OR c BETWEEN '0' AND '9')"


def _kept(text: str, condition: str) -> str:
    return f"array_to_string(list_filter(string_split({text}, ''), lambda c: {condition}), '')"


def _dotted(chars: str, at: str) -> str:
    """Whether the character at a place is an initial, which a dot follows."""
    return f"({re.sub(r'\bc\b', f'{chars}[{at}]', _IS_WORD)} AND {chars}[{at} + 1] = '.')"


@query(f"""
    WITH {_WORDS},
    parts AS (
        SELECT word, upper(replace(word, 'ß', 'ss')) AS last_name,
            string_split(word || ' ' || left(word, 1) || '.', '') AS chars, word || '7' AS middle_name
        FROM words
    ),
    cut AS (
        SELECT *, CASE WHEN ends_with(last_name, 'VIII') THEN 4
            WHEN left(right(last_name, 3), 2) = 'Jr' AND length(last_name) > 2 THEN 3
            WHEN ends_with(last_name, 'III') OR ends_with(last_name, 'VII') THEN 3
            WHEN right(last_name, 2) IN ('Jr', 'II', 'IV', 'VI', 'IX') THEN 2
            WHEN right(last_name, 1) IN ('I', 'V') THEN 1 ELSE 0 END AS n,
            list_filter(range(1, len(chars) + 1), lambda i: {_dotted("chars", "i")}) AS initials
        FROM parts
    ),
    spelled AS (
        SELECT *, array_to_string(list_transform(
            list_filter(range(1, len(chars) + 1),
                lambda i: NOT list_contains(initials, i) AND NOT list_contains(initials, i - 1)),
            lambda i: chars[i]), '') AS bare
        FROM cut
    )
    SELECT word, CASE WHEN n > 0 THEN {_kept("right(last_name, n)", _IS_LETTER)} END AS suffix,
        {_kept("replace(left(last_name, length(last_name) - n), chr(39), ' ')", _IS_WORD + " OR c IN (' ', '-')")} AS last_name,
        upper(replace(coalesce(chars[initials[1]],
            nullif(left({_kept("middle_name", _IS_LETTER)}, 1), '')), 'ß', 'ss')) AS middle_initial,
        {_kept("replace(bare, chr(39), ' ')", _IS_WORD + " OR c IN (' ', '-')")} AS first_name
    FROM spelled
""")
def name_clean(spark, sf):
    word = F.col("word")
    first = F.concat(word, F.lit(" "), F.substring(word, 1, 1), F.lit("."))
    last = F.upper(word)
    return _words(spark, sf).select(
        "word",
        name_suffix(last).alias("suffix"),
        plain_name(without_suffix(last)).alias("last_name"),
        middle_initial(first, F.concat(word, F.lit("7"))).alias("middle_initial"),
        plain_name(without_initials(first)).alias("first_name"),
    )


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS birthdate,
        CAST(year(o_orderdate) * 10000 + 601 AS INTEGER) AS search_date
    FROM orders
""")
def search_dates(spark, sf):
    return source(spark, sf, "orders").select(
        "o_orderkey",
        compact_date(F.col("o_orderdate")).alias("birthdate"),
        search_date(F.year("o_orderdate")).alias("search_date"),
    )
