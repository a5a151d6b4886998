"""From dates and date spans to the nearest academic terms.

A term is a candidate only in the calendar year it starts in. Nearness depends on the date
or span alone, never on the student, so the work is done on the term calendar and the feed
only looks its rows up. The calendar's maps are counted before they are broadcast; beyond
the bound the same joins shuffle.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termweave.functions.dates import span_label
from termweave.operators.sizes import is_small
from termweave.sources.columns import TERM_COLUMNS

# Fixed value: name of a row in the calendar that is no term (with two blanks).
TEST_TERM = "TEST ONLY  WINTER PREV AT"


def real_terms(terms: DataFrame) -> DataFrame:
    return terms.where(F.col("GAS_Name") != TEST_TERM)


def _calendar(terms: DataFrame) -> DataFrame:
    """Distinct terms with the calendar year they start in."""
    return (
        terms.select(TERM_COLUMNS).distinct().withColumn("GAS_Year", F.year("GAS_start_date"))
    )


def term_days(terms: DataFrame, max_rank: int = 2) -> DataFrame:
    """For every day the terms that hold it and are among the nearest starts.

    Dense rank by days since the term's start, so terms that start together share a rank.
    At most 366 rows per term, whatever the size of the feed.
    """
    last = F.least("GAS_end_date", F.make_date("GAS_Year", F.lit(12), F.lit(31)))
    days = (
        _calendar(real_terms(terms))
        .where(F.col("GAS_end_date") >= F.col("GAS_start_date"))
        .withColumn("term_day", F.explode(F.sequence("GAS_start_date", last)))
    )
    gap = F.abs(F.datediff("term_day", "GAS_start_date"))
    nearest = Window.partitionBy("term_day").orderBy(gap)
    return days.withColumn("term_rank", F.dense_rank().over(nearest)).where(
        F.col("term_rank") <= max_rank
    )


def nearest_terms_by_date(
    events: DataFrame, terms: DataFrame, date_col: str, max_rank: int = 2
) -> DataFrame:
    """The distinct dates of ``events`` with their nearest terms and ranks."""
    dates = events.select(date_col).distinct()
    days = term_days(terms, max_rank)
    return dates.join(days, F.col(date_col) == days.term_day).drop("term_day")


def with_terms_by_date(
    events: DataFrame, terms: DataFrame, date_col: str, max_rank: int = 2
) -> DataFrame:
    """Each event once per nearest term of its date; events outside all terms are dropped."""
    days = term_days(terms, max_rank).select(
        "term_day",
        "GAS_id",
        "GAS_Name",
        "academic_year_c",
        F.col("academic_calendar_category_c").alias("GAS_calendar"),
    )
    return events.join(days, F.col(date_col) == days.term_day).drop("term_day")


def nearest_terms_by_span(
    events: DataFrame, terms: DataFrame, begin_col: str, end_col: str
) -> DataFrame:
    """The distinct spans of ``events`` with their candidate terms, gaps and dense ranks.

    Candidates start in the year of the span's begin and end on or after its end.
    """
    begin, end = F.col(begin_col), F.col(end_col)
    spans = events.select(begin_col, end_col).distinct()
    candidates = spans.join(
        _calendar(terms),
        (F.year(begin) == F.col("GAS_Year")) & (end <= F.col("GAS_end_date")),
    )
    gaps = candidates.select(
        span_label(begin, end).alias("nsc_date_concat"),
        begin_col,
        end_col,
        *TERM_COLUMNS,
        F.abs(F.datediff(begin, F.col("GAS_start_date"))).alias("start_date_diff"),
        F.abs(F.datediff(end, F.col("GAS_end_date"))).alias("end_date_diff"),
    )
    span = Window.partitionBy(begin_col, end_col)
    return gaps.withColumns(
        {
            "start_rank": F.dense_rank().over(span.orderBy("start_date_diff")),
            "end_rank": F.dense_rank().over(span.orderBy("end_date_diff")),
        }
    )


def _terms_by_year(terms: DataFrame) -> DataFrame:
    """One row per calendar year with the terms that start in it."""
    term = F.struct("GAS_id", "GAS_Name_short", "GAS_start_date", "GAS_end_date")
    return _calendar(terms).groupBy("GAS_Year").agg(F.collect_list(term).alias("year_terms"))


def _with_best_terms(events: DataFrame, terms: DataFrame, begin_col: str, end_col: str) -> DataFrame:
    """Adds ``best_terms``: of the span's candidates those nearest both by start and by end.

    Found row by row among the few terms of one year, so the events are neither shuffled nor
    grouped by span while the calendar is small. Beyond that the events' distinct spans, of which a
    year has some ten thousand, go to the terms of their year, and the events look theirs up by span:
    they aren't gathered by year, of which there are about ten. A hot span is split in that join.
    """
    years = _terms_by_year(terms)
    if is_small(terms):
        return _best_of_year(events, F.broadcast(years), begin_col, end_col)
    spans = events.select(F.col(begin_col).alias("_begin"), F.col(end_col).alias("_end")).distinct()
    best = _best_of_year(spans, years, "_begin", "_end")
    own = (F.col(begin_col) == F.col("_begin")) & (F.col(end_col) == F.col("_end"))
    return events.join(best, own).drop("_begin", "_end")


def _best_of_year(events: DataFrame, years: DataFrame, begin_col: str, end_col: str) -> DataFrame:
    """Events with the ``best_terms`` of the year that they begin in."""
    begin, end = F.col(begin_col), F.col(end_col)

    def start_gap(term: Column) -> Column:
        return F.abs(F.datediff(begin, term.GAS_start_date))

    def end_gap(term: Column) -> Column:
        return F.abs(F.datediff(end, term.GAS_end_date))

    return (
        events.join(years, F.year(begin) == F.col("GAS_Year"))
        .withColumn("year_terms", F.filter("year_terms", lambda t: end <= t.GAS_end_date))
        .withColumn("start_gap", F.array_min(F.transform("year_terms", start_gap)))
        .withColumn("end_gap", F.array_min(F.transform("year_terms", end_gap)))
        .withColumn(
            "best_terms",
            F.filter(
                "year_terms",
                lambda t: (start_gap(t) == F.col("start_gap")) & (end_gap(t) == F.col("end_gap")),
            ),
        )
        .drop("year_terms", "GAS_Year", "start_gap", "end_gap")
    )


def with_best_term_by_span(
    events: DataFrame, terms: DataFrame, begin_col: str, end_col: str
) -> DataFrame:
    """Each event once per term that is nearest both by start and by end.

    Same terms as rank 1 and 1 of :func:`nearest_terms_by_span`. An event whose nearest start and
    nearest end are different terms is dropped.
    """
    return (
        _with_best_terms(events, terms, begin_col, end_col)
        .withColumn("best_term", F.explode(F.array_distinct("best_terms")))
        .withColumns({"GAS_id": F.col("best_term.GAS_id"), "GAS_Name_short": F.col("best_term.GAS_Name_short")})
        .drop("best_terms", "best_term")
    )


def with_best_term_names(
    events: DataFrame, terms: DataFrame, begin_col: str, end_col: str
) -> DataFrame:
    """Each event once per short name of its best terms, with the number of terms of that name.

    The ranks, which are 1 for the best terms, are kept as columns. Same rows as the counts of
    :func:`term_match_counts` with rank 1 and 1, looked up by span.
    """
    names = F.transform("best_terms", lambda t: t.GAS_Name_short)
    named = F.transform(
        F.array_distinct(names),
        lambda name: F.struct(
            name.alias("name"), F.size(F.filter(names, lambda other: other == name)).cast("bigint").alias("n")
        ),
    )
    return (
        _with_best_terms(events, terms, begin_col, end_col)
        .withColumn("best_name", F.explode(named))
        .withColumns(
            {
                "GAS_Name_short": F.col("best_name.name"),
                "num_terms": F.col("best_name.n"),
                "start_rank": F.lit(1),
                "end_rank": F.lit(1),
            }
        )
        .drop("best_terms", "best_name")
    )


def term_match_counts(span_terms: DataFrame, begin_col: str, end_col: str) -> DataFrame:
    """Number of terms per span, short term name and ranks, from the span map."""
    return span_terms.groupBy(
        "nsc_date_concat", begin_col, end_col, "GAS_Name_short", "start_rank", "end_rank"
    ).agg(F.count("GAS_Name_short").alias("num_terms"))
