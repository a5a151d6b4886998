"""Registered queries against DuckDB, and the shape of their plans."""

import re

import pytest

import __spark_entry__ as entry
from catalogue.registry import ORACLES, QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"



@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(compiled, con, name):
    df = QUERIES[name](compiled, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Cartesian|NestedLoop|BatchEval|MapInPandas", plan)
    assert compare(df, con, ORACLES[name]) == ""


def test_flagship(compiled):
    df = entry.entry(compiled)
    assert df.count() > 0


@pytest.mark.parametrize("name", ["degree_4yr_create", "changed_rows_new_only"])
def test_anti_joins(compiled, name):
    plan = QUERIES[name](compiled, SF)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan


def test_term_rank_is_limited_early(compiled):
    plan = QUERIES["nearest_terms_by_date_map"](compiled, SF)
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()
