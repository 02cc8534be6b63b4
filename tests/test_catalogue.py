"""Every registered query against its SQL twin, and what its plan must not contain."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gleaner.plans import catalogue
from tools.check_catalogue import rows_of

from conftest import SMALL

#: the optional subpackage has tests of its own
QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        db.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return db


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    if name != "terminal_flips":
        assert "BroadcastNestedLoopJoin" not in plan
    assert name in ORACLES
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_entry_offers_the_catalogue():
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["filter_failed_runs"](spark, SMALL))
    assert "EqualTo(user_id,8)" in plan and "props" not in plan.split("ReadSchema")[1]
    plan = plan_of(QUERIES["cascade_gates"](spark, SMALL))
    assert "text" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("name", ["recent_runs", "failure_report", "repair_queue", "newest_per_category", "negative_examples", "breaker_now"])
def test_top_n_is_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, SMALL))
