"""The registered queries of the subpackage: SQL twins, plans, and reruns."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gleaner.llm import queries
from tools.check_catalogue import rows_of

from conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        db.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return db


def test_all_are_registered():
    assert queries.QUERIES.keys() <= entry.queries().keys() and queries.ORACLES.keys() <= entry.oracle_sql().keys()
    assert [n.split("_")[0] for n in queries.QUERIES] == [*[f"op{i}" for i in range(1, 14)], "pipeline"]


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL)
    cursor = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("name", ["op4_line_dedup", "op7_secrets", "op10_chat_format"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


@pytest.mark.parametrize("name", ["op5_source_mix", "op6_toxicity", "op7_secrets", "op9_permutation_index", "op12_byte_shards"])
def test_reruns_agree(spark, name):
    first, second = (queries.QUERIES[name](spark, SMALL) for _ in range(2))
    assert rows_of(first.columns, first.collect()) == rows_of(second.columns, second.collect())
