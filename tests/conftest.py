from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]
# functions of the test modules run in Python workers too
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, os.environ.get("PYTHONPATH", "")])

from gleaner.plans.views import Tables  # noqa: E402
from gleaner.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


@pytest.fixture
def evaluate(spark):
    """Values of a column expression over rows of one text column `v`."""
    def run(values, expression, schema="v STRING"):
        rows = [v if isinstance(v, tuple) else (v,) for v in values]
        indexed = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i INT, {schema}")
        out = indexed.select("i", expression.alias("x")).collect()
        return [r.x for r in sorted(out, key=lambda r: r.i)]

    return run
