"""Operator queries that SQL can express, on the smallest test tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import parity  # noqa: E402
from platewise.llm import queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
NATIVE = {"op9_quality_rules", "op10_license_scan"}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equal_to_sql(spark, name):
    frame = queries.QUERIES[name](spark, FOLDER)
    assert parity.compare(frame, parity.database(FOLDER), queries.SQL[name]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython") if node in plan]
    assert name not in NATIVE or not [node for node in ("Python", "Arrow", "Pandas") if node in plan]


def test_one_query_for_each_operator_and_the_pipeline():
    import __spark_entry__ as contract

    names = set(contract.queries())
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names
