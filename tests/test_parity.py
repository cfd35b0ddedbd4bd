"""Every registered query on the smallest test tables, against SQL where there is one."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import parity  # noqa: E402
from platewise import registry, session  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")

# Run seven fits or a hundred iterations; their parts are tested with a shorter sweep.
SLOW = {"lda_fit_metrics", "lda_rows_sweep"}


@pytest.fixture(scope="module")
def connection():
    return parity.database(FOLDER)


# Plan nodes that compare all pairs of rows or leave the JVM.
UNWANTED = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow")

# Scoring every user against every meal is what recommendForAllUsers is. The queries that check it
# read its staged result.
ALL_PAIRS = {"als_shape"}


@pytest.mark.parametrize("name", sorted(set(registry.SQL) - SLOW))
def test_equal_to_sql(spark, connection, name):
    with session.scope(spark):
        frame = registry.QUERIES[name](spark, FOLDER)
        assert parity.compare(frame, connection, registry.SQL[name]) is None
        plan = frame._jdf.queryExecution().executedPlan().toString()
    assert name in ALL_PAIRS or not [node for node in UNWANTED if node in plan]


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


def test_entry(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 10


def test_full_wide_matrix_equals_pivot(spark, connection):
    from platewise.operators import matrix
    from platewise.plans import clean
    from platewise.sources import order_tables

    cleaned = clean.clean(order_tables.ratings(spark, FOLDER), order_tables.meals(spark, FOLDER))
    wide = matrix.full_wide_matrix(matrix.rating_cells(cleaned))
    connection.execute("CREATE TABLE cleaned AS " + registry.SQL["encoded_ratings"])
    connection.execute("CREATE TABLE pivoted AS PIVOT cleaned ON MealID USING first(Rating) GROUP BY UserID")
    sql = "SELECT UserID, coalesce(COLUMNS(* EXCLUDE UserID), 0) FROM pivoted"
    assert len(wide.columns) == 201
    assert parity.compare(wide, connection, sql) is None
