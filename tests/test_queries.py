"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry
from tallyframe import catalog
from tallyframe.catalog import composites, relational

from .support import connect, mismatch

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "ArrowEval", "lambda"):
        assert banned not in plan or (banned == "lambda" and not name.startswith(("a1_", "q3_", "q4_")))
    assert mismatch(frame, database, SQL.get(name)) is None


def test_validation_joins_the_sale_rows_once(spark, monkeypatch):
    """The four results share the joined rows; each had its own join of all line items before."""
    calls = []
    for name in ("line_sales", "order_sales"):
        for module in (composites, relational):
            def counted(*args, name=name, build=getattr(module, name)):
                calls.append(name)
                return build(*args)
            monkeypatch.setattr(module, name, counted)
    assert QUERIES["q10_validate_results"](spark, FOLDER).count() > 0
    assert sorted(calls) == ["line_sales", "order_sales"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == [
        "state", "window_date", "window_days", "winning_size", "frequency", "population_variance",
    ]
    assert frame.count() > 0
