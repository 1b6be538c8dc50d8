"""Every registered query against its SQL twin, and the shape of its plan."""

import contextlib
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as contract
import compare
from archiveloom.plans import oracle, registered
from conftest import SF_SMALL

QUERIES, SQL = registered.QUERIES, oracle.all_sql()


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF_SMALL)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_records_are_parsed_once(spark):
    for name in QUERIES:
        if name.startswith("parse_"):
            plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("_corrupt") == 0, name  # the record's parse is behind the staged table


def test_facts_are_scanned_once(spark):
    plan = lambda name: QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan("file_candidates").count("l_orderkey#") > 0
    assert sum("FileScan" in line and "l_orderkey" in line for line in plan("file_candidates").split("\n")) == 1


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    ok, message = compare.compare(spark, db, SF_SMALL, name, QUERIES[name], SQL.get(name))
    assert ok, message


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pairwise_join(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES[name](spark, SF_SMALL).explain()
    plan = out.getvalue()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python
