"""All registered queries against their SQL, and the shape of their plans."""

import pytest

import __spark_entry__ as contract
from ferrylog.catalog import checks, queries as catalog
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(checks.checks())
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    fault, rows = compare(spark, duck, name, SF_DIR)
    assert not fault and rows > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 960


STREAMED = ("_stream", "_late", "_pending", "_rounds")
BATCH = [n for n in sorted(QUERIES) if not n.endswith(STREAMED) and n != "stream_entries"]


@pytest.mark.parametrize("name", BATCH)
def test_plan(spark, name):
    """No cross joins, and no sort or window of a whole stream in one task."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    for line in plan.splitlines():
        if "row_number()" in line and "Window [" in line:
            assert "_span" in line
