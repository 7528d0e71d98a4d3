"""Every registered query against its DuckDB oracle at sf0.01, and without Python or pairwise joins in its plan."""

import pytest

from __spark_entry__ import ORACLES, QUERIES, entry
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.01"
UNWANTED = ["EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [operator for operator in UNWANTED if operator in plan] == []
    assert differences(df, con, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
