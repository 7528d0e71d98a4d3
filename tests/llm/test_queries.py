"""Registered queries that SQL can express, against their oracles; all of them are registered."""

import re

import pytest

from __spark_entry__ import LLM_ORACLES, LLM_QUERIES
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_oracle(spark, name):
    assert differences(LLM_QUERIES[name](spark, SF_DIR), connect(SF_DIR), LLM_ORACLES[name]) is None


def test_thirteen_operators_and_the_pipeline():
    numbers = sorted(int(m[1]) for m in (re.match(r"op(\d+)_", n) for n in LLM_QUERIES) if m)
    assert numbers == list(range(1, 14)) and "pipeline" in LLM_QUERIES


@pytest.mark.parametrize("name", ["op6_preference", "op8_quality_ledger"])
def test_native_queries_run_no_python(spark, name):
    plan = LLM_QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("EvalPython|InPandas|InArrow|Cartesian|NestedLoop", plan)
