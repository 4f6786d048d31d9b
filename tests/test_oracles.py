"""Every registered query: its plan, and its result against the DuckDB oracle."""

import re

import pytest

from checks import ORACLES, QUERIES
from checks.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_oracle(spark, con, key):
    assert key in ORACLES
    df = QUERIES[key](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert compare(spark, con, SF_DIR, key, df) == ""
