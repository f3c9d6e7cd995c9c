"""Queries of the llm part: against their SQL, and that each runs on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from oracle_check import connect, differences

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = contract.LLM_QUERIES, contract.LLM_ORACLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted({n.split("_")[0] for n in QUERIES}) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == ""


@pytest.mark.parametrize("name", ["op3_license_scan", "op7_line_rules", "op10_chat_format", "op13_pareto_mix"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "Pandas" not in plan
