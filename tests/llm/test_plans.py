"""Plan properties of the operators' queries (checked on sf0.001)."""

import re

import pytest

from tessera.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
OPERATORS = sorted(q for q in QUERIES if q != "pipeline")


@pytest.mark.parametrize("name", OPERATORS)
def test_no_pair_blowup_and_pruned_scans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "source" not in schema or "text" not in schema, schema


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    from tests.oracle_check import compare, duck

    ok, why = compare(spark, duck(SF), name, SF, QUERIES[name], ORACLE_SQL[name])
    assert ok, why
