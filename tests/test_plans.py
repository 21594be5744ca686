"""Plan properties every registered query must keep (checked on sf0.001)."""

import re

import pytest

from tessera.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_blowup_and_pruned_scans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN:
        assert node not in plan, f"{name} plans a {node}"
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        # no scan reads every column of the wide text tables
        assert "html" not in schema and not ("text" in schema and "source" in schema), schema


def test_spatial_join_does_not_shuffle_incidents(spark):
    plan = QUERIES["income_crime_per_capita"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scan_line = [ln for ln in plan.splitlines() if "orders.parquet" in ln][0]
    assert "struct<o_orderkey:bigint>" in plan and "BroadcastHashJoin" in plan
    assert scan_line  # the incident scan feeds a broadcast probe, then a partial aggregate
    assert "partial_count" in plan
