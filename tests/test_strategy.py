import pytest
from pyspark.sql import functions as F

from tessera.operators import broadcast_if_bounded, physical_join_nodes, strategy_sweep, with_strategy
from tessera.plans import city_model as cm, registry, reports

SF = "/root/testdata/sf0.001"


def test_hints_select_join_operator(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = spark.range(5000).withColumnRenamed("id", "k")
        small = spark.range(50).withColumnRenamed("id", "k")
        expect = {"BROADCAST": "BroadcastHashJoin", "MERGE": "SortMergeJoin", "SHUFFLE_HASH": "ShuffledHashJoin"}
        for hint, node in expect.items():
            assert node in physical_join_nodes(big.join(with_strategy(small, hint), "k"))
        assert with_strategy(small, "") is small
        with pytest.raises(ValueError):
            with_strategy(small, "SHUFFLE_REPLICATE_NL")
        with pytest.raises(ValueError):
            with_strategy(small, "NESTED")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_broadcast_if_bounded(spark):
    small = spark.range(10)
    assert "ResolvedHint" in broadcast_if_bounded(small, 10)._jdf.queryExecution().analyzed().toString() \
        or "broadcast" in broadcast_if_bounded(small, 10)._jdf.queryExecution().analyzed().toString().lower()
    assert broadcast_if_bounded(small, 9) is small


def test_strategy_sweep_same_answer(spark):
    sweep = strategy_sweep(lambda a, b: registry.reports.income_crime_report(
        cm.census_blocks(spark, SF), cm.income(spark, SF), cm.incidents(spark, SF), registry.CITY,
        x="lon", y="lat", income_strategy=a, spatial_strategy=b, cell_size=20.0))
    answers = {k: sorted(tuple(r) for r in v.collect()) for k, v in sweep.items()}
    first = next(iter(answers.values()))
    assert len(answers) == 9 and all(a == first for a in answers.values())


def test_incident_scan_is_pruned(spark):
    df = registry.q_points_in_blocks(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "struct<o_orderkey:bigint>" in plan  # only the key column is read from orders


def test_sql_hint_selects_shuffled_hash_join(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        registry.q_top_k_in_group_sql(spark, SF)  # registers the views
        hinted = reports.top_paid_in_department_sql(spark, "tessera_employees", "tessera_departments", registry.DEPARTMENT, 3, "SHUFFLE_HASH")
        assert "ShuffledHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
