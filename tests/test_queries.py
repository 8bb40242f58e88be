import pytest

import __spark_entry__
from lakeloom.plans import customers, foundations, inventory, logs, operations, orders, registry  # noqa: F401

from .oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL) and len(registry.QUERIES) > 100


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    compare(spark, con, registry.QUERIES[name], registry.ORACLE_SQL[name], SF)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(__spark_entry__.queries())


#: They join with one row, or a handful of regions.
ONE_ROW = {
    "j12_scalar_subquery", "s8_incremental_state", "s21_append_since", "s22_migrate_merge", "s27_newest_batch",
    "j8_exact_or_any", "b6_explode_bundle", "b49_segment_quota", "s26_audit_row"
}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - ONE_ROW - {"m1_stream_state", "m3_message_dedup", "m4_windowed_counts"}))
def test_plans_have_no_nested_loops(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
