import pytest

from lakeloom.llm.queries import ORACLE_SQL, QUERIES

from ..oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    compare(spark, connect(SF), QUERIES[name], ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", ["op5_line_dedup", "op7_chat_rotation"])
def test_native_operators_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
