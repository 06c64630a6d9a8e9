"""Every catalogue query against its SQL, on whole tables."""

import pytest

from rasterloom.plans import catalogue
from tests.conftest import SF
from tests.oracle import connect, same

SQL = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


#: Joins with a table of fixed size: one row, the prompt bank.
SMALL_SIDE = {"q_distance_rgb", "q_prompt_logits", "q_topk_mean_logits", "q_softmax", "q_collapse_max", "q_collapse_sum", "q_stable_rank", "q_margin", "q_prefer_structures", "q_mostly_hybrid"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan or name in SMALL_SIDE
    same(df, duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert catalogue.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
