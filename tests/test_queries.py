import pytest

import __spark_entry__ as entry
from tessera.plans.queries import ORACLE_SQL, QUERIES

from .conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, same, name):
    same(QUERIES[name](spark, SMALL), ORACLE_SQL[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_pushdown(spark):
    plan = QUERIES["filter_pushdown"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity" in plan and "l_comment" not in plan


def test_top_k_is_cut_before_the_shuffle_of_ranks(spark):
    plan = QUERIES["block_topk"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
