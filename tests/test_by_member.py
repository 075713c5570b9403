"""Members that one task may hold are shuffled once; larger ones give the same rows in stretches."""

import pytest
from compare import SMALL

from patronlens.operators import baskets, sequence
from patronlens.plans.queries import QUERIES
from patronlens.sources.standins import StandIns

OPERATORS = {
    "purchase_history": lambda x: baskets.purchase_history(x.orders, x.goods, lines=x.lines),
    "purchase_history_parts": lambda x: baskets.purchase_history(x.orders, x.goods, part_size=5),
    "weekly_basket": lambda x: baskets.weekly_basket(x.done, x.goods, x.users, part_size=3),
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("bound", [0, 3, 60])
def test_small_and_large_members_give_equal_rows(spark, monkeypatch, name, bound):
    x = StandIns(spark, SMALL)
    expected = sorted(map(repr, OPERATORS[name](x).collect()))
    monkeypatch.setattr(sequence, "STRETCH", bound)
    monkeypatch.setattr(sequence, "GROUPINGS", 97 if bound == 60 else 1 << 16)
    assert sorted(map(repr, OPERATORS[name](x).collect())) == expected != []


def test_groups_above_the_bound_are_found(spark):
    rows = spark.createDataFrame([(m, i) for m, n in ((1, 5), (2, 6), (None, 7), (3, 1)) for i in range(n)], "m long, i int")
    few, many = sequence.split_by_size(rows, "m", bound=5)
    assert {r.m for r in few.collect()} == {1, 3} and {r.m for r in many.collect()} == {2, None}
    assert few.count() + many.count() == rows.count()
    assert sequence.split_by_size(rows, "m", bound=7)[1] is None


@pytest.mark.parametrize("name", ["purchase_history", "purchase_history_parts"])
def test_counts_are_shuffled_once(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(memberId") <= 2  # one in each branch, run once
