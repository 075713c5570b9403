"""Histories from lines that name products by key: the same rows, without names in the shuffles of the lines."""

import pytest
from compare import SMALL

from patronlens.operators import baskets
from patronlens.plans.queries import QUERIES
from patronlens.sources.standins import StandIns


def test_keys_and_names_give_equal_rows(spark):
    x = StandIns(spark, SMALL)
    # Keys that share type and name, lines of no known product, and a key that is listed twice.
    products = x.products.selectExpr("productId", "productType", "substring(productName, 1, 6) AS productName").where("productId % 11 <> 0")
    products = products.unionByName(products.where("productId % 7 = 0"))
    goods = x.product_lines.join(products, "productId").drop("productId")
    named = baskets.purchase_history(x.orders, goods, part_size=3)
    keyed = baskets.purchase_history(x.orders, x.product_lines, part_size=3, products=products)
    assert sorted(map(repr, keyed.collect())) == sorted(map(repr, named.collect())) != []


@pytest.mark.parametrize("name", ["purchase_history", "purchase_history_parts"])
def test_lines_are_shuffled_without_names(spark, monkeypatch, name):
    plans = []
    settle = baskets.settle
    monkeypatch.setattr(baskets, "settle", lambda rows: plans.append(rows) or settle(rows))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        QUERIES[name](spark, SMALL)
        node = plans[0]._jdf.queryExecution().sparkPlan()
        joins = [str(j.nodeName()) + j.output().toString() for j in _nodes(node) if "Join" in str(j.nodeName())]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(joins) == 2 and "productName" in joins[0] and "productName" not in joins[1] and "p_name" not in joins[1]


def _nodes(node):
    yield node
    for i in range(node.children().size()):
        yield from _nodes(node.children().apply(i))
