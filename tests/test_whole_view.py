"""The whole view counts its lines once; preview, preference and titles are as they are on their own."""

import pytest
from compare import SMALL

from patronlens.operators import baskets, segment, sequence
from patronlens.plans import queries
from patronlens.plans.queries import QUERIES
from patronlens.sources.standins import StandIns


def rows(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("bound", [0, 5, 200_000])
def test_preview_and_preference_equal_those_on_their_own(spark, monkeypatch, bound):
    x = StandIns(spark, SMALL)
    preview, preference = rows(baskets.basket_preview(x.done, x.goods, x.users)), rows(baskets.product_preference(x.done, x.goods))
    monkeypatch.setattr(sequence, "STRETCH", bound)
    both = baskets.preview_and_preference(x.done, x.goods, x.users, lines=x.lines)
    assert [rows(f) for f in both] == [preview, preference] and preview and preference


def test_nulls_and_ties(spark):
    orders = spark.createDataFrame([(f"{i}", m, "202", d) for i, m, d in ((1, 7, "2020-01-01"), (2, 7, None), (3, None, "2020-01-01"), (4, 8, "2020-01-01"))], "orderSn string, memberId long, orderStatus string, modified string")
    orders = orders.withColumn("modified", orders.modified.cast("timestamp_ntz"))
    goods = spark.createDataFrame([("1", t, p) for t, p in ((None, "b"), ("x", None), ("y", "b"), ("x", "a"), ("z", "c"), (None, None))] + [("2", "x", "a"), ("3", "x", "a"), ("4", None, None)], "cOrderSn string, productType string, productName string")
    users = spark.createDataFrame([(7,), (8,), (9,)], "id long")
    alone = [rows(baskets.basket_preview(orders, goods, users)), rows(baskets.product_preference(orders, goods))]
    assert [rows(f) for f in baskets.preview_and_preference(orders, goods, users)] == alone
    assert len(alone[0]) == 3 and len(alone[1]) == 1


def test_titles_from_one_pass_equal_those_of_their_scores(spark):
    x = StandIns(spark, SMALL)
    apart = segment.user_titles(
        x.users, segment.discount_segment(queries._discount_scores(x)), segment.coupon_segment(queries._coupon_scores(x, *queries.COUPON_CUTS))
    )
    assert rows(QUERIES["user_titles"](spark, SMALL)) == rows(apart) != []


def test_products_are_read_once(spark, monkeypatch):
    joins = []
    plain = baskets.split_join
    monkeypatch.setattr(baskets, "split_join", lambda *a: joins.append(a) or plain(*a))
    QUERIES["customer_360"](spark, SMALL)
    assert len(joins) == 1
