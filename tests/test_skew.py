"""One order with a third of all lines: equal results, and no task that holds it."""

import statistics

import pytest
from compare import SMALL
from pyspark.sql import functions as F

from patronlens.operators import baskets, skew
from patronlens.sources.standins import StandIns

HOT = "1"


@pytest.fixture()
def fixed_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Hot(StandIns):
    """The tables with a third of all lines in one order."""

    @property
    def goods(self):
        hot = F.when(F.xxhash64("productName", "activityPrice", "productAmount") % 3 == 0, F.lit(HOT)).otherwise(F.col("cOrderSn"))
        return super().goods.withColumn("cOrderSn", hot)


def test_heavy_keys_are_found(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, HOT).when(F.col("id") % 50 == 1, "warm").otherwise(F.concat(F.lit("k"), "id")).alias("k"))
    assert set(skew.heavy_keys(rows, "k", 100)) == {HOT, "warm"}
    assert skew.heavy_keys(rows, "k", 2) == []
    assert skew.heavy_keys(rows.limit(0), "k", 8) == [] == skew.heavy_keys(rows.select(F.lit(None).cast("string").alias("k")), "k", 8)


def test_no_task_holds_the_hot_order(spark, fixed_partitions):
    x = Hot(spark, SMALL)
    assert skew.heavy_keys(x.goods, "cOrderSn", 32) == [HOT]
    joined = baskets.purchased_lines(x.orders, x.goods)
    tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == 8 and max(tasks) <= 2 * statistics.median(tasks)
    plain = x.goods.join(x.orders.select("orderSn"), F.col("cOrderSn") == F.col("orderSn"))
    assert max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()) > 2 * statistics.median(tasks)


QUERIES = {
    "product_preference": lambda x: baskets.product_preference(x.done, x.goods),
    "weekly_basket": lambda x: baskets.weekly_basket(x.done, x.goods, x.users),
    "basket_preview": lambda x: baskets.basket_preview(x.done, x.goods, x.users),
    "purchase_history": lambda x: baskets.purchase_history(x.orders, x.goods),
}


@pytest.mark.parametrize("name", QUERIES)
def test_split_and_plain_join_give_equal_rows(spark, monkeypatch, name):
    x = Hot(spark, SMALL)
    split = sorted(map(repr, QUERIES[name](x).collect()))
    monkeypatch.setattr(skew, "heavy_keys", lambda *_: [])
    assert split == sorted(map(repr, QUERIES[name](x).collect())) != []


def test_repeated_and_unmatched_rows(spark, monkeypatch):
    lines = spark.createDataFrame([("a", 1)] * 40 + [("b", 2), (None, 3), ("z", 4)], "k string, v int")
    narrow = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", "x"), (None, "n")], "s string, w string")
    found = sorted(tuple(r) for r in skew.split_join(lines, narrow, "k", "s").collect())
    assert skew.heavy_keys(lines, "k", 32) == ["a"]
    assert found == sorted([("a", 1, "a", w) for w in "xy" for _ in range(40)] + [("b", 2, "b", "x")])
