"""All derived tables from typed source tables on disk."""

import pytest
from pyspark.sql import functions as F

from patronlens.operators import lookup
from patronlens.plans.jobs import JOBS, Run
from patronlens.sources import tables
from patronlens.sources.standins import StandIns
from patronlens.sources.typed import TypedSources


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """The stand-in tables, turned to text as the raw tables are, then typed at the door."""
    folder = str(tmp_path_factory.mktemp("typed"))
    x = StandIns(spark, "/root/testdata/sf0.001")
    brands = F.element_at(F.array(*[F.lit(b) for b in ("卡萨帝", "MOOKA", "KFR", "统帅", "海尔", "摩卡")]), (F.length("productName") % 6 + 1).cast("int"))
    unix = lambda c: F.unix_timestamp(F.col(c).cast("timestamp")).cast("string")
    raw = {
        "tbl_users": x.users.drop("region_key").withColumns({"registerTime": unix("registerTime"), "lastLoginTime": unix("lastLoginTime")}),
        "tbl_orders": x.orders.withColumns({"finishTime": unix("finishTime"), "giftCardAmount": F.lit("0.5"), "productAmount": F.col("orderAmount") / F.lit(0.96)}),
        "tbl_goods": x.goods.drop("giftCardAmount", "productAmount").withColumn("productName", F.concat(brands, F.lit(" "), "productName")),
        "tbl_logs": x.logs,
        "regions": x.users.select(F.left("mobile", F.lit(7)).alias("region_key")).distinct().withColumns({"province": F.lit("北京"), "city": F.lit("海淀")}),
    }
    for name, frame in raw.items():
        text = frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])
        tables.conform(text, name).write.parquet(f"{folder}/{name}")
    return TypedSources(spark, folder)


def test_every_table_is_built_and_keyed(spark, sources, tmp_path_factory):
    run = Run(sources, str(tmp_path_factory.mktemp("out")), "2024-01-31", shift_days=0)
    for name in JOBS:
        run.write(name)
    for name, job in JOBS.items():
        table = run.table(name)
        assert table.count() > 0, name
        assert table.groupBy(*job.key).count().filter("count > 1").count() == 0, name
    assert run.table("user").columns == [
        "id", "username", "gender", "email", "mobile", "province", "city", "birthday", "log_recent", "log_f", "job",
        "politicalFace", "nationality", "marriage", "age", "constellation", "is_blackList",
    ]
    assert {r[0] for r in run.table("user").select("city").distinct().collect()} == {"海淀"}
    members = sources.done.select("memberId").distinct().count()
    assert run.table("consumer").count() == members
    spend = run.table("Amount_city").first()["amount"]
    known = run.table("user").select(F.col("id").alias("memberId"))
    total = sources.done.join(known, "memberId", "left_semi").agg(F.sum("orderAmount")).first()[0]
    assert spend == int(total)
    one = run.table("user").first()
    for contact in (one["email"], one["mobile"]):
        found = lookup.by_contact(run.table("user"), contact)
        assert [r["id"] for r in found.collect()] == [one["id"]]
        column = "email" if "@" in contact else "mobile"
        assert f"EqualTo({column},{contact})" in found._jdf.queryExecution().executedPlan().toString()
    brands = {"海尔", "卡萨帝", "摩卡", "小超人", "统帅", "无偏好", "age"}
    assert set(run.table("Brand_age").columns) == brands


def test_suffix_keys(spark, sources):
    merged = TypedSources(spark, sources.directory, suffix_keys=True).orders.select("memberId").distinct()
    assert merged.count() <= 1000 and merged.filter("memberId >= 1000").count() == 0


def test_orders_of_nobody_stop_the_run(sources, tmp_path):
    stranger = TypedSources(sources.spark, sources.directory)
    stranger.orders = sources.orders.withColumn("memberId", F.col("memberId") + 10**10)
    with pytest.raises(ValueError, match="suffix-keys"):
        Run(stranger, str(tmp_path), "2024-01-31").write("Amount_job")
