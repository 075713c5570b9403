"""The derived tables as jobs: build each from the sources and write it by key.

    python -m patronlens.plans.jobs --sources DIR --out DIR --as-of 2024-01-31 [--tables user,cycle]

``--sources`` holds the typed source tables as Parquet. A table that feeds others is
written first and read back, so it is computed once.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.functions import rules
from patronlens.operators import activity, baskets, lineage, lookup, orders, profile, recommend, reports, segment
from patronlens.sources import tables
from patronlens.sources.typed import TypedSources

BRAND_LABELS = [rules.HOUSE_BRAND, *[label for _, label in rules.BRANDS if label != rules.HOUSE_BRAND], rules.BRAND_NONE]
CONTACTS = ("email", "mobile")


class Job(NamedTuple):
    build: Callable[["Run"], DataFrame]
    key: list[str]
    needs: list[str]
    lookups: tuple[str, ...] = ()
    owner: str | None = None  # whose rows are replaced together


class Run:
    """One pass over the sources with a fixed reference day and an output folder."""

    def __init__(self, sources, out: str, as_of: str, mode: str = "overwrite", shift_days: int = rules.RECENCY_SHIFT_DAYS):
        self.sources = sources
        self.out = out
        self.as_of = as_of
        self.mode = mode
        self.shift_days = shift_days
        self.written: set[str] = set()
        self.members_known = False

    def check_members(self) -> None:
        """Stop before tables come out empty: some member number of the orders must be a user's id."""
        if self.members_known:
            return
        users, orders_ = self.sources.users.select("id"), self.sources.orders.select(F.col("memberId").alias("id"))
        if users.join(orders_.where("id IS NOT NULL"), "id", "left_semi").isEmpty() and not orders_.isEmpty():
            raise ValueError(
                "no member number of the orders is the id of a user; raw numbers name users by their last digits: try --suffix-keys"
            )
        self.members_known = True

    def table(self, name: str) -> DataFrame:
        """A derived table, written by this run if it was not yet."""
        self.write(name)
        return self.sources.spark.read.parquet(f"{self.out}/{name}")

    def write(self, name: str) -> None:
        if name in self.written:
            return
        job = JOBS[name]
        if name in BY_MEMBER:
            self.check_members()
        for needed in job.needs:
            self.write(needed)
        tables.write(job.build(self), f"{self.out}/{name}", job.key, self.mode, unique=True, lookups=job.lookups, owner=job.owner)
        if name == "user":
            lookup.contact_index(self.sources.spark, f"{self.out}/contacts").replace(lookup.contacts_of(self.sources.spark.read.parquet(f"{self.out}/user")))
        self.written.add(name)


def _consumer_rfm(run: Run) -> DataFrame:
    metrics = orders.rfm_metrics(run.sources.orders, run.as_of, run.shift_days)
    return segment.rfm_segment(orders.rfm_scores(metrics))


def _titled(segmented: DataFrame, name: str) -> DataFrame:
    return segmented.select(F.col("memberId").alias("id"), F.col("value").alias(name))


def _user_title(run: Run) -> DataFrame:
    as_segment = lambda table, name: run.table(table).select(F.col("id").alias("memberId"), F.col(name).alias("value"))
    return segment.user_titles(run.table("user"), as_segment("consumer_anas", "thrift"), as_segment("consumer_ana1", "coupon"))


def _spend(dim: str) -> Callable[[Run], DataFrame]:
    return lambda run: reports.spend_by(run.sources.done, run.table("user"), dim)


def _value(*dims: str, truncate: bool = False) -> Callable[[Run], DataFrame]:
    return lambda run: reports.value_by(run.table("user"), run.table("consumer_rfm"), dims, truncate)


def _brand_age(run: Run) -> DataFrame:
    preference = baskets.brand_preference(run.sources.done, run.sources.goods)
    return reports.brand_by_age(run.table("user"), preference, BRAND_LABELS)


JOBS: dict[str, Job] = {
    "user": Job(
        lambda r: profile.user_profile(r.sources.users, r.sources.logs, r.sources.regions, r.as_of),
        ["id"], [], CONTACTS,
    ),
    "consumer_rfm": Job(_consumer_rfm, ["memberId"], []),
    "consumer": Job(
        lambda r: orders.consumer_profile(r.sources.orders, r.table("consumer_rfm")), ["memberId"], ["consumer_rfm"]
    ),
    "consumer_ana1": Job(
        lambda r: _titled(segment.coupon_segment(baskets.coupon_scores(r.sources.orders, r.sources.goods)), "coupon"),
        ["id"], [],
    ),
    "consumer_anas": Job(
        lambda r: _titled(segment.discount_segment(baskets.discount_scores(r.sources.done)), "thrift"),
        ["id"], [],
    ),
    "usertitle": Job(_user_title, ["id"], ["user", "consumer_ana1", "consumer_anas"]),
    "scantime": Job(lambda r: activity.browse_slots(r.sources.logs), ["user_id", "slot"], []),
    "log_job": Job(lambda r: activity.slot_by_job(r.sources.logs, r.table("user")), ["job", "slot"], ["user"]),
    "pre_product": Job(lambda r: baskets.product_preference(r.sources.done, r.sources.goods), ["memberId"], []),
    "cycle": Job(
        lambda r: baskets.weekly_basket(r.sources.done, r.sources.goods, r.table("user")),
        ["id", "cycle", "part"], ["user"], CONTACTS, "id",
    ),
    "agegender": Job(_value("age", "gender"), ["age", "gender"], ["user", "consumer_rfm"]),
    "provincerf": Job(_value("province", truncate=True), ["province"], ["user", "consumer_rfm"]),
    "Amount_city": Job(_spend("city"), ["city"], ["user"]),
    "Amount_job": Job(_spend("job"), ["job"], ["user"]),
    "Amount_Constellation": Job(_spend("constellation"), ["constellation"], ["user"]),
    "Brand_age": Job(_brand_age, ["age"], ["user"]),
    "ALS_favorProducts": Job(
        lambda r: recommend.recommend(recommend.product_ratings(r.sources.logs), "product", rules.TOP_PRODUCTS),
        ["id"], [],
    ),
    "ALS_favorBrand": Job(
        lambda r: recommend.recommend(
            baskets.brand_ratings(r.table("user"), r.sources.orders, r.sources.goods), "brand", rules.TOP_BRANDS
        ),
        ["id"], ["user"],
    ),
    "log_scan": Job(lambda r: activity.browse_history(r.sources.logs), ["user_id", "part"], [], owner="user_id"),
    "log_consumer": Job(
        lambda r: baskets.purchase_history(r.sources.orders, r.sources.goods), ["memberId", "part"], [], owner="memberId",
    ),
}


BY_MEMBER = {
    "usertitle", "cycle", "agegender", "provincerf", "Amount_city", "Amount_job", "Amount_Constellation", "Brand_age",
    "ALS_favorBrand",
}  # tables that join orders to users


def main() -> None:
    parser = argparse.ArgumentParser(description="Build derived profile tables.")
    parser.add_argument("--sources", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--as-of", required=True, help="reference day, yyyy-mm-dd")
    parser.add_argument("--tables", default=",".join(JOBS))
    parser.add_argument("--mode", default="overwrite", choices=["errorifexists", "overwrite", "append", "upsert"])
    parser.add_argument("--suffix-keys", action="store_true", help="members by the last three digits of their number")
    parser.add_argument("--time-zone", default="UTC", help="zone of hours, days and weeks")
    options = parser.parse_args()
    spark = (
        SparkSession.builder.appName("profile-tables")
        .config("spark.sql.session.timeZone", options.time_zone)
        # An order with very many lines is split in the joins that need the product of each line.
        .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
        .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64m")
        .getOrCreate()
    )
    run = Run(TypedSources(spark, options.sources, options.suffix_keys), options.out, options.as_of, options.mode)
    try:
        for name in options.tables.split(","):
            run.write(name)
    finally:
        lineage.clear(spark)
        spark.stop()


if __name__ == "__main__":
    main()
