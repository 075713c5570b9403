"""The four source tables and the region dimension, read from typed Parquet tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.functions.keys import member_key
from patronlens.operators.orders import completed
from patronlens.sources import tables

MOBILE_PREFIX = 7  # digits of a mobile number that tell its area


class TypedSources:
    """Lazy frames over ``directory/tbl_users``, ``tbl_orders``, ``tbl_goods``, ``tbl_logs``, ``regions``.

    ``suffix_keys`` reduces member numbers to their last three digits, which is how
    the raw order numbers name a user; members sharing a suffix are then one.
    """

    def __init__(self, spark: SparkSession, directory: str, suffix_keys: bool = False):
        self.spark = spark
        self.directory = directory
        self.suffix_keys = suffix_keys

    @cached_property
    def users(self) -> DataFrame:
        users = tables.read(self.spark, self.directory, "tbl_users").drop("modified")
        return users.withColumn("region_key", F.left("mobile", F.lit(MOBILE_PREFIX)))

    @cached_property
    def orders(self) -> DataFrame:
        orders = tables.read(self.spark, self.directory, "tbl_orders")
        if not self.suffix_keys:
            return orders
        return orders.withColumn("memberId", member_key("memberId").cast("bigint"))

    @cached_property
    def done(self) -> DataFrame:
        return completed(self.orders)

    @cached_property
    def goods(self) -> DataFrame:
        return tables.read(self.spark, self.directory, "tbl_goods").drop("id", "points")

    @cached_property
    def logs(self) -> DataFrame:
        return tables.read(self.spark, self.directory, "tbl_logs")

    @cached_property
    def regions(self) -> DataFrame:
        return tables.read(self.spark, self.directory, "regions")
