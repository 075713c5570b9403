"""The bundled test tables seen as users, orders, order lines, page views and regions."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOGS_AS_OF = "2024-01-31"
ORDERS_AS_OF = "2001-08-02"

# Stated rather than inferred: inference would cost a job per table and query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


class StandIns:
    """Lazy typed frames over one directory of test tables."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.directory}/{name}.parquet")

    @cached_property
    def users(self) -> DataFrame:
        key = F.col("c_custkey")
        code = lambda c, n: (F.col(c) % n).cast("string")
        return self._table("customer").select(
            key.alias("id"),
            F.col("c_name").alias("username"),
            code("c_custkey", 3).alias("gender"),
            F.concat(F.lower("c_mktsegment"), key.cast("string"), F.lit("@example.com")).alias("email"),
            F.concat(F.lit("13"), F.lpad(key.cast("string"), 9, "0")).alias("mobile"),
            code("c_nationkey", 8).alias("job"),
            code("c_custkey", 5).alias("politicalFace"),
            code("c_nationkey", 6).alias("nationality"),
            code("c_custkey", 4).alias("marriage"),
            F.date_add(F.lit("1950-01-01").cast("date"), (key * 37 % 27000).cast("int")).alias("birthday"),
            F.date_add(F.lit("2015-01-01").cast("date"), (key % 1000).cast("int")).alias("registerTime"),
            F.lit(LOGS_AS_OF).cast("date").alias("lastLoginTime"),
            F.when(F.col("c_acctbal") < 0, "1").otherwise("0").alias("is_blackList"),
            F.col("c_nationkey").alias("region_key"),
        )

    def _orders(self, raw: DataFrame) -> DataFrame:
        status = (
            F.when(F.col("o_orderstatus") == "F", "202")
            .when(F.col("o_orderstatus") == "O", "1")
            .otherwise("0")
        )
        return raw.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("memberId"),
            F.col("o_orderkey").cast("string").alias("orderSn"),
            status.alias("orderStatus"),
            F.col("o_orderpriority").alias("paymentName"),
            F.col("o_orderdate").alias("modified"),
            F.col("o_orderdate").alias("finishTime"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("orderAmount"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders(self._table("orders"))

    @cached_property
    def done(self) -> DataFrame:
        """Completed orders, with the status test written so that it reaches the scan."""
        return self._orders(self._table("orders").filter(F.col("o_orderstatus") == "F"))

    @cached_property
    def goods(self) -> DataFrame:
        # The part table grows with the data: which join to use is left to its measured size.
        lines = self._table("lineitem").join(
            self._table("part"), F.col("l_partkey") == F.col("p_partkey")
        )
        return lines.select(
            F.col("l_orderkey").cast("string").alias("cOrderSn"),
            F.col("p_type").alias("productType"),
            F.col("p_name").alias("productName"),
            F.col("l_discount").cast("decimal(4,2)").alias("couponAmount"),
            F.col("l_tax").cast("decimal(4,2)").alias("giftCardAmount"),
            F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("activityPrice"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("productAmount"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").alias("productId"), F.col("p_type").alias("productType"), F.col("p_name").alias("productName")
        )

    @cached_property
    def product_lines(self) -> DataFrame:
        """Order lines that name their product by its key."""
        return self._table("lineitem").select(F.col("l_orderkey").cast("string").alias("cOrderSn"), F.col("l_partkey").alias("productId"))

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines without their product, for labels that need none."""
        return self._table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("cOrderSn"),
            F.col("l_discount").cast("decimal(4,2)").alias("couponAmount"),
            F.col("l_tax").cast("decimal(4,2)").alias("giftCardAmount"),
            F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("activityPrice"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("productAmount"),
        )

    @cached_property
    def orders_with_card(self) -> DataFrame:
        """Orders that keep their gift card themselves: every fourth has one."""
        card = F.when(F.col("id") % 4 == 0, F.lit("5.00")).otherwise("0.00").cast("decimal(18,2)")
        return self.orders.withColumn("giftCardAmount", card)

    @cached_property
    def orders_listed(self) -> DataFrame:
        """Completed orders that have lines, with list amount and paid amount summed over these."""
        return self.listed(self.lines.groupBy("cOrderSn").agg(*self.listed_sums()))

    @staticmethod
    def listed_sums() -> list[Column]:
        paid = F.col("productAmount") * (1 - F.col("couponAmount"))
        return [F.sum("productAmount").alias("productAmount"), F.sum(paid).alias("orderAmount")]

    def listed(self, sums: DataFrame) -> DataFrame:
        """Completed orders with the ``listed_sums`` of their lines."""
        kept = self.done.drop("orderAmount")
        sums = sums.select("cOrderSn", "productAmount", "orderAmount")
        return kept.join(sums, F.col("orderSn") == F.col("cOrderSn")).drop("cOrderSn")

    @cached_property
    def logs(self) -> DataFrame:
        event = F.col("event_id")
        kind = F.col("event_type")
        url = (
            F.when(kind == "view", F.concat(F.lit("/product/"), (event % 40).cast("string"), F.lit(".html")))
            .when(kind == "click", "/item/list")
            .when(kind == "signup", "/login")
            .when(kind == "purchase", "/order/mine")
            .otherwise("/index")
        )
        agents = ["Linux; Android 9", "iPhone OS", "Windows WOW64", "X11; Linux", "Macintosh"]
        return self._table("events").select(
            event.alias("id"),
            F.col("user_id").alias("global_user_id"),
            F.get(F.array(*[F.lit(a) for a in agents]), (event % 5).cast("int")).alias("user_agent"),
            url.alias("loc_url"),
            F.col("ts").alias("log_time"),
        )

    @cached_property
    def regions(self) -> DataFrame:
        nation, region = self._table("nation"), self._table("region")
        joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.select(
            F.col("n_nationkey").alias("region_key"),
            F.col("r_name").alias("province"),
            F.col("n_name").alias("city"),
        )

    @cached_property
    def provinces(self) -> DataFrame:
        return self._table("region").select(F.col("r_name").alias("map_name"))

    @cached_property
    def prefixes(self) -> DataFrame:
        """Areas of mobile numbers by prefixes of three lengths, nested in one another."""
        begin = lambda c, n: F.concat(F.lit("13"), F.lpad(F.col(c).cast("string"), n, "0")).alias("region_key")
        named = lambda rows, c, n, province, city: rows.select(
            begin(c, n), F.col(province).alias("province"), F.col(city).alias("city")
        )
        nation, region = self._table("nation"), self._table("region")
        wide = named(region, "r_regionkey", 6, "r_name", "r_name")
        narrow = named(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")), "n_nationkey", 7, "r_name", "n_name")
        offices = self._table("supplier").where("s_suppkey % 3 = 0").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        return wide.unionByName(narrow).unionByName(named(offices, "s_suppkey", 8, "n_name", "s_name"))

    @cached_property
    def orders_as_text(self) -> DataFrame:
        """Orders as text, some values of which can't be read."""
        key, text = F.col("o_orderkey"), lambda c: F.col(c).cast("string")
        seconds = (F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")).cast("bigint") * 86400).cast("string")
        money = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
        return self._table("orders").select(
            text("o_orderkey").alias("id"),
            F.when(key % 5 == 0, F.concat(F.lit("x"), text("o_custkey"))).otherwise(text("o_custkey")).alias("memberId"),
            text("o_orderstatus").alias("orderStatus"),
            F.when(key % 7 == 0, "soon").when(key % 7 != 1, seconds).alias("finishTime"),
            F.when(key % 3 == 0, F.concat(money, F.lit(" EUR"))).otherwise(money).alias("orderAmount"),
            F.when(key % 11 == 0, "1998-02-30 00:00:00").otherwise("1998-02-28 00:00:00").alias("modified"),
        )
