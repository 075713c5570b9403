"""Order labels that are kept up to date without reading the history again.

All that the labels need of a member's orders are counts, sums, extremes, bits for the days
and counts by payment name. These are one row a member, and rows of different parts of the
orders merge into that of both. The state lies in buckets by member: a new day of orders is aggregated and
joined to it, the state itself is not moved, and the orders before are not read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.operators.orders import _facts, _folding, _with_days, labels_of_facts
from patronlens.sources.tables import BucketedTable

NOBODY = -(2**63)  # stands for a missing member number, which joins like any other


def _all_facts() -> dict[str, Column]:
    more = {"finished": F.max("finishTime"), "numbered": F.count("orderSn"), "spent": F.sum("orderAmount")}
    return _facts("dayofyear") | more


def state_of(orders: DataFrame) -> DataFrame:
    """One row per member: (member, facts..., payments), payments counting completed orders by name."""
    facts = _all_facts()
    per_payment = orders.groupBy("memberId", "paymentName").agg(*[c.alias(n) for n, c in facts.items()])
    used = F.when((F.col("done") > 0) & F.col("paymentName").isNotNull(), F.struct("paymentName", "done"))
    return per_payment.groupBy(F.coalesce("memberId", F.lit(NOBODY)).alias("member")).agg(
        *[_folding(n)(n).alias(n) for n in facts], F.map_from_entries(F.collect_list(used)).alias("payments")
    )


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """The state of all orders behind ``old`` and ``new``, which must not share an order."""
    facts = [c for c in old.columns if c not in ("member", "payments")]

    def both(fact: str) -> Column:
        a, b = F.col(f"a.{fact}"), F.col(f"b.{fact}")
        kind = _folding(fact)
        if kind is F.min:
            return F.least(a, b)
        if kind is F.max:
            return F.greatest(a, b)
        together = a.bitwiseOR(b) if kind is F.bit_or else a + b
        return F.coalesce(together, a, b)

    empty = F.create_map().cast("map<string,bigint>")
    payments = F.map_zip_with(
        F.coalesce("a.payments", empty), F.coalesce("b.payments", empty), lambda _, m, n: F.coalesce(m, F.lit(0)) + F.coalesce(n, F.lit(0))
    )
    joined = old.alias("a").join(new.alias("b"), F.col("a.member") == F.col("b.member"), "full")
    return joined.select(
        F.coalesce("a.member", "b.member").alias("member"),
        *[both(f).cast(old.schema[f].dataType).alias(f) for f in facts], payments.alias("payments"),
    )


class OrderState:
    """The state below ``path``; ``buckets`` must be the number it was created with."""

    def __init__(self, spark: SparkSession, path: str, orders: DataFrame, buckets: int = 64):
        schema = state_of(orders.limit(0)).schema
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.table = BucketedTable(spark, path, ddl, "member", buckets)

    def merge(self, orders: DataFrame) -> DataFrame:
        """The state with ``orders`` added, not yet written."""
        new = state_of(orders)
        return merged(self.table.rows(), new) if self.table.versions() else new

    def add(self, orders: DataFrame) -> None:
        """Add orders that the state has not seen."""
        self.table.replace(self.merge(orders))

    def profile(self, value: DataFrame | None = None, **cuts) -> DataFrame:
        """The labels of ``orders.consumer_profile``."""
        most = F.reduce(
            F.map_entries("payments"), F.struct(F.lit(0).cast("bigint").alias("value"), F.lit(None).cast("string").alias("key")),
            lambda best, e: F.when(
                (e["value"] > best["value"]) | ((e["value"] == best["value"]) & (e["key"] < best["key"])),
                F.struct(e["value"].alias("value"), e["key"].alias("key")),
            ).otherwise(best),
        )
        facts = self.table.rows().select(_named(), "*", most["key"].alias("paymentName"))
        return labels_of_facts(_with_days(facts), value, **cuts)

    def rfm_metrics(self, as_of: date | str, shift_days: int = 0) -> DataFrame:
        """The metrics of ``orders.rfm_metrics``."""
        today = F.date_sub(F.lit(str(as_of)).cast("date"), shift_days)
        return self.table.rows().select(
            _named(), F.datediff(today, "finished").alias("recency"), F.col("numbered").alias("frequency"), F.col("spent").alias("money")
        )


def _named() -> Column:
    return F.nullif(F.col("member"), F.lit(NOBODY)).alias("memberId")
