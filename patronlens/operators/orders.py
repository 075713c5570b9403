"""Labels that need only the orders table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions import rules
from patronlens.functions.labels import band, decode, ratio
from patronlens.operators.topk import top_k_per_group

_DAY_WORDS = 6  # 366 days of a year fit six 64-bit words


def completed(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("orderStatus") == rules.COMPLETED)


def _facts(distinct_days: str):
    """Aggregates behind all per-member order labels.

    Distinct days of the year are kept as bits, which add up in map-side partial
    aggregates; ``count(distinct)`` would shuffle every order twice.
    """
    done = F.col("orderStatus") == rules.COMPLETED
    when_done = lambda c: F.when(done, F.col(c))
    facts = {
        "id": F.min(when_done("id")),
        "started": F.min(when_done("modified")),
        "ended": F.max(when_done("modified")),
        "orders": F.count(F.lit(1)),
        "done": F.count_if(done),
        "amount": F.sum(when_done("orderAmount")),
        "amounts": F.count(when_done("orderAmount")),
        "largest": F.max(when_done("orderAmount")),
        "exchanged": F.count_if(F.col("orderStatus") == rules.EXCHANGED),
        "returned": F.count_if(F.col("orderStatus") == rules.RETURNED),
    }
    if distinct_days == "date":
        facts["days"] = F.count_distinct(F.when(done, F.to_date("modified")))
        return facts
    day = F.dayofyear("modified") - 1
    for word in range(_DAY_WORDS):
        bit = F.expr("shiftleft(1L, pmod(dayofyear(modified) - 1, 64))")
        facts[f"_days{word}"] = F.bit_or(F.when(done & (F.floor(day / 64) == word), bit))
    return facts


def _with_days(facts: DataFrame) -> DataFrame:
    words = [c for c in facts.columns if c.startswith("_days")]
    if not words:
        return facts
    days = sum((F.coalesce(F.bit_count(w), F.lit(0)) for w in words), F.lit(0))
    return facts.withColumn("days", days).drop(*words)


def member_facts(orders: DataFrame, distinct_days: str = "dayofyear") -> DataFrame:
    """One row per member with everything the order labels are made of, in one aggregation.

    ``distinct_days`` is ``dayofyear`` (equal days of different years are one day) or
    ``date``. Facts nobody selects are pruned from the plan.
    """
    facts = _facts(distinct_days)
    grouped = orders.groupBy("memberId").agg(*[c.alias(n) for n, c in facts.items()])
    return _with_days(grouped)


def _span():
    return F.datediff(F.col("ended"), F.col("started")) + 1


def _cycle():
    return ratio(_span(), F.col("days"))


def _average():
    return ratio(F.col("amount"), F.col("amounts"))


def _frequency():
    return ratio(F.col("done"), _span())


def purchase_cycle(orders: DataFrame, cuts=rules.CYCLE, distinct_days: str = "dayofyear") -> DataFrame:
    """Days between purchases: span of completed orders over distinct purchase days."""
    facts = member_facts(completed(orders), distinct_days)
    rated = facts.select("memberId", "id", _cycle().alias("cycle"))
    return rated.withColumn("band", band("cycle", cuts, rules.CYCLE_ELSE))


def preferred_payment(orders: DataFrame) -> DataFrame:
    counted = completed(orders).groupBy("memberId", "paymentName").agg(F.count("paymentName").alias("n"))
    return top_k_per_group(counted, ["memberId"], "paymentName", 1).select("memberId", "paymentName")


def avg_order_band(orders: DataFrame, cuts=rules.ORDER_VALUE) -> DataFrame:
    facts = member_facts(completed(orders)).select("memberId", _average().alias("aov"))
    return facts.withColumn("band", band("aov", cuts))


def max_order_band(orders: DataFrame, cuts=rules.ORDER_VALUE, otherwise=rules.MAX_ORDER_ELSE) -> DataFrame:
    """Band of the largest completed order, cut to whole units."""
    facts = member_facts(completed(orders)).select("memberId", F.col("largest").cast("bigint").alias("max_amount"))
    return facts.withColumn("band", band("max_amount", cuts, otherwise))


def purchase_frequency(orders: DataFrame, cuts=rules.FREQUENCY) -> DataFrame:
    """Completed orders per day of the member's purchase span."""
    facts = member_facts(completed(orders)).select("memberId", _frequency().alias("freq"))
    return facts.withColumn("level", band("freq", cuts))


def return_propensity(orders: DataFrame, cuts=rules.RETURN_RATE) -> DataFrame:
    """Shares of exchanged and returned orders among all orders of a member."""
    facts = member_facts(orders).select(
        "memberId",
        ratio("exchanged", "orders").alias("exchange_rate"),
        ratio("returned", "orders").alias("return_rate"),
    )
    return facts.withColumns(
        {"exchange_level": band("exchange_rate", cuts), "return_level": band("return_rate", cuts)}
    )


def consumer_profile(
    orders: DataFrame,
    value: DataFrame | None = None,
    cycle=rules.CYCLE,
    average=rules.ORDER_VALUE,
    largest=rules.ORDER_VALUE,
    largest_else=rules.MAX_ORDER_ELSE,
    frequency=rules.FREQUENCY,
    returns=rules.RETURN_RATE,
) -> DataFrame:
    """All order labels of each member with a completed order, one row per member.

    Orders are read once and aggregated by member and payment name; the second step
    folds the payment names of a member and keeps the most used one. ``value``
    (memberId, value) adds the value label and drops members without one.
    """
    per_payment = orders.groupBy("memberId", "paymentName").agg(
        *[c.alias(n) for n, c in _facts("dayofyear").items()]
    )
    # Sorts above every rival: more completed orders first, then the lower name.
    used = F.when((F.col("done") > 0) & F.col("paymentName").isNotNull(), F.struct(-F.col("done"), "paymentName"))
    facts = _with_days(
        per_payment.groupBy("memberId").agg(
            *[_folding(n)(n).alias(n) for n in per_payment.columns if n not in ("memberId", "paymentName")],
            F.min(used)["paymentName"].alias("paymentName"),
        )
    )
    return labels_of_facts(facts, value, cycle, average, largest, largest_else, frequency, returns)


def _folding(fact: str):
    """The aggregate that puts together a fact of several parts of a member's orders."""
    kinds = {"id": F.min, "started": F.min, "ended": F.max, "largest": F.max, "finished": F.max}
    return F.bit_or if fact.startswith("_days") else kinds.get(fact, F.sum)


def labels_of_facts(
    facts: DataFrame,
    value: DataFrame | None = None,
    cycle=rules.CYCLE,
    average=rules.ORDER_VALUE,
    largest=rules.ORDER_VALUE,
    largest_else=rules.MAX_ORDER_ELSE,
    frequency=rules.FREQUENCY,
    returns=rules.RETURN_RATE,
) -> DataFrame:
    """The labels of ``consumer_profile`` from one row of facts per member."""
    facts = facts.filter(F.col("done") > 0)
    labelled = facts.select(
        "id",
        "memberId",
        band(_cycle(), cycle, rules.CYCLE_ELSE).alias("cycle"),
        "paymentName",
        band(_average(), average).alias("avg_order_band"),
        band(F.col("largest").cast("bigint"), largest, largest_else).alias("max_order_band"),
        band(_frequency(), frequency).alias("frequency"),
        band(ratio("exchanged", "orders"), returns).alias("exchange"),
        band(ratio("returned", "orders"), returns).alias("return"),
    )
    if value is None:
        return labelled
    return labelled.join(value.select("memberId", value_label("value").alias("value")), "memberId")


def value_label(value):
    return decode(value, rules.VALUE_LABELS)


def rfm_metrics(orders: DataFrame, as_of: date | str, shift_days: int = 0) -> DataFrame:
    """Days since the last finished order, number of orders, money; over all orders of a member.

    ``shift_days`` moves the reference day back.
    """
    today = F.date_sub(F.lit(str(as_of)).cast("date"), shift_days)
    return orders.groupBy("memberId").agg(
        F.datediff(today, F.max("finishTime")).alias("recency"),
        F.count("orderSn").alias("frequency"),
        F.sum("orderAmount").alias("money"),
    )


def rfm_scores(
    metrics: DataFrame,
    recency=rules.RECENCY_SCORE,
    frequency=rules.FREQUENCY_SCORE,
    money=rules.MONEY_SCORE,
    strict: bool = False,
) -> DataFrame:
    """Three scores from 5 (best) to 1.

    ``strict`` uses the printed ranges, which leave gaps (null) between whole numbers;
    the default closes them so that every member has a score.
    """
    floor = rules.LOWEST_SCORE
    if strict:
        recency, frequency, money, floor = (
            rules.RECENCY_STRICT, rules.FREQUENCY_STRICT, rules.MONEY_STRICT, None,
        )
    return metrics.select(
        "memberId",
        band("recency", recency, floor).alias("recency"),
        band("frequency", frequency, floor).alias("frequency"),
        band("money", money, floor).alias("money"),
    )


def rfm_value_total(scores: DataFrame) -> DataFrame:
    """Sum of the three scores: a value measure that needs no clustering."""
    total = F.col("recency") + F.col("frequency") + F.col("money")
    return scores.select("memberId", total.alias("value"))
