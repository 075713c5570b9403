"""Population reports and the series behind their charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.functions import rules
from patronlens.operators.activity import SLOT_LABELS
from patronlens.operators.orders import completed


def spend_by(orders: DataFrame, users: DataFrame, dim: str, member=None) -> DataFrame:
    """Completed spend per value of a user attribute, cut to whole units.

    Orders shrink to one row per member before they meet the users. ``member``
    replaces the member id by an expression of the order columns.
    """
    key = F.col("memberId") if member is None else member
    per_member = completed(orders).groupBy(key.alias("_member")).agg(F.sum("orderAmount").alias("spend"))
    joined = users.select("id", dim).join(per_member, F.col("id") == F.col("_member"))
    return joined.groupBy(dim).agg(F.sum("spend").cast("bigint").alias("amount"))


def value_by(users: DataFrame, value: DataFrame, dims: Sequence[str], truncate: bool = False) -> DataFrame:
    """Users and mean value per combination of user attributes."""
    valued = users.select("id", *dims).join(value.select("memberId", "value"), F.col("id") == F.col("memberId"))
    mean = F.avg("value")
    return valued.groupBy(*dims).agg(
        F.count(dims[0]).alias("users"), (mean.cast("bigint") if truncate else mean).alias("value")
    )


def brand_by_age(users: DataFrame, preference: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Users per age band and preferred brand, one column per brand."""
    joined = users.select("id", "age").join(preference, F.col("id") == F.col("memberId"))
    return joined.groupBy("age").agg(*[F.count_if(F.col("brand") == b).alias(b) for b in labels])


def brand_age_series(by_age: DataFrame, labels: Sequence[str], ages: Sequence[str] = tuple(rules.GENERATION_SERIES)) -> DataFrame:
    """The same counts with one row per brand and one column per age band, zero-filled."""
    entries = F.array(*[F.struct(F.lit(b).alias("brand"), F.col(b).alias("n")) for b in labels])
    rows = by_age.select("age", F.explode(entries).alias("e")).select("age", "e.brand", "e.n")
    cell = lambda a: F.coalesce(F.sum(F.when(F.col("age") == a, F.col("n"))), F.lit(0))
    return rows.groupBy("brand").agg(*[cell(a).alias(a) for a in ages])


def gender_totals(by_age_gender: DataFrame) -> DataFrame:
    return by_age_gender.groupBy("gender").agg(F.sum("users").alias("users"))


def age_gender_matrix(
    by_age_gender: DataFrame,
    ages: Sequence[str] = tuple(rules.GENERATION_SERIES),
    genders: Sequence[str] = tuple(rules.GENDER.values()),
) -> DataFrame:
    """Users per age band with one column per gender, zero-filled."""
    chosen = by_age_gender.filter(F.col("age").isin(*ages))
    cell = lambda g: F.coalesce(F.sum(F.when(F.col("gender") == g, F.col("users"))), F.lit(0))
    return chosen.groupBy("age").agg(*[cell(g).alias(g) for g in genders])


def province_match(by_province: DataFrame, map_names: DataFrame) -> DataFrame:
    """Value of the province whose first two characters agree with the map's name.

    Several provinces with the same start: the first by name, as one map area shows one value.
    """
    start = lambda c: F.left(F.col(c), F.lit(2))
    first = by_province.groupBy(start("province").alias("_start")).agg(
        F.min(F.struct("province", "value")).alias("p")
    )
    matched = map_names.join(first, start("map_name") == F.col("_start"), "left")
    return matched.select("map_name", F.col("p.province").alias("province"), F.col("p.value").alias("value"))


def zodiac_series(by_zodiac: DataFrame, label: str = "constellation") -> DataFrame:
    """Spend per sign in calendar order, all twelve signs present.

    One conditional sum per sign in a single aggregate, then turned into rows.
    """
    sums = [
        F.coalesce(F.sum(F.when(F.col(label) == sign, F.col("amount"))), F.lit(0)).alias(f"_{i}")
        for i, sign in enumerate(rules.ZODIAC_SERIES, 1)
    ]
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(sign).alias(label), F.col(f"_{i}").alias("amount"))
        for i, sign in enumerate(rules.ZODIAC_SERIES, 1)
    ]
    return by_zodiac.agg(*sums).select(F.inline(F.array(*entries))).orderBy("position")


def job_slot_matrix(by_slot: DataFrame, jobs: Sequence[str] = tuple(rules.JOB.values())) -> DataFrame:
    """Users per job, one column per slot in clock order, zero-filled."""
    chosen = by_slot.filter(F.col("job").isin(*jobs))
    cell = lambda s: F.coalesce(F.sum(F.when(F.col("slot") == s, F.col("count"))), F.lit(0))
    return chosen.groupBy("job").agg(*[cell(s).alias(f"slot_{i}") for i, s in enumerate(SLOT_LABELS, 1)])
