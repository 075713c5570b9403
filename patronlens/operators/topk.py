"""Best rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_rows(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None
) -> DataFrame:
    """First ``k`` rows of each group.

    The ``row_number() <= k`` form lets Spark drop all but ``k`` rows per group in
    each map task, before the shuffle, so a hot group costs no more than any other.
    """
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    kept = rows.withColumn("_rank", position).filter(F.col("_rank") <= k)
    return kept.withColumnRenamed("_rank", rank) if rank else kept.drop("_rank")


def top_k_per_group(
    counted: DataFrame, keys: Sequence[str], value: str, k: int, score: str = "n", rank: str = "rank"
) -> DataFrame:
    """The ``k`` values with the highest score per group, equal scores by value ascending."""
    order = [F.desc(score), F.asc(value)]
    return top_rows(counted, keys, order, k, rank)
