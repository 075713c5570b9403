"""Order within a group, without gathering the group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.operators.lineage import settle

STRETCH = 200_000  # rows of a group that share a prefix before it is made longer
GROUPINGS = 1 << 16  # hash buckets in which groups are counted to find the large ones


def _stand_in(kind: T.DataType) -> Column:
    """Any value of a type, to fill nulls that a flag beside it tells apart."""
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.NumericType):
        return F.lit(0).cast(kind)
    return F.lit("1970-01-01").cast(kind)


def _solid(rows: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Non-null columns that are equal exactly where ``columns`` are, nulls equal to nulls.

    A plain join on them keeps rows with null keys, and the windows and the join agree
    on how the rows are spread, so nothing is shuffled twice.
    """
    filled, names = {}, []
    for i, name in enumerate(columns):
        filled[f"_key{i}"] = F.coalesce(F.col(name), _stand_in(rows.schema[name].dataType))
        filled[f"_null{i}"] = F.col(name).isNull()
        names += [f"_key{i}", f"_null{i}"]
    return rows.withColumns(filled), names


def split_by_size(rows: DataFrame, *keys: str, bound: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups that one task may hold, and those of the others, if there are any.

    Groups are counted together by hash bucket, one small row a bucket and task, so nothing large is
    shuffled to tell. A group of more than ``bound`` rows is never among the first; small
    ones in a bucket with more rows than that are among the others. Only the numbers
    of such buckets, at most one for ``bound`` rows, reach the driver.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(GROUPINGS))
    sizes = rows.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    large = [r["bucket"] for r in sizes.where(F.col("n") > (STRETCH if bound is None else bound)).collect()]
    if not large:
        return rows, None
    return rows.where(~bucket.isin(large)), rows.where(bucket.isin(large))


def place_small(rows: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column | None = None) -> DataFrame:
    """``start`` and ``total`` as ``place`` gives them, for groups that one task may hold: one shuffle, no join."""
    group = W.partitionBy(*keys)
    before = group.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    weight = F.lit(1).cast("bigint") if weight is None else weight
    return rows.select(
        "*", F.coalesce(F.sum(weight).over(before), F.lit(0)).alias("start"), F.sum(weight).over(group).alias("total")
    )


def place(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    weight: Column | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each group in ascending ``order``.

    Adds ``start`` (sum of the weights before the row, so the 0-based position when
    each row weighs 1), ``total`` (sum over the group) and ``following`` (first order
    column of the next row; null on the last).

    ``slice_by`` cuts a group into stretches and must never fall as ``order`` rises.
    Rows are only ever sorted inside one stretch; the stretches are then chained by
    one small row each. So a group holding a third of the table is spread over as
    many tasks as it has stretches. ``rows`` are read twice: settle them first when
    they are costly to compute, or hand over ``counted``, any aggregate of them that has ``keys``,
    ``_slice``, ``_weight`` (sum) and the first order column (its least value); then they are read once.
    """
    first = order[0]
    cut = rows.withColumns(
        {"_weight": F.lit(1).cast("bigint") if weight is None else weight, "_slice": slice_by}
    )
    cut, stretch = _solid(cut, [*keys, "_slice"])
    sums = cut if counted is None else _solid(counted, [*keys, "_slice"])[0]
    owner, place_in_owner = stretch[:-2], [F.desc(stretch[-1]), F.asc(stretch[-2])]  # null slice first

    group = W.partitionBy(*owner)
    chain = group.orderBy(*place_in_owner)
    stretches = (
        sums.groupBy(*stretch)
        .agg(F.sum("_weight").alias("_sum"), F.min(first).alias("_first"))
        .select(
            *stretch,
            F.coalesce(F.sum("_sum").over(chain.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
            F.sum("_sum").over(group).alias("total"),
            F.lead("_first").over(chain).alias("_next_first"),
        )
    )

    inside = W.partitionBy(*stretch).orderBy(*order)
    numbered = cut.select(
        *rows.columns,
        *stretch,
        (F.sum("_weight").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("_weight")).alias("_inside"),
        F.lead(first).over(inside).alias("_next"),
        F.lead(F.lit(True)).over(inside).isNotNull().alias("_more"),
    )
    return numbered.join(stretches, stretch).select(
        *rows.columns,
        (F.col("_before") + F.col("_inside")).alias("start"),
        "total",
        F.when(F.col("_more"), F.col("_next")).otherwise(F.col("_next_first")).alias("following"),
    )


def with_stretch(
    rows: DataFrame, keys: Sequence[str], column: str, output: str = "_stretch", shortest: int = 2, bound: int = STRETCH
) -> DataFrame:
    """Add ``output``, a prefix of the text ``column`` that cuts groups into stretches of at most ``bound`` rows.

    Prefixes have ``shortest`` characters and are doubled only where more than ``bound`` rows of a group
    share them, level by level, so names with any common beginning are cut as finely as others; only rows with
    one and the same text stay together. The prefix never falls as the text rises. Only whether a level has
    stretches above the bound reaches the driver; where the first has none, nothing is joined.
    """
    size = shortest
    done = rows.withColumn(output, F.left(column, F.lit(size)))
    while True:
        shared = [*keys, output]
        # A text that is no longer than its prefix can't be cut further.
        longer = F.length(column) > size
        heavy = settle(
            done.where(longer).groupBy(*shared).agg(F.count(F.lit(1)).alias("_n"), F.min(column).alias("_least"), F.max(column).alias("_most"))
            .where((F.col("_n") > bound) & (F.col("_least") < F.col("_most"))).select(*shared)
        )
        if heavy.isEmpty():
            return done
        size *= 2
        solid, names = _solid(done, shared)
        marks = _solid(heavy, shared)[0].select(*names, F.lit(True).alias("_heavy"))
        deeper = F.when(F.col("_heavy"), F.left(column, F.lit(size))).otherwise(F.col(output))
        done = settle(
            solid.join(marks, names, "left").select(*rows.columns, deeper.alias(output))
        )
