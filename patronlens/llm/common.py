"""Shared pieces: word counts, row keys, distributed prefix sums, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from patronlens.operators.lineage import gathered, settle

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_HEX = 3  # leading hex digits of a hash that name its chunk: 4096 chunks
COARSE_HEX = 2


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless they are told otherwise."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def word_count(text: Column | str) -> Column:
    """Number of words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(column: str, text: str = "text") -> Column:
    """Hash of an id as 32 hex digits: the random but repeatable order of rows.

    Rows without an id are told apart by their text.
    """
    other = F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    return F.md5(F.coalesce(F.col(column).cast("string"), other).cast("binary"))


def row_key(*columns: str) -> list[Column]:
    """Two 64-bit columns ``k1, k2`` that identify a row by the values of ``columns``, nulls included.

    Rows that agree in all of them share the key, which operators allow for.
    """
    there = [F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.lit(1)) for c in columns]
    return [
        F.xxhash64(*there, *columns).alias("k1"),
        F.xxhash64(F.lit(7), *columns[::-1], *there).alias("k2"),
    ]


def with_prefix(
    rows: DataFrame, group: str, order: str, value: str, ties: list[str], output: str, digits: int = CHUNK_HEX
) -> DataFrame:
    """Add ``output``: the sum of ``value`` over the rows of ``group`` that come before, by hex hash ``order``.

    A group may hold any share of all rows: it is cut into chunks by the leading digits of
    the hash, sums of whole chunks give each chunk its offset, themselves by coarser chunks,
    and only a chunk is sorted in one task. ``group`` must not be null.
    """
    chunk = f"__chunk{digits}"
    rows = rows.withColumn(chunk, F.substring(order, 1, digits))
    sums = rows.groupBy(group, chunk).agg(F.sum(value).alias("__sum"))
    if digits > COARSE_HEX:
        offsets = with_prefix(sums, group, chunk, "__sum", [], "__before", COARSE_HEX).withColumnRenamed("__before", "__offset")
    else:
        offsets = sums.withColumn("__offset", _sum_before("__sum", Window.partitionBy(group).orderBy(chunk)))
    inside = Window.partitionBy(group, chunk).orderBy(order, *ties)
    return (
        rows.join(offsets.select(group, chunk, "__offset"), [group, chunk])
        .withColumn(output, F.col("__offset") + _sum_before(value, inside))
        .drop(chunk, "__offset")
    )


def _sum_before(value: str, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of a stream that is sorted by ``keys``."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        if not table.num_rows:
            continue
        columns = [table.column(k).to_numpy() for k in keys]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        starts = [0, *changes.tolist()]
        for a, b in zip(starts, starts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(starts[-1])
    if rest is not None:
        yield rest


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node reachable.

    Alternates between hooking each node's larger neighbours (large star) and its smaller ones
    (small star) to the smallest neighbour, until only stars are left. Groups are only ever
    aggregated by ``min`` and ``max``, so a node with a third of all edges is no hot spot. Each
    round is a written table; only whether one is left to do reaches the driver.
    """
    edges = settle(gathered(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = settle(gathered(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        edges = settle(gathered(
            small.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lowest.select("a", F.col("m").alias("b")))
            .distinct())
        )
        # A star forest: no centre hangs on another node, and no node on two centres.
        ends = edges.select("a", "b", F.lit(0).alias("centre")).unionByName(
            edges.select(F.col("b").alias("a"), "b", F.lit(1).alias("centre"))
        )
        mixed = ends.groupBy("a").agg(
            F.min("b").alias("low"), F.max("b").alias("high"), F.min("centre").alias("first"), F.max("centre").alias("last")
        ).where("low < high OR first < last")
        if mixed.isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
