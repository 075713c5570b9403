"""Joins in which one key may hold any share of the rows of the larger side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = 4  # per shuffle partition: a key with more than one piece's share of the rows is split
SPREAD = 16  # buckets a piece in which keys are counted


def heavy_keys(rows: DataFrame, key: str, pieces: int) -> list:
    """The keys that hold more than one of ``pieces`` equal shares of ``rows``.

    One pass over the key column counts the rows of ``SPREAD * pieces`` hash buckets, which merge
    in every task. Only keys of buckets above the bound are counted themselves, in a second
    pass; where there are none it is left out. The counts of the buckets and fewer than
    ``pieces`` keys reach the driver.
    """
    keys = rows.select(F.col(key).alias("_key")).where("_key IS NOT NULL")
    bucket = F.pmod(F.xxhash64("_key"), F.lit(SPREAD * pieces))
    sizes = keys.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in sizes)
    full = [r["bucket"] for r in sizes if r["n"] * pieces > total]
    if not full:
        return []
    counted = keys.where(bucket.isin(full)).groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    return [r["_key"] for r in counted.where(F.col("n") * pieces > total).collect()]


def split_join(rows: DataFrame, narrow: DataFrame, key: str, narrow_key: str, keys: DataFrame | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``narrow`` (few rows a key), whatever the share of a key.

    The rows of a heavy key are dealt by hash to many pieces, and the narrow rows of that key
    are repeated for each; the other keys are joined as ever. Without heavy keys it is the plain join.
    Heavy keys are looked for in ``keys``, if given: a frame with the same keys that is cheaper to read.
    """
    spark = rows.sparkSession
    pieces = PIECES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(rows if keys is None else keys, key, pieces)
    if not heavy:
        return rows.join(narrow, F.col(key) == F.col(narrow_key))
    piece = F.when(F.col(key).isin(heavy), F.pmod(F.xxhash64(*rows.columns), F.lit(pieces))).otherwise(F.lit(0))
    every = F.when(F.col(narrow_key).isin(heavy), F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0)))
    dealt = rows.withColumn("_piece", piece.cast("int"))
    repeated = narrow.withColumn("_copy", F.explode(every))
    return dealt.join(repeated, (F.col(key) == F.col(narrow_key)) & (F.col("_piece") == F.col("_copy"))).drop("_piece", "_copy")
