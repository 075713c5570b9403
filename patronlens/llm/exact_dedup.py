"""Exact deduplication against a persistent digest index.

The index is a parquet table bucketed and sorted by the SHA-256 of the text. New documents
are reduced to one row per digest, anti-joined to the index by sort-merge (the index
side is read bucket by bucket and not shuffled), and what is new is appended. Every append adds
one sorted file to a bucket, so Spark sorts a bucket once more when it has several.

Defined results: a null text counts as empty and is a text like any other; of equal texts
the row with the largest doc_id stays, a null doc_id being smaller than any; rows that
repeat doc_id and text are one document given twice, of which the stage keeps one; an
empty table gives no rows; extra columns are passed through by ``kept_rows`` and
may have any name that does not start with two underscores.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.operators.lineage import new_folder, own_name, settle


def digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


class DigestIndex:
    """The digests of all texts that were kept so far, with the doc_id that stays for each.

    ``path`` is a shared folder; opening it again, in this or another session, goes on with
    what it holds. ``buckets`` must be the number it was created with.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path = spark, path
        # Named by the whole path: two indexes in folders of one name are two.
        self.table = own_name(spark, "digest_index_" + hashlib.md5(path.rstrip("/").encode()).hexdigest())
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        known = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {self.table}").collect()}
        if known["Num Buckets"] != str(buckets):
            raise ValueError(f"the index in {path} has {known['Num Buckets']} buckets, not {buckets}")
        self.buckets = buckets

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, docs: DataFrame) -> DataFrame:
        """Index the new texts of ``docs``; returns what was appended as (digest, keep_id)."""
        return self.append(grouped(docs.select("doc_id", digest("text").alias("digest"))))

    def append(self, groups: DataFrame) -> DataFrame:
        # The buckets of the index are whole hash partitions, so only the new digests move.
        # ``groups`` is a written table: else the planner pulls the join below the aggregation.
        fresh = groups.select("digest", "keep_id").repartition(self.buckets, "digest").hint("merge").join(
            self.rows(), "digest", "left_anti"
        )
        appended = settle(fresh)
        appended.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        return appended


def grouped(narrow: DataFrame) -> DataFrame:
    """One row for each digest, whatever its number of rows: (digest, keep_id, group_size)."""
    return settle(
        narrow.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )


def batched(narrow: DataFrame, batches: int) -> list[DataFrame]:
    """``narrow`` in batches of some equal size, the largest doc_id first and those without one in the last.

    So the first batch that has a text has the largest doc_id of all its rows, and the index keeps that.
    """
    shares = [1 - i / batches for i in range(1, batches)]
    cuts = narrow.agg(F.percentile_approx("doc_id", shares, 1_000)).first()[0] if shares else None
    cuts = sorted(set(cuts or []), reverse=True)
    passed = sum(((F.col("doc_id") <= c).cast("int") for c in cuts), F.lit(0))
    turn = F.coalesce(passed, F.lit(len(cuts)))
    return [narrow.where(turn == i) for i in range(len(cuts) + 1)]


def decide(docs: DataFrame, index: DigestIndex, batches: int = 1) -> DataFrame:
    """Add ``docs`` to the index and say for each row which doc_id stays for its text.

    (doc_id, digest, keep_id, group_size, kept): group_size counts the rows of ``docs`` with
    the text; kept is true for the staying row of a text that the index did not hold before.
    Each of several ``batches`` is joined to what the index holds with the ones before; the result is the same.
    """
    narrow = settle(docs.select("doc_id", digest("text").alias("digest")))
    each = [grouped(batch) for batch in batched(narrow, batches)]
    appended = reduce(DataFrame.unionByName, [index.append(sizes) for sizes in each])
    sizes = reduce(DataFrame.unionByName, each)
    if len(each) > 1:
        sizes = settle(sizes.groupBy("digest").agg(F.sum("group_size").alias("group_size")))
    # One row a digest on both sides, so the index stays where it is; digests with many rows only meet the written result.
    groups = settle(
        sizes.select("digest", "group_size").repartition(index.buckets, "digest").hint("merge").join(index.rows(), "digest")
        .join(appended.select("digest", F.lit(True).alias("new")), "digest", "left")
    )
    return narrow.join(groups, "digest").select(
        "doc_id", "digest", "keep_id", "group_size",
        (F.col("new").isNotNull() & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
    )


def kept_rows(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id")
    marked = docs.select("*", digest("text").alias("__digest"), key)
    appended = index.add(docs).select(
        F.col("digest").alias("__digest"), F.coalesce(F.col("keep_id").cast("string"), F.lit("")).alias("__id")
    )
    # One shuffle serves both: copies of the same row meet where the join has put them.
    return (
        marked.join(appended, ["__id", "__digest"], "left_semi")
        .dropDuplicates(["__id", "__digest"])
        .drop("__id", "__digest")
    )


def new_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index in the shared folder, by default with as many buckets as shuffles have partitions."""
    return DigestIndex(
        spark, new_folder(spark, "digests"), buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
