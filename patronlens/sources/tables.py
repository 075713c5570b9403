"""Schemas, reading, keyed writing and export of the profile tables."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.operators.lineage import own_name, settle
from patronlens.operators.topk import top_rows

_MONEY = T.DecimalType(38, 10)  # wide enough for every amount as it was written


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SCHEMAS: dict[str, T.StructType] = {
    "tbl_users": _schema(
        id=T.LongType(), username=T.StringType(), gender=T.StringType(), email=T.StringType(),
        mobile=T.StringType(), job=T.StringType(), politicalFace=T.StringType(),
        nationality=T.StringType(), marriage=T.StringType(), birthday=T.DateType(),
        modified=T.TimestampType(), registerTime=T.TimestampType(),
        lastLoginTime=T.TimestampType(), is_blackList=T.StringType(),
    ),
    "tbl_orders": _schema(
        id=T.LongType(), memberId=T.LongType(), orderSn=T.StringType(),
        orderStatus=T.StringType(), paymentStatus=T.StringType(), paymentName=T.StringType(),
        modified=T.TimestampType(), finishTime=T.TimestampType(), orderAmount=_MONEY,
        productAmount=_MONEY, couponCodeValue=_MONEY, giftCardAmount=_MONEY,
    ),
    "tbl_goods": _schema(
        id=T.LongType(), cOrderSn=T.StringType(), productType=T.StringType(),
        productName=T.StringType(), couponAmount=_MONEY, activityPrice=_MONEY,
        points=T.IntegerType(),
    ),
    "tbl_logs": _schema(
        id=T.LongType(), global_user_id=T.LongType(), user_agent=T.StringType(),
        loc_url=T.StringType(), log_time=T.TimestampType(),
    ),
    "regions": _schema(region_key=T.StringType(), province=T.StringType(), city=T.StringType()),
}

KEYS = {"tbl_users": "id", "tbl_orders": "id", "tbl_goods": "id", "tbl_logs": "id", "regions": "region_key"}

# Columns that hold unix seconds where the raw tables are text.
UNIX_SECONDS = {"finishTime", "lastLoginTime", "registerTime"}


def read(
    spark: SparkSession, directory: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One typed table; with ``columns`` only those reach the scan."""
    frame = spark.read.schema(SCHEMAS[name]).parquet(f"{directory}/{name}")
    return frame.select(*columns) if columns else frame


def _typed(raw: DataFrame, name: str) -> list[Column]:
    def typed(field: T.StructField):
        if field.name not in raw.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            value = value.cast("string")
        elif field.name in UNIX_SECONDS:
            value = F.timestamp_seconds(value.cast("string").try_cast("bigint"))
        elif isinstance(field.dataType, T.TimestampType):
            value = F.try_to_timestamp(value.cast("string"))
        else:
            value = value.cast("string").try_cast(field.dataType)
        return value.alias(field.name)

    return [typed(field) for field in SCHEMAS[name]]


def conform(raw: DataFrame, name: str) -> DataFrame:
    """Type an all-text table once, at the door; unreadable values become null."""
    return raw.select(*_typed(raw, name))


def ingest(raw: DataFrame, name: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Type an all-text table and tell what it lost: (typed rows, rejects, losses by column).

    A value is lost when it is there and can't be read as its column's type. Rejects are the typed rows that lost
    something, with ``lost`` (names of the columns, in their order) and ``raw`` (the row as it came, as JSON).
    The losses, and ``rows`` for the number of rows, are counted by ``DataFrame.observe`` in the pass that
    writes the typed table to the shared folder; the input is read once. Absent columns lose nothing.
    """
    fields = SCHEMAS[name].fieldNames()
    columns = dict(zip(fields, _typed(raw, name), strict=True))
    unread = [F.when(F.col(c).isNotNull() & columns[c].isNull(), F.lit(c)) for c in fields if c in raw.columns]
    lost = F.array_compact(F.array(*unread, F.lit(None).cast("string")))
    whole = raw.select(
        *columns.values(), lost.alias("lost"),
        F.when(F.size(lost) > 0, F.to_json(F.struct(*raw.columns), {"ignoreNullFields": "false"})).alias("raw"),
    )
    seen = Observation()
    counts = [F.count_if(F.array_contains("lost", c)).alias(c) for c in fields]
    table = settle(whole.observe(seen, F.count(F.lit(1)).alias("rows"), *counts))
    return table.select(*fields), table.where(F.size("lost") > 0), dict(seen.get)


def regions_from_json(raw: DataFrame, key: str = "region_key", body: str = "body") -> DataFrame:
    """Region dimension from JSON answers of an area service, one per key."""
    part = lambda name: F.get_json_object(F.col(body), f"$.data.{name}").alias(name)
    return raw.select(F.col(key).cast("string").alias("region_key"), part("province"), part("city"))


def latest_by_key(rows: DataFrame, key: str | Sequence[str], newest: str | None = None) -> DataFrame:
    """One row per key: the one with the highest ``newest``, ties by the other columns."""
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.desc(newest)] if newest else []
    order += [F.desc(c) for c in rows.columns if c not in keys and c != newest]
    return top_rows(rows, keys, order or [F.lit(0)], 1)


def merge_by_key(current: DataFrame, updates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``current`` with the rows of ``updates`` put in place of those with an equal key; null equals null.

    The key may name an owner of several rows: all its rows go when any of it is put.
    """
    keys = [key] if isinstance(key, str) else list(key)
    new = updates.select([F.col(c).alias(f"_new_{c}") for c in keys]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in keys])
    return current.join(new, same, "left_anti").unionByName(updates)


def _files(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, jvm_path


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _files(spark, path)
    return fs.exists(jvm_path(path))


def write(
    rows: DataFrame,
    path: str,
    key: str | Sequence[str],
    mode: str = "errorifexists",
    newest: str | None = None,
    unique: bool = False,
    sort: bool = True,
    lookups: Sequence[str] = (),
    owner: str | Sequence[str] | None = None,
) -> None:
    """Write a table with one row per key.

    ``mode`` is ``errorifexists``, ``overwrite``, or ``upsert`` and ``append``, which both
    keep one row per key in the whole table, as a keyed store does when a key is put
    again. ``unique`` says that
    the rows already have one row per key, which saves a shuffle. Rows are laid out by
    range of the key, so a lookup by key reads few row groups; ``lookups`` names further
    columns that get Bloom filters, so that a lookup by one of them skips row groups too.

    ``owner`` names the columns of the key whose rows belong together, such as the parts of one list:
    an upsert replaces all rows of an owner, so a list that shrinks keeps no part of its former state.

    An upsert writes the merged table beside the old one and swaps the two names. A job
    that dies on the way leaves the old table whole, under its name or, between the two
    renames, as ``.old``, which the next write puts back first.
    """
    spark = rows.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    recover(spark, path)
    if not unique:
        rows = latest_by_key(rows, keys, newest)
    swap = mode in ("upsert", "append") and table_exists(spark, path)
    if swap:
        rows = merge_by_key(spark.read.parquet(path), rows, keys if owner is None else owner)
    if sort:
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = rows.write.options(**{f"parquet.bloom.filter.enabled#{c}": "true" for c in lookups})
    if not swap:
        writer.mode("errorifexists" if mode in ("upsert", "append") else mode).parquet(path)
        return
    fresh, old = f"{path}.next", f"{path}.old"
    writer.mode("overwrite").parquet(fresh)
    _rename(spark, path, old)
    _rename(spark, fresh, path)
    if not table_exists(spark, path):
        raise OSError(f"{path} is not there after the swap; its former state is {old}")
    _delete(spark, old)


def recover(spark: SparkSession, path: str) -> None:
    """Put back a table that a dead upsert left under its ``.old`` name; clear what a finished one left."""
    old = f"{path}.old"
    if table_exists(spark, old):
        if table_exists(spark, path):
            _delete(spark, old)
        else:
            _rename(spark, old, path)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, jvm_path = _files(spark, source)
    if not fs.rename(jvm_path(source), jvm_path(target)):
        raise OSError(f"could not rename {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _files(spark, path)
    fs.delete(jvm_path(path), True)


def register_view(rows: DataFrame, name: str) -> DataFrame:
    rows.createOrReplaceTempView(name)
    return rows


def export_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    mode: str = "errorifexists",
    connections: int = 8,
) -> None:
    """Copy a table into a database; address and credentials come from the caller.

    ``numPartitions`` bounds the connections opened at once, however many partitions
    the table has.
    """
    (
        rows.write.mode(mode)
        .option("numPartitions", connections)
        .option("batchsize", 10000)
        .jdbc(url, table, properties=dict(properties or {}))
    )


class BucketedTable:
    """A table in buckets by one key, sorted inside, whose whole content is replaced at once.

    Lookups by the key read one bucket, and joins on it don't move the table. Each content is a
    numbered folder below ``path`` that counts once Spark has marked it as complete, so a
    writer that dies leaves the former content in force. The one before is kept for readers that are under way.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets
        self.name = "bucketed_" + hashlib.md5(self.path.encode()).hexdigest()

    def versions(self) -> list[int]:
        fs, jvm_path = _files(self.spark, self.path)
        if not fs.exists(jvm_path(self.path)):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(jvm_path(self.path))]
        return sorted(int(n[1:]) for n in names if n[1:].isdigit() and fs.exists(jvm_path(f"{self.path}/{n}/_SUCCESS")))

    def rows(self) -> DataFrame:
        """The content in force; empty before the first."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], self.schema)
        table = own_name(self.spark, f"{self.name}_{known[-1]}")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({self.schema}) USING parquet "
            f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/v{known[-1]}'"
        )
        return self.spark.table(table)

    def replace(self, rows: DataFrame) -> None:
        """Put ``rows`` in place of the content; they may be made from it."""
        known = self.versions()
        number = known[-1] + 1 if known else 1
        target, fields = own_name(self.spark, f"{self.name}_{number}"), T.StructType.fromDDL(self.schema).fieldNames()
        self.spark.sql(f"DROP TABLE IF EXISTS {target}")
        _delete(self.spark, f"{self.path}/v{number}")  # what a dead writer left
        (
            rows.select(*fields).repartition(self.buckets, self.key).sortWithinPartitions(self.key)
            .write.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", f"{self.path}/v{number}").saveAsTable(target)
        )
        for old in known[:-1]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{old}")
            _delete(self.spark, f"{self.path}/v{old}")
