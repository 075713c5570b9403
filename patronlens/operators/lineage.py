"""Cut a plan so that what follows does not run it again."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[str, list[str]] = {}  # application id -> folders that it wrote
_NAMED: dict[str, list[str]] = {}  # application id -> names that it gave to tables in folders
FILES = 2  # files a core, at most, of a table with few and narrow rows


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where the session names none, the warehouse folder serves instead, with a warning: on a
    cluster it must be set to a shared folder, as its default is one of the driver's machine. One rule for
    every master.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
        warnings.warn(f"spark.checkpoint.dir is not set; intermediate tables go to {named}", stacklevel=3)
    return named.rstrip("/")


def new_folder(spark: SparkSession, kind: str = "table") -> str:
    """A path in the shared folder that nobody has used."""
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def gathered(rows: DataFrame) -> DataFrame:
    """``rows`` in at most ``FILES`` partitions a core, without a shuffle: a task takes several partitions one after the other.

    For tables of few, narrow rows that are to be settled: a file for each partition would hold a handful.
    """
    return rows.coalesce(FILES * rows.sparkSession.sparkContext.defaultParallelism)


def settle(rows: DataFrame) -> DataFrame:
    """Write ``rows`` once to the shared folder and go on from the written table.

    For frames that are costly to compute and used more than once. The table outlives
    lost executors, is read column by column, and its size is known to the planner.
    """
    spark = rows.sparkSession
    path = new_folder(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def own_name(spark: SparkSession, name: str) -> str:
    """Note that this application has given ``name`` to a table in a folder, which ``clear`` takes back."""
    _NAMED.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def clear(spark: SparkSession) -> int:
    """Delete what this application settled so far; for the end of a job. Returns the number of folders.

    Names of tables go too; tables that lie in a folder of the caller keep their files.
    """
    for name in _NAMED.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)
