"""Latest offsets without the history: a snapshot of the ends, and the batches after it.

The offset log grows by a folder per batch.  A snapshot, ``<offset log>-snapshots/<app>/batch-<n>/``,
holds the newest entry of every topic partition up to batch n; it is complete once its ``_SUCCESS`` stands.
A reader takes the newest complete snapshot before the batch it asks for and reads, of the log, the
folders of the later batches alone.  A snapshot is made from the one before and its tail, so making one
costs no more.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.offsets import OFFSET_LOG_COLUMNS, latest_offsets
from ledgerline.schemas import OFFSET_LOG
from ledgerline.session import path_exists
from ledgerline.sinks.tables import partition_folder


def _snapshots(path: str, appname: str) -> str:
    return f"{path.rstrip('/')}-snapshots/{hashlib.sha1(appname.encode()).hexdigest()}"


def _children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, by one listing that opens nothing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def _numbers(names: list[str], prefix: str) -> list[int]:
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit())


def _newest(spark: SparkSession, path: str, appname: str, before: int | None) -> int | None:
    own = _snapshots(path, appname)
    for n in reversed(_numbers(_children(spark, own), "batch-")):
        if (before is None or n < before) and path_exists(spark, f"{own}/batch-{n}/_SUCCESS"):
            return n
    return None


def recorded_batches(spark: SparkSession, path: str, appname: str) -> list[int]:
    """Ids of the batches that the app has recorded, from the names of their folders."""
    return _numbers(_children(spark, f"{path.rstrip('/')}/{partition_folder('appname', appname)}"), "batch_id=")


def recent_entries(spark: SparkSession, path: str, appname: str, before: int | None = None) -> DataFrame:
    """Offset-log rows from which an app's latest offsets follow: the newest snapshot's and those of the
    batches after it (``before``: up to that batch only)."""
    at = _newest(spark, path, appname, before)
    tail = [n for n in recorded_batches(spark, path, appname) if (at is None or n > at) and (before is None or n < before)]
    rows = spark.createDataFrame([], OFFSET_LOG).select(*OFFSET_LOG_COLUMNS)
    if at is not None:
        rows = spark.read.schema(OFFSET_LOG).parquet(f"{_snapshots(path, appname)}/batch-{at}").select(*OFFSET_LOG_COLUMNS)
    if tail:
        app = f"{path.rstrip('/')}/{partition_folder('appname', appname)}"
        data = ", ".join(f"`{c}` {OFFSET_LOG[c].dataType.simpleString()}" for c in OFFSET_LOG_COLUMNS if c != "appname")
        found = spark.read.schema(data).option("basePath", app).parquet(*[f"{app}/batch_id={n}" for n in tail])
        found = found.withColumn("appname", F.lit(appname)).select(*OFFSET_LOG_COLUMNS)
        rows = found if at is None else rows.unionByName(found)
    return rows


def latest_recorded(spark: SparkSession, path: str, appname: str, before: int | None = None) -> DataFrame:
    """L2 from the snapshot and its tail: the newest entry per topic partition (columns of ``latest_offsets``)."""
    return latest_offsets(recent_entries(spark, path, appname, before), appname)


def snapshot_offsets(spark: SparkSession, path: str, appname: str) -> int | None:
    """Write a snapshot up to the app's last batch, unless there is one; returns that batch's id."""
    batches = recorded_batches(spark, path, appname)
    if not batches:
        return None
    last, at = batches[-1], _newest(spark, path, appname, None)
    if at != last:
        rows = latest_recorded(spark, path, appname).withColumn("appname", F.lit(appname)).select(*OFFSET_LOG_COLUMNS)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{_snapshots(path, appname)}/batch-{last}")
    return last
