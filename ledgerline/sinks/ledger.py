"""Publishing that may be repeated: a ledger of publish ids beside a table-backed log.

A publish under an id goes through three states, each entered by one atomic step:

1. its messages are numbered and written to the ledger, ``<log>-ledger/id=<sha1>/numbered``;
2. one row per topic partition in the table of ends says up to where the id has taken offsets;
3. the messages are in the log, and ``.../done`` says so.

A repeat goes on from the state it finds.  Before step 2 nothing is taken, so the messages are numbered
afresh; after it the ledger's numbers hold for good, and only messages that the log does not have yet are
written (an anti-join on topic, partition and offset, within the id's ranges); after step 3 a repeat adds
nothing.  So no message comes twice, and no offset is left out or used twice, wherever a run ended.  One
writer per log at a time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import path_exists
from ledgerline.sinks.tables import ENDS_DDL, append_numbered, ends_path, number_messages
from ledgerline.sources.log import LOG_COLUMNS, ORDER_COL, read_log, read_offset_range

PLACE = ["topic", "partition", "offset"]


def _folder(path: str, publish_id: str) -> str:
    return f"{path.rstrip('/')}-ledger/id={hashlib.sha1(publish_id.encode()).hexdigest()}"


def _taken(spark: SparkSession, path: str, publish_id: str) -> bool:
    """Whether the id has taken its offsets."""
    if not path_exists(spark, ends_path(path)):
        return False
    ends = spark.read.schema(ENDS_DDL).parquet(ends_path(path))
    return not ends.filter(F.col("publish") == F.lit(publish_id)).isEmpty()


def _take(spark: SparkSession, path: str, publish_id: str, messages: DataFrame, order_col: str) -> bool:
    """Steps 1 and 2; False if there are no messages."""
    numbered = number_messages(spark, path, messages, order_col, f"{_folder(path, publish_id)}/numbered")
    ends = numbered.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next"))
    rows = ends.select("topic", "partition", "next", F.lit(publish_id).alias("publish")).collect()  # one per topic partition
    if rows:
        spark.createDataFrame(rows, ENDS_DDL).coalesce(1).write.mode("append").parquet(ends_path(path))
    return bool(rows)


def publish_once(spark: SparkSession, path: str, messages: DataFrame, publish_id: str, order_col: str = ORDER_COL) -> int:
    """Append ``messages`` to the log at ``path`` under ``publish_id``; returns how many were written now.

    ``messages`` has ``key value topic partition timestamp`` and an integral ``order_col``, as for
    ``append_log``.  A repeat under the same id takes the messages of the first run that took offsets,
    whatever it is given.
    """
    if not publish_id:
        raise ValueError("a publish id must not be empty")
    own = _folder(path, publish_id)
    if path_exists(spark, f"{own}/done/_SUCCESS"):
        return 0
    fresh = not _taken(spark, path, publish_id)
    if not fresh or _take(spark, path, publish_id, messages, order_col):
        todo = spark.read.parquet(f"{own}/numbered").select(*LOG_COLUMNS)
        if not fresh and path_exists(spark, path):
            spans = todo.groupBy("topic", "partition").agg(F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"))
            there = read_offset_range(read_log(spark, path), spans).select(*PLACE)
            todo = todo.join(there, PLACE, "left_anti").select(*LOG_COLUMNS)
        written = todo.count()
        append_numbered(todo, path)
    else:
        written = 0
    spark.createDataFrame([(publish_id, written)], "publish string, written long").coalesce(1).write.mode("overwrite").parquet(f"{own}/done")
    return written


def published_ids(spark: SparkSession, path: str) -> DataFrame:
    """publish, topic, partition, until_offset: the offsets that each id has taken last."""
    if not path_exists(spark, ends_path(path)):
        return spark.createDataFrame([], "publish string, topic string, partition int, until_offset long")
    ends = spark.read.schema(ENDS_DDL).parquet(ends_path(path)).filter(F.col("publish").isNotNull())
    return ends.select("publish", "topic", "partition", F.col("next").alias("until_offset"))


