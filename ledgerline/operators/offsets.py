"""Offset log: per-batch offset ranges, time -> offset resolution, newest entries.

The offset log has one typed row per (appname, topic, partition, batch_id):
``batch_ts`` (epoch s), ``start_offset`` (inclusive), ``end_offset`` (exclusive).
All operators are partial+final hash aggregates or filters; nothing is
collected except where a caller explicitly turns a per-partition result (one
row per topic partition) into connector options.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.functions.timefields import floor_div, reverse_time_key
from ledgerline.session import scratch_path

# The column family and the two qualifiers of an offset cell.
OFFSET_FAMILY = "tp_offsets"
START_QUALIFIER = "start"
END_QUALIFIER = "end"

OFFSET_LOG_COLUMNS = ["appname", "topic", "partition", "batch_id", "batch_ts", "start_offset", "end_offset"]
RANGE_COLUMNS = ["topic", "partition", "from_offset", "until_offset"]


def message_seconds(ts_col: str = "timestamp") -> Column:
    """Epoch seconds (rounded down) of a message's TIMESTAMP; no time-zone dependence."""
    return floor_div(F.unix_micros(F.col(ts_col)), 1_000_000)


def hourly_batches(log: DataFrame, width_s: int = 3600, ts_col: str = "timestamp") -> DataFrame:
    """Tag each message with ``batch_id`` = epoch seconds div ``width_s``."""
    return log.withColumn("batch_id", floor_div(message_seconds(ts_col), width_s))


def batch_offsets(batch: DataFrame, appname: str, batch_id: Column | None = None, ts_col: str = "timestamp") -> DataFrame:
    """Offset range per (topic, partition) and batch.

    ``batch_id`` is taken from the column of that name unless given (a stream's
    epoch id).  start = min(offset), end = max(offset)+1, batch_ts = newest
    message second.  Partial aggregation keeps the shuffle to one row per
    (task, partition, batch) whatever the skew.
    """
    tagged = batch if batch_id is None else batch.withColumn("batch_id", batch_id.cast("long"))
    return (
        tagged.groupBy("topic", "partition", "batch_id")
        .agg(
            F.max(message_seconds(ts_col)).alias("batch_ts"),
            F.min("offset").alias("start_offset"),
            (F.max("offset") + 1).alias("end_offset"),
        )
        .select(F.lit(appname).alias("appname"), "topic", "partition", F.col("batch_id").cast("long").alias("batch_id"),
                "batch_ts", "start_offset", "end_offset")
    )


def carry_forward(offset_log: DataFrame) -> DataFrame:
    """An offset log with a row for every topic partition in every batch from the partition's first on.

    A partition without new messages in a batch has the empty range at its end so far, with the
    batch's time: what a consumer records that asks all its partitions.  The rows that are there stay as
    they are.  Batches follow by ``batch_id``.  The join is on the app; its size is that of the result.
    The offset log is computed once, into the scratch folder, as it is read three times.
    """
    own = scratch_path(offset_log.sparkSession, "offset_log")
    offset_log.write.parquet(own)
    offset_log = offset_log.sparkSession.read.schema(offset_log.schema).parquet(own)
    part = ["appname", "topic", "partition"]
    batches = offset_log.groupBy("appname", "batch_id").agg(F.max("batch_ts").alias("__ts"))
    first = offset_log.groupBy(*part).agg(F.min("batch_id").alias("__first"))
    grid = first.join(batches, "appname").filter(F.col("batch_id") >= F.col("__first")).select(*part, "batch_id", "__ts")
    full = grid.join(offset_log, [*part, "batch_id"], "left")
    so_far = Window.partitionBy(*part).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    end = F.last("end_offset", ignorenulls=True).over(so_far)
    return full.withColumn("__end", end).select(
        *part, "batch_id", F.coalesce("batch_ts", "__ts").alias("batch_ts"),
        F.coalesce("start_offset", "__end").alias("start_offset"), F.col("__end").alias("end_offset"),
    ).select(*OFFSET_LOG_COLUMNS)


def with_idle_partitions(ranges: DataFrame, ends: DataFrame, appname: str, batch_id: int, batch_ts: int) -> DataFrame:
    """One batch's ranges (OFFSET_LOG columns) and an empty range for each topic partition of ``ends``
    (``topic, partition, end_offset``; what is recorded so far) without messages in it."""
    idle = ends.select("topic", "partition", "end_offset").join(ranges, ["topic", "partition"], "left_anti")
    rows = idle.select(
        F.lit(appname).alias("appname"), "topic", "partition", F.lit(int(batch_id)).cast("long").alias("batch_id"),
        F.lit(int(batch_ts)).cast("long").alias("batch_ts"), F.col("end_offset").alias("start_offset"), "end_offset",
    )
    return ranges.unionByName(rows)


def batch_counts(batch: DataFrame) -> DataFrame:
    """Messages per (topic, partition, batch)."""
    return batch.groupBy("topic", "partition", "batch_id").agg(F.count(F.lit(1)).alias("message_count"))


def scan_offset_log(offset_log: DataFrame, appname: str, begin_s: int, end_s: int) -> DataFrame:
    """Entries of ``appname`` with ``begin_s < batch_ts <= end_s`` (pushed to the scan)."""
    return offset_log.filter(
        (F.col("appname") == F.lit(appname)) & (F.col("batch_ts") > F.lit(begin_s)) & (F.col("batch_ts") <= F.lit(end_s))
    )


def _batch_order() -> Column:
    return F.struct(F.col("batch_ts"), F.col("batch_id"))


def resolve_range(offset_log: DataFrame, appname: str, begin_s: int, end_s: int, mode: str = "covering") -> DataFrame:
    """A time range -> one offset range per (topic, partition).

    ``covering``: from the first batch's start to the last batch's end (every
    message of every batch in the range).  ``interior``: from the oldest
    batch's end to the newest batch's start, i.e. the edge batches dropped;
    one batch gives an empty (inverted) range.  No batch gives no row.
    """
    scanned = scan_offset_log(offset_log, appname, begin_s, end_s)
    if mode == "covering":
        agg = [F.min("start_offset").alias("from_offset"), F.max("end_offset").alias("until_offset")]
    elif mode == "interior":
        agg = [
            F.min_by("end_offset", _batch_order()).alias("from_offset"),
            F.max_by("start_offset", _batch_order()).alias("until_offset"),
        ]
    else:
        raise ValueError(f"unknown range mode {mode!r}; use 'covering' or 'interior'")
    return scanned.groupBy("topic", "partition").agg(*agg).select(*RANGE_COLUMNS)


def newest_batches(offset_log: DataFrame, appname: str, n: int) -> DataFrame:
    """L1: the ``n`` newest entries of an app (ties by topic, partition)."""
    return (
        offset_log.filter(F.col("appname") == F.lit(appname))
        .orderBy(F.col("batch_ts").desc(), F.col("batch_id").desc(), "topic", "partition")
        .limit(n)
    )


def latest_offsets(offset_log: DataFrame, appname: str) -> DataFrame:
    """L2: the newest entry per (topic, partition) of an app."""
    newest = F.max_by(F.struct(*[F.col(c) for c in ("batch_id", "batch_ts", "start_offset", "end_offset")]),
                      _batch_order())
    return (
        offset_log.filter(F.col("appname") == F.lit(appname))
        .groupBy("topic", "partition")
        .agg(newest.alias("e"))
        .select("topic", "partition", "e.batch_id", "e.batch_ts", "e.start_offset", "e.end_offset")
    )


def starting_offsets(offset_log: DataFrame, appname: str) -> DataFrame:
    """Where a restarted reader resumes: the newest recorded end per partition."""
    return latest_offsets(offset_log, appname).select("topic", "partition", F.col("end_offset").alias("next_offset"))


def starting_offsets_json(starts: DataFrame) -> str:
    """Kafka ``startingOffsets`` text from :func:`starting_offsets`: one row per topic partition, all of
    which the option's text has to name."""
    rows = starts.collect()
    spec: dict[str, dict[str, int]] = {}
    for r in rows:
        spec.setdefault(r["topic"], {})[str(r["partition"])] = int(r["next_offset"])
    return json.dumps(spec, sort_keys=True)


# --- offset cells (the key-value form of the log) ---------------------------------

CELL_SCHEMA = T.StructType(
    [
        T.StructField("row", T.StringType(), True),
        T.StructField("family", T.StringType(), True),
        T.StructField("qualifier", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
    ]
)


def cell_row_key(appname: Column | str = "appname") -> Column:
    """Row key: app + reversed seconds (newest first), then topic and partition."""
    app = F.col(appname) if isinstance(appname, str) else appname
    return F.concat_ws(":", reverse_time_key(app, F.col("batch_ts")), F.col("topic"), F.col("partition").cast("string"))


def offset_cells(offset_log: DataFrame) -> DataFrame:
    """The log as key-value cells: ``row`` and ``cells``, the cell records one per line."""
    row = cell_row_key()

    def cell(qualifier: str, value: str) -> Column:
        return F.to_json(
            F.struct(row.alias("row"), F.lit(OFFSET_FAMILY).alias("family"), F.lit(qualifier).alias("qualifier"),
                     F.col(value).cast("string").alias("value"))
        )

    return offset_log.select(row.alias("row"), F.concat_ws("\n", cell(START_QUALIFIER, "start_offset"),
                                                           cell(END_QUALIFIER, "end_offset")).alias("cells"))


def cells_to_ranges(cells: DataFrame, text_col: str = "cells") -> DataFrame:
    """Split cell text into records, parse them and pivot start/end.

    A row's cells arrive together, so this is a per-row array transform: no
    explode, no shuffle.
    """
    parsed = F.transform(F.split(F.col(text_col), "\n"), lambda line: F.from_json(line, CELL_SCHEMA))

    def pick(qualifier: str) -> Column:
        hit = F.filter(parsed, lambda c: (c["qualifier"] == F.lit(qualifier)) & (c["family"] == F.lit(OFFSET_FAMILY)))
        return F.get(hit, 0)["value"].try_cast("long")

    return cells.select(
        F.get(parsed, 0)["row"].alias("row"),
        pick(START_QUALIFIER).alias("start_offset"),
        pick(END_QUALIFIER).alias("end_offset"),
    )
