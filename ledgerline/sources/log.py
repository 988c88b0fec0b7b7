"""Message-log sources: a table published as a log, bounded offset ranges,
start positions, and streams.

A log at rest is a Parquet table with the Kafka source's columns
(``key value topic partition offset timestamp``), ideally partitioned by
``topic, partition`` and sorted by ``offset`` so that range reads prune
directories and row groups.  The Kafka connector is supported where its
package is on the classpath; without it a clear error is raised.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.routing import route_partition
from ledgerline.functions.timefields import epoch_micros
from ledgerline.operators.codec import MissingConnectorError, connector_checked, encode_column
from ledgerline.operators.sequence import DEFAULT_BLOCK_ROWS, assign_sequence
from ledgerline.schemas import MESSAGE_LOG
from ledgerline.session import scratch_path

LOG_COLUMNS = [f.name for f in MESSAGE_LOG.fields]

ORDER_COL = "__order"  # a message's place among the messages published with it
LISTED_BOUNDS = 1_000  # rows of a bounds table whose partitions are named at the scan
BROADCAST_BOUNDS = 1_000_000  # most rows of a bounds table that is broadcast; beyond it the join shuffles


@dataclass(frozen=True)
class OffsetRange:
    """``[from_offset, until_offset)`` of one topic partition; ``None`` = open end."""

    topic: str
    partition: int
    from_offset: int | None = None
    until_offset: int | None = None


def log_from_table(
    df: DataFrame,
    topic: str,
    key: Column,
    route: Column,
    order_col: str,
    timestamp: Column,
    payload_cols: list[str],
    n_partitions: int,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    fmt: str = "json",
    avro_schema: str | None = None,
) -> DataFrame:
    """Publish a table as a log: route each row to a partition, number it in
    ``order_col`` order within the partition, encode its payload as ``fmt``.

    Offsets are assigned by :func:`assign_sequence` (bounded tasks whatever
    the partition sizes).  ``timestamp`` must be a TIMESTAMP.
    """
    routed = connector_checked(lambda: df.select(
        F.lit(topic).alias("topic"),
        route_partition(route, n_partitions).alias("partition"),
        F.col(order_col).alias(ORDER_COL),
        key.cast("string").cast("binary").alias("key"),
        encode_column(payload_cols, fmt, avro_schema).alias("value"),
        timestamp.alias("timestamp"),
    ), fmt)
    return assign_sequence(routed, ["topic", "partition"], ORDER_COL, "offset", block_rows).select(*LOG_COLUMNS)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log written by ``sinks.tables.write_log``, in MESSAGE_LOG column order."""
    return spark.read.schema(MESSAGE_LOG).parquet(path).select(*LOG_COLUMNS)


def ntz_as_utc_instant(ts) -> Column:
    """A TIMESTAMP_NTZ read as UTC wall-clock -> TIMESTAMP (instant)."""
    return F.timestamp_micros(epoch_micros(ts))


# --- bounded reads ---------------------------------------------------------------

def _as_ranges(bounds) -> list[OffsetRange]:
    """Ranges as a list.  A DataFrame of bounds (one row per topic partition) is collected, as connector
    options ask for; reads of a log at rest join with it instead."""
    if isinstance(bounds, DataFrame):
        rows = bounds.select("topic", "partition", "from_offset", "until_offset").collect()
        return [OffsetRange(r[0], int(r[1]), r[2], r[3]) for r in rows]
    return [b if isinstance(b, OffsetRange) else OffsetRange(*b) for b in bounds]


def _any(tests: list[Column]) -> Column:
    """A balanced OR, so that many ranges do not nest deep."""
    if len(tests) == 1:
        return tests[0]
    half = len(tests) // 2
    return _any(tests[:half]) | _any(tests[half:])


def _within(r: tuple[int | None, int | None]) -> Column:
    test = F.lit(True)
    if r[0] is not None:
        test = F.col("offset") >= F.lit(int(r[0]))
    if r[1] is not None:
        upper = F.col("offset") < F.lit(int(r[1]))
        test = test & upper if r[0] is not None else upper
    return test


def _ranges_predicate(ranges: list[OffsetRange]) -> Column:
    """One test per distinct pair of bounds: topic, ``partition IN (...)``, offsets."""
    grouped: dict[tuple, list[int]] = defaultdict(list)
    for r in ranges:
        grouped[r.topic, r.from_offset, r.until_offset].append(int(r.partition))
    return _any([
        (F.col("topic") == F.lit(topic)) & F.col("partition").isin(sorted(set(parts))) & _within((lo, hi))
        for (topic, lo, hi), parts in grouped.items()
    ])


def read_offset_range(log: DataFrame, bounds: Iterable | DataFrame) -> DataFrame:
    """Messages with ``from <= offset < until`` in each given partition.

    A list of :class:`OffsetRange` / tuples becomes a plain predicate, one test per distinct pair of
    bounds whatever their number, so partition pruning and row-group skipping on the offset reach the
    Parquet scan.  A DataFrame with columns ``topic, partition, from_offset, until_offset`` is computed
    once, into the scratch folder (one row per partition): its least and greatest bound, and up to
    ``LISTED_BOUNDS`` partitions, become literals at the scan, and the log is joined with it.  No bounds read
    nothing.
    """
    if not isinstance(bounds, DataFrame):
        ranges = _as_ranges(bounds)
        return log.filter(_ranges_predicate(ranges)) if ranges else log.filter(F.lit(False))
    own = scratch_path(log.sparkSession, "bounds")
    bounds.select(
        F.col("topic").alias("__t"), F.col("partition").cast("int").alias("__p"),
        F.col("from_offset").cast("long").alias("__lo"), F.col("until_offset").cast("long").alias("__hi"),
    ).write.parquet(own)
    table = log.sparkSession.read.schema("__t string, __p int, __lo long, __hi long").parquet(own)
    few = table.limit(LISTED_BOUNDS + 1).collect()
    if not few:
        return log.filter(F.lit(False))
    listed = len(few) <= LISTED_BOUNDS
    least, most = F.min(F.coalesce("__lo", F.lit(-(1 << 63)))).alias("lo"), F.max(F.coalesce("__hi", F.lit((1 << 63) - 1))).alias("hi")
    lo, hi = (None, None) if listed else table.agg(least, most).first()
    if listed:
        lo = None if any(r["__lo"] is None for r in few) else min(r["__lo"] for r in few)
        hi = None if any(r["__hi"] is None for r in few) else max(r["__hi"] for r in few)
    window = log.filter(_within((lo, hi)))
    if listed:  # these partitions only; a NULL topic or partition holds nothing
        window = window.filter(_ranges_predicate([OffsetRange(*p) for p in sorted({(r["__t"], r["__p"]) for r in few if None not in (r["__t"], r["__p"])})] or [OffsetRange("", -1)]))
    inside = F.col("offset").between(F.coalesce("__lo", F.col("offset")), F.coalesce(F.col("__hi") - 1, F.col("offset")))
    same = (F.col("topic") == F.col("__t")) & (F.col("partition") == F.col("__p"))
    side = F.broadcast(table) if listed or table.count() <= BROADCAST_BOUNDS else table
    return window.join(side, same & inside).select(*log.columns)


def read_from_offsets(log: DataFrame, starts: Iterable | DataFrame) -> DataFrame:
    """Messages at or after a start offset per partition (open end)."""
    if isinstance(starts, DataFrame):
        return read_offset_range(log, starts.withColumn("until_offset", F.lit(None).cast("long")))
    ranges = [OffsetRange(r.topic, r.partition, r.from_offset, None) for r in _as_ranges(starts)]
    return read_offset_range(log, ranges)


def resume_points(starts: DataFrame) -> list[OffsetRange]:
    """``operators.offsets.starting_offsets`` rows -> ranges to start a new reader from.

    One row per topic partition.
    """
    return _as_ranges(starts.selectExpr("topic", "partition", "next_offset AS from_offset",
                                        "CAST(NULL AS BIGINT) AS until_offset"))


# --- streams ------------------------------------------------------------------------

def read_log_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    starts: Iterable | None = None,
) -> DataFrame:
    """A streaming DataFrame over a log directory of Parquet files.

    ``starts`` (ranges with ``from_offset``) keeps only messages at or after
    those offsets in the listed partitions; other partitions pass whole.
    """
    reader = spark.readStream.schema(MESSAGE_LOG)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(path)
    if not starts:
        return stream
    ranges = [OffsetRange(r.topic, r.partition, r.from_offset, None) for r in _as_ranges(starts)]
    listed = _ranges_predicate([OffsetRange(r.topic, r.partition) for r in ranges])
    return stream.filter(~listed | _ranges_predicate(ranges))


# --- Kafka --------------------------------------------------------------------------

def kafka_offsets_json(ranges: list[OffsetRange], which: str) -> str:
    """``startingOffsets`` / ``endingOffsets`` text; open ends become -2 / -1."""
    spec: dict[str, dict[str, int]] = {}
    for r in ranges:
        if which == "start":
            value = -2 if r.from_offset is None else int(r.from_offset)
        else:
            value = -1 if r.until_offset is None else int(r.until_offset)
        spec.setdefault(r.topic, {})[str(r.partition)] = value
    return json.dumps(spec, sort_keys=True)


def kafka_assign_json(ranges: list[OffsetRange]) -> str:
    """``assign`` text: the listed partitions only (``subscribe`` would read every partition)."""
    spec: dict[str, list[int]] = {}
    for r in ranges:
        spec.setdefault(r.topic, []).append(int(r.partition))
    return json.dumps({t: sorted(set(ps)) for t, ps in spec.items()}, sort_keys=True)


def is_missing_source(exc: Exception, name: str) -> bool:
    """Whether a read or write failed because the data source ``name`` is not on the classpath."""
    text = str(exc).lower()
    return name in text and ("find data source" in text or "data_source_not_found" in text)


def _kafka_load(builder, what: str):
    try:
        return builder.load()
    except Exception as exc:  # the JVM error names the missing data source
        if is_missing_source(exc, "kafka"):
            raise MissingConnectorError(
                f"{what} needs the spark-sql-kafka package on the classpath (spark.jars.packages)"
            ) from exc
        raise


def read_kafka_range(spark: SparkSession, bootstrap_servers: str, bounds: Iterable | DataFrame) -> DataFrame:
    """S3 on Kafka: a bounded batch read of exactly the given topic partitions and ranges.

    Inverted ranges (interior bounds of a single batch) hold nothing and are left out; without any
    range the result is empty and Kafka is not asked.
    """
    ranges = [
        r for r in _as_ranges(bounds)
        if r.from_offset is None or r.until_offset is None or r.from_offset < r.until_offset
    ]
    if not ranges:
        return spark.createDataFrame([], MESSAGE_LOG).select(*LOG_COLUMNS)
    builder = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("assign", kafka_assign_json(ranges))
        .option("startingOffsets", kafka_offsets_json(ranges, "start"))
        .option("endingOffsets", kafka_offsets_json(ranges, "end"))
    )
    return _kafka_load(builder, "read_kafka_range").select(*LOG_COLUMNS)


def read_kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str | None = None,
                      max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S1/S2 on Kafka: an unbounded stream, optionally from recorded offsets.

    ``start_ingest`` caches the micro-batches of such a stream (``cache_batch``), so each is fetched
    from the brokers once.
    """
    builder = spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("subscribe", topic)
    if starting_offsets:
        builder = builder.option("startingOffsets", starting_offsets)
    if max_offsets_per_trigger:
        builder = builder.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return _kafka_load(builder, "read_kafka_stream").select(*LOG_COLUMNS)
