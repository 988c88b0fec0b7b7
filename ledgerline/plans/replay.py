"""M1/M2/M6: bounded replay of a log into a table, by offsets or by time.

One lazy plan per replay: range filter (pushed into the log scan) -> decode
-> partition fields -> transform chain -> write.  The offset-log lookup of a
time range stays a DataFrame of one row per partition.
"""

from __future__ import annotations

from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.timefields import partition_fields
from ledgerline.operators.codec import BAD_COL, decode_payload
from ledgerline.operators.offsets import resolve_range
from ledgerline.operators.transform import transform_chain
from ledgerline.plans.versions import merge_version, version_stamp
from ledgerline.schemas import PARTITION_FIELDS
from ledgerline.sinks.tables import append_partitioned, create_like, insert_into, offset_deltas_name, path_missing, version_names
from ledgerline.sources.log import _as_ranges, read_kafka_range, read_offset_range

RAW_COL = "__message"

# Fixed value: the layout of time-range arguments (UTC).
MINUTE_TEXT_LAYOUT = "%Y%m%dT%H:%M"


def minute_text_to_epoch(text: str) -> int:
    """``YYYYMMDDTHH:MM`` (UTC) -> epoch seconds, for driver-side arguments."""
    return int(datetime.strptime(text, MINUTE_TEXT_LAYOUT).replace(tzinfo=timezone.utc).timestamp())


def _epoch(t: int | str) -> int:
    return minute_text_to_epoch(t) if isinstance(t, str) else int(t)


ON_BAD = ("fail", "quarantine", "drop")


def decode_messages(
    messages: DataFrame,
    schema: T.StructType,
    time_field: str,
    fmt: str = "json",
    with_year: bool = False,
    quarantine: str | None = None,
    on_bad: str | None = None,
    avro_schema: str | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """Decode message values and derive ``mon, day, hour`` from ``time_field`` (epoch ms).

    A bad payload (see ``decode_payload``; ``time_field`` is required) never reaches the table.
    ``on_bad`` says what it does: ``fail`` (default) fails the job that meets it and names the message;
    ``quarantine`` (default if the path ``quarantine`` is given) first writes the raw bad messages to that
    path, which must be new; ``drop`` leaves it out.  ``counts``, an ``Observation``, gets ``rows`` and
    ``bad_rows`` once the result is computed.
    """
    on_bad = on_bad or ("quarantine" if quarantine else "fail")
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad is one of {ON_BAD}")
    if (on_bad == "quarantine") != bool(quarantine):
        raise ValueError("give a quarantine path for on_bad='quarantine', and only then")
    raw = F.struct("topic", "partition", "offset", "key", "value")
    decoded = decode_payload(messages.withColumn(RAW_COL, raw), schema, fmt=fmt, keep=[RAW_COL], avro_schema=avro_schema,
                             required=[time_field])
    if quarantine:
        decoded.filter(F.col(BAD_COL)).select(f"{RAW_COL}.*").write.mode("errorifexists").parquet(quarantine)
    if counts is not None:
        decoded = decoded.observe(counts, F.count(F.lit(1)).alias("rows"), F.sum(F.col(BAD_COL).cast("long")).alias("bad_rows"))
    if on_bad == "fail":
        name = F.concat_ws(" ", F.lit("bad payload:"), f"{RAW_COL}.topic", f"{RAW_COL}.partition", f"{RAW_COL}.offset")
        good = decoded.filter(F.when(F.col(BAD_COL), F.raise_error(name).cast("boolean")).otherwise(F.lit(True)))
    else:
        good = decoded.filter(~F.col(BAD_COL))
    return good.select(*[f.name for f in schema.fields], *partition_fields(time_field, with_year))


def replay_offsets(
    log: DataFrame,
    bounds,
    schema: T.StructType,
    time_field: str,
    steps=None,
    sink: str | None = None,
    fmt: str = "json",
    table: str | None = None,
    quarantine: str | None = None,
    on_bad: str | None = None,
    avro_schema: str | None = None,
    with_year: bool = False,
    counts: Observation | None = None,
) -> DataFrame:
    """M1: replay ``[from, until)`` per partition, transformed.

    The rows are appended to the Parquet folder ``sink`` and/or the catalog
    table ``table`` (``db.name``), partitioned by ``mon, day, hour`` (``with_year``: ``year`` first).
    They are written there and nowhere else, and the result is a read of the files that the replay added
    (one writer to a table at a time), so using it does not replay again.
    """
    messages = read_offset_range(log, bounds)
    decoded = decode_messages(messages, schema, time_field, fmt, with_year, quarantine, on_bad, avro_schema, counts)
    out = transform_chain(decoded, steps)
    if not sink and not table:
        return out
    parts = [c for c in ("year", *PARTITION_FIELDS) if c in out.columns]
    spark = log.sparkSession
    before = _files(spark, sink, table)
    append_partitioned(out, path=sink, table=table, partition_cols=parts)
    added = sorted(_files(spark, sink, table) - before)
    if not added:
        return spark.createDataFrame([], out.schema)
    root = added[0].split(f"/{parts[0]}=")[0]
    return spark.read.schema(out.schema).option("basePath", root).parquet(*added).select(*out.columns)


def _files(spark: SparkSession, sink: str | None, table: str | None) -> set[str]:
    """The files of a table or folder; none if it is not there yet."""
    if table and not spark.catalog.tableExists(table):
        return set()
    try:
        return {unquote(f) for f in (spark.table(table) if table else spark.read.schema("x int").parquet(sink)).inputFiles()}
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
    return set()


def replay_time(
    log: DataFrame,
    offset_log: DataFrame,
    appname: str,
    begin: int | str,
    end: int | str,
    schema: T.StructType,
    time_field: str,
    steps=None,
    mode: str = "covering",
    sink: str | None = None,
    fmt: str = "json",
    table: str | None = None,
    **more,
) -> DataFrame:
    """M2: replay the batches recorded in ``(begin, end]`` (epoch s or minute text); ``more`` as in
    :func:`replay_offsets`."""
    bounds = resolve_range(offset_log, appname, _epoch(begin), _epoch(end), mode)
    return replay_offsets(log, bounds, schema, time_field, steps, sink, fmt, table, **more)


def replay_kafka_time(
    spark: SparkSession,
    bootstrap_servers: str,
    offset_log: DataFrame,
    appname: str,
    begin: int | str,
    end: int | str,
    schema: T.StructType,
    time_field: str,
    steps=None,
    mode: str = "covering",
    **more,
) -> DataFrame:
    """M2 straight from Kafka: the offsets recorded in ``(begin, end]`` are read from the brokers."""
    bounds = resolve_range(offset_log, appname, _epoch(begin), _epoch(end), mode)
    ranges = _as_ranges(bounds)
    messages = read_kafka_range(spark, bootstrap_servers, ranges)
    return replay_offsets(messages, ranges, schema, time_field, steps, **more)


def replay_and_merge(
    log: DataFrame,
    bounds,
    schema: T.StructType,
    time_field: str,
    base_table: str,
    keys,
    start_offset: int,
    version: str | None = None,
    steps=None,
    folder: str | None = None,
    **more,
) -> str:
    """M6: replay a range into the deltas table ``<base_table>_<start_offset>_deltas``, made like the base
    table, and merge it with the base into a new version; returns the version's name.

    The log is decoded once.  ``folder`` places the two tables (else the warehouse does).
    """
    spark = log.sparkSession
    place = lambda name: None if folder is None else f"{folder.rstrip('/')}/{name}"
    deltas = offset_deltas_name(base_table, start_offset)
    if spark.catalog.tableExists(deltas):
        raise ValueError(f"{deltas} exists already")
    create_like(spark, deltas, base_table, path=place(deltas))
    replayed = replay_offsets(log, bounds, schema, time_field, steps, **more)
    insert_into(spark, replayed.select(*spark.table(base_table).columns), deltas)
    parts = [c.name for c in spark.catalog.listColumns(base_table) if c.isPartition]
    version = version or version_stamp()
    name = version_names(base_table, version)["version"]
    return merge_version(spark, base_table, spark.table(deltas), keys, version, path=place(name), partition_cols=parts)
