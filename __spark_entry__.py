"""

Every query reads the driver's tables from ``sf_dir`` (``events`` published
as a message log, ``orders`` / ``lineitem`` as table versions, ``documents``
as text to clean and publish) and runs over them whole.  Each has a DuckDB
twin in :func:`oracle_sql` with the same column names.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.casts import safe_cast
from ledgerline.functions.routing import route_partition
from ledgerline.functions.text import keyword_match, printable_ascii
from ledgerline.functions.timefields import (
    epoch_millis,
    millis_to_seconds,
    minute_text,
    parse_minute_text,
    partition_fields,
    reverse_time_key,
)
from ledgerline.operators.audit import audit_offsets, range_islands
from ledgerline.operators.codec import decode_payload
from ledgerline.operators.keywords import keyword_semi_join
from ledgerline.operators.merge import merge_by_key, merge_chain, prefilter_for, unchanged_rows
from ledgerline.operators.offsets import (
    batch_counts,
    batch_offsets,
    carry_forward,
    cells_to_ranges,
    hourly_batches,
    latest_offsets,
    newest_batches,
    offset_cells,
    resolve_range,
    starting_offsets,
)
from ledgerline.operators.transform import preview, transform_chain
from ledgerline.plans import events as ev
from ledgerline.plans.buckets import merge_bucketed_version, write_bucketed
from ledgerline.plans.publish import publish
from ledgerline.plans.replay import decode_messages, minute_text_to_epoch, replay_and_merge, replay_offsets, replay_time
from ledgerline.plans.versions import merge_chain_version, merge_version
from ledgerline.schemas import EVENT_RECORD
from ledgerline.session import scratch_path
from ledgerline.sinks.manifest import committed_offsets, compact_committed, read_committed
from ledgerline.sinks.snapshots import latest_recorded, snapshot_offsets
from ledgerline.sinks.tables import (
    append_partitioned,
    create_like,
    insert_into,
    offset_deltas_name,
    publish_log,
    table_columns,
    version_names,
    write_delimited,
    write_log,
)
from ledgerline.sources.delimited import read_delimited
from ledgerline.sources.log import OffsetRange, read_from_offsets, read_log, read_log_stream, read_offset_range
from ledgerline.streaming.ingest import drain, run_batches, start_ingest

SMOKE_DIR = "/root/testdata/sf0.001"

# Query parameters (fixed values).
REPLAY_BOUNDS = [  # [from, until) per partition; None = open end
    OffsetRange("events", 0, 250, 1000),
    OffsetRange("events", 1, 0, None),
    OffsetRange("events", 2, 1000, None),
    OffsetRange("events", 3, 500, 2500),
]
RESUME_AT = 1705363200  # the starting-offset read resumes after the batches recorded up to 2024-01-16, UTC
RANGE_BEGIN, RANGE_END = 1704412800, 1705017600  # (2024-01-05, 2024-01-12], UTC
BASE_BEGIN, BASE_END = "20240101T00:00", "20240120T00:00"  # replay-and-merge base range
DELTA_BEGIN, DELTA_END = "20240115T00:00", "20240131T00:00"  # replay-and-merge delta range
KEYWORDS = ["the", "les"]
ROUTE_PARTITIONS = 16
PUBLISH_PARTITIONS = 8
NEWEST_N = 10
PREVIEW_N = 5
BAD_EVERY = 7  # of seven event ids, those with these remainders get a bad payload in decode_bad_rows
BAD_PREFIX_BYTES = 5
BAD_FORMS = {0: "cut", 1: "empty", 2: "blank", 3: "no field", 4: "trailing"}
QUARANTINE_EVERY = 10  # in the quarantine queries
ORDERS_BASE_BEFORE = "1999-01-01"  # base version: orders placed before
ORDERS_DELTA_FROM = "1998-01-01"  # deltas: orders placed from, status set to U
SHIP_BASE_BEFORE = "1999-01-01"
SHIP_DELTA_FROM = "1998-01-01"
STREAM_TIMEOUT_S = 1800
CHAIN_YEARS = ("1996", "1997", "1998")  # merge-chain deltas: orders from the year on, status set to the ordinal
AUDIT_BATCH = 100  # offsets of a batch in the audit queries
AUDIT_SKIP, AUDIT_AGAIN = (10, 3), (7, 2)  # batches left out, and batches that begin early: id % a = b
AUDIT_EARLY = 5  # offsets by which they do
AUDIT_HOLE = (50, (1, 2))  # offsets that the log has lost: offset % a in b
IDLE_STRETCH = 250  # offsets of a source file in the stream with idle partitions
BUCKETS = 8
BENCH_PAIR, BENCH_WORD = r"([a-z]{4,} [a-z]{5,})", r"([a-z]{11,})"  # terms of a benchmark text: its first long pair, its first long word
ODD_APPS = ("app+1", "caf\u00e9, =1%")  # names that need care in paths
DELTA_STEPS = {  # replay-and-merge: the deltas carry upper-cased event types
    "sql01": "SELECT event_id, ts_ms, user_id, upper(event_type) AS event_type, value, props, mon, day, hour",
}


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ev.table(spark, sf_dir, name)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.events_log(spark, sf_dir)


def _log_at_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log written once under the shared scratch folder, read back with scan pushdown.

    Pays off when a query reads the log four times (two range look-ups, two replays); a single
    replay reads the derived log twice and is cheaper without the write."""
    path = scratch_path(spark, "log")
    write_log(_log(spark, sf_dir), path)
    return read_log(spark, path)


def _log_view(log: DataFrame) -> DataFrame:
    return log.select("topic", "partition", "offset", F.col("key").cast("string").alias("key_text"))


def _offset_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.hourly_offset_log(_log(spark, sf_dir))


def _records_with_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = ev.event_records(_t(spark, sf_dir, "events"))
    return rec.select(*ev.EVENT_COLUMNS, *partition_fields("ts_ms"))


# --- log and sources ------------------------------------------------------------------

def q_message_log(spark, sf_dir):
    log = _log(spark, sf_dir)
    return log.select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key_text"),
        F.unix_micros("timestamp").alias("timestamp_us"),
    )


def q_offset_range_read(spark, sf_dir):
    return _log_view(read_offset_range(_log(spark, sf_dir), REPLAY_BOUNDS))


def q_starting_offset_read(spark, sf_dir):
    log = _log_at_rest(spark, sf_dir)
    recorded = ev.hourly_offset_log(log).filter(F.col("batch_ts") <= RESUME_AT)
    starts = starting_offsets(recorded, ev.APPNAME).withColumnRenamed("next_offset", "from_offset")
    return _log_view(read_from_offsets(log, starts))


def q_decode_payload(spark, sf_dir):
    return decode_payload(_log(spark, sf_dir), EVENT_RECORD)


def q_decode_bad_rows(spark, sf_dir):
    log = _log(spark, sf_dir)
    kind = F.pmod(F.col("key").cast("string").cast("long"), F.lit(BAD_EVERY))
    bad = log.withColumn(
        "value",
        F.when(kind == 0, F.substring("value", 1, BAD_PREFIX_BYTES))
        .when(kind == 1, F.lit(b""))
        .when(kind == 2, F.lit(b" \t\n"))
        .when(kind == 3, F.lit(b"{}"))
        .when(kind == 4, F.concat("value", F.lit(b'{"x"')))
        .otherwise(F.col("value")),
    )
    return decode_payload(bad.withColumn("key_text", F.col("key").cast("string")), EVENT_RECORD, keep=["key_text"])


# --- scalar functions ---------------------------------------------------------------------

def q_partition_fields(spark, sf_dir):
    rec = ev.event_records(_t(spark, sf_dir, "events"))
    return rec.select("event_id", "ts_ms", millis_to_seconds("ts_ms").alias("ts_s"), *partition_fields("ts_ms"))


def q_parse_minute_text(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", minute_text("ts").alias("minute_text"))
    return e.select("event_id", "minute_text", parse_minute_text("minute_text").alias("minute_s"))


def q_reverse_time_key(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", reverse_time_key(ev.APPNAME, millis_to_seconds(epoch_millis("ts"))).alias("row_key"))


def q_sanitize_text(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", printable_ascii("text").alias("text_clean"))


def q_sanitize_upper(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.upper(printable_ascii("text")).alias("text_upper"))


def q_keyword_filter(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.filter(keyword_match("text", KEYWORDS)).select("doc_id", "lang", "source")


def q_route_partition(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", "user_id", route_partition("user_id", ROUTE_PARTITIONS).alias("partition"))


def q_safe_casts(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.select(
        "event_id",
        safe_cast(F.col("event_id").cast("string"), "bigint").alias("id_from_text"),
        safe_cast("event_type", "int").alias("type_as_int"),
        safe_cast(F.regexp_extract("props", r":\s*(-?\d+)", 1), "int").alias("prop_k"),
        safe_cast("props", "int").alias("props_as_int"),
        safe_cast(F.col("value").cast("string"), "double").alias("value_round_trip"),
    )


# --- transform chain ------------------------------------------------------------------------

def q_transform_chain(spark, sf_dir):
    return transform_chain(_records_with_fields(spark, sf_dir), ev.EVENT_STEPS)


def q_preview(spark, sf_dir):
    decoded = decode_payload(_log(spark, sf_dir), EVENT_RECORD)
    return preview(decoded, PREVIEW_N, ["event_id"])


# --- offset log -----------------------------------------------------------------------------

def q_offset_log(spark, sf_dir):
    return _offset_log(spark, sf_dir)


def q_batch_counts(spark, sf_dir):
    return batch_counts(hourly_batches(_log(spark, sf_dir), ev.BATCH_SECONDS))


def q_split_cells(spark, sf_dir):
    return cells_to_ranges(offset_cells(_offset_log(spark, sf_dir)))


def q_range_covering(spark, sf_dir):
    return resolve_range(_offset_log(spark, sf_dir), ev.APPNAME, RANGE_BEGIN, RANGE_END, "covering")


def q_range_interior(spark, sf_dir):
    return resolve_range(_offset_log(spark, sf_dir), ev.APPNAME, RANGE_BEGIN, RANGE_END, "interior")


def q_newest_batches(spark, sf_dir):
    return newest_batches(_offset_log(spark, sf_dir), ev.APPNAME, NEWEST_N)


def q_latest_offsets(spark, sf_dir):
    return latest_offsets(_offset_log(spark, sf_dir), ev.APPNAME)


def q_starting_offsets(spark, sf_dir):
    return starting_offsets(_offset_log(spark, sf_dir), ev.APPNAME)


def q_offset_log_idle(spark, sf_dir):
    """The hourly offset log with a row for every known partition in every batch."""
    return carry_forward(_offset_log(spark, sf_dir))


def q_range_interior_idle(spark, sf_dir):
    """Interior bounds when idle partitions are recorded too: all from the same two batches."""
    return resolve_range(carry_forward(_offset_log(spark, sf_dir)), ev.APPNAME, RANGE_BEGIN, RANGE_END, "interior")


def _faulty_batches(spark, sf_dir):
    """The log cut into batches by offset, some left out and some reaching into the one before."""
    log = _log(spark, sf_dir)
    cut = batch_offsets(log, ev.APPNAME, F.floor(F.col("offset") / AUDIT_BATCH))
    kept = cut.filter(F.pmod("batch_id", F.lit(AUDIT_SKIP[0])) != AUDIT_SKIP[1])
    again = F.pmod("batch_id", F.lit(AUDIT_AGAIN[0])) == AUDIT_AGAIN[1]
    return log, kept.withColumn("start_offset", F.col("start_offset") - F.when(again, AUDIT_EARLY).otherwise(0))


def q_continuity_audit(spark, sf_dir):
    """Offsets never ingested, ingested twice, lost from the log, or yet to come."""
    log, batches = _faulty_batches(spark, sf_dir)
    kept = log.filter(~F.pmod("offset", F.lit(AUDIT_HOLE[0])).isin(*AUDIT_HOLE[1]))
    return audit_offsets(batches, kept, slice_width=1 << 10).drop("appname")


def q_range_islands(spark, sf_dir):
    """What the recorded batches cover, as the fewest ranges."""
    return range_islands(_faulty_batches(spark, sf_dir)[1]).drop("appname")


def q_latest_recorded(spark, sf_dir):
    """The latest offsets from a snapshot of the first batches and the folders of the later ones."""
    path, olog = scratch_path(spark, "offsets"), _offset_log(spark, sf_dir)
    olog.filter(F.col("batch_ts") <= RESUME_AT).write.partitionBy("appname", "batch_id").parquet(path)
    snapshot_offsets(spark, path, ev.APPNAME)
    olog.filter(F.col("batch_ts") > RESUME_AT).write.mode("append").partitionBy("appname", "batch_id").parquet(path)
    return latest_recorded(spark, path, ev.APPNAME)


def q_rows_as_bounds(spark, sf_dir):
    """Resume points as plain rows, made a table again with their schema, and read from."""
    log = _log_at_rest(spark, sf_dir)
    recorded = ev.hourly_offset_log(log).filter(F.col("batch_ts") <= RESUME_AT)
    points = [tuple(r) for r in starting_offsets(recorded, ev.APPNAME).collect()]  # one row per partition
    starts = spark.createDataFrame(points, "topic string, partition int, from_offset long")
    return _log_view(read_from_offsets(log, starts))


# --- replay ------------------------------------------------------------------------------------

def q_replay_offsets(spark, sf_dir):
    return replay_offsets(_log(spark, sf_dir), REPLAY_BOUNDS, EVENT_RECORD, "ts_ms", ev.EVENT_STEPS)


def q_replay_time(spark, sf_dir):
    log = _log(spark, sf_dir)
    return replay_time(log, ev.hourly_offset_log(log), ev.APPNAME, RANGE_BEGIN, RANGE_END, EVENT_RECORD, "ts_ms",
                       ev.EVENT_STEPS, mode="covering")


def q_replay_time_interior(spark, sf_dir):
    log = _log(spark, sf_dir)
    return replay_time(log, ev.hourly_offset_log(log), ev.APPNAME, RANGE_BEGIN, RANGE_END, EVENT_RECORD, "ts_ms",
                       ev.EVENT_STEPS, mode="interior")


def _base_and_deltas(spark, sf_dir, partition_cols=()):
    """The replayed base as a catalog table, the log, its offset log, and the deltas' bounds."""
    log = _log_at_rest(spark, sf_dir)
    olog = ev.hourly_offset_log(log)
    folder = scratch_path(spark, "tables")
    base = _unique_name("events_base")
    rows = replay_time(log, olog, ev.APPNAME, BASE_BEGIN, BASE_END, EVENT_RECORD, "ts_ms")
    append_partitioned(rows, path=f"{folder}/{base}", table=base, partition_cols=partition_cols)
    bounds = resolve_range(olog, ev.APPNAME, minute_text_to_epoch(DELTA_BEGIN), minute_text_to_epoch(DELTA_END))
    return log, base, bounds, folder


def q_replay_and_merge(spark, sf_dir):
    """Replay the base into a table, the deltas into a table like it, merge both into a version."""
    log, base, bounds, folder = _base_and_deltas(spark, sf_dir)
    return spark.table(replay_and_merge(log, bounds, EVENT_RECORD, "ts_ms", base, "event_id", 0, "v1", DELTA_STEPS, folder))


def q_replay_to_version(spark, sf_dir):
    """The deltas table and the version that one replay-and-merge made, side by side, by day."""
    log, base, bounds, folder = _base_and_deltas(spark, sf_dir, ["mon", "day"])
    version = replay_and_merge(log, bounds, EVENT_RECORD, "ts_ms", base, "event_id", 7, "v2", DELTA_STEPS, folder)
    deltas = spark.table(offset_deltas_name(base, 7)).withColumn("kind", F.lit("deltas"))
    return deltas.unionByName(spark.table(version).withColumn("kind", F.lit("version")))


def q_replay_quarantine(spark, sf_dir):
    """A replay over a log with bad payloads: the good rows, and the raw messages in quarantine."""
    log = _log(spark, sf_dir)
    event_id = F.col("key").cast("string").cast("long")
    some = log.withColumn("value", F.when(F.pmod(event_id, F.lit(QUARANTINE_EVERY)) == 3, F.lit(b"{}")).otherwise(F.col("value")))
    path = scratch_path(spark, "quarantine")
    good = replay_offsets(some, REPLAY_BOUNDS, EVENT_RECORD, "ts_ms", quarantine=path)
    bad = spark.read.parquet(path).select(F.col("key").cast("string").cast("long").alias("event_id"), F.lit(True).alias("quarantined"))
    return good.select("event_id", F.lit(False).alias("quarantined")).unionByName(bad)


# --- versions ---------------------------------------------------------------------------------

def _orders_versions(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    base = o.filter(F.col("o_orderdate") < F.lit(ORDERS_BASE_BEFORE).cast("timestamp_ntz"))
    deltas = o.filter(F.col("o_orderdate") >= F.lit(ORDERS_DELTA_FROM).cast("timestamp_ntz")).withColumn(
        "o_orderstatus", F.lit("U"))
    return base, deltas


def q_unchanged_rows(spark, sf_dir):
    base, deltas = _orders_versions(spark, sf_dir)
    return unchanged_rows(base, deltas, "o_orderkey")


def q_merge_by_key(spark, sf_dir):
    base, deltas = _orders_versions(spark, sf_dir)
    return merge_by_key(base, deltas, "o_orderkey")


def _lineitem_versions(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    base = li.filter(F.col("l_shipdate") < F.lit(SHIP_BASE_BEFORE).cast("timestamp_ntz"))
    deltas = li.filter(F.col("l_shipdate") >= F.lit(SHIP_DELTA_FROM).cast("timestamp_ntz")).withColumn(
        "l_linestatus", F.lit("U"))
    return base, deltas


def q_merge_composite_key(spark, sf_dir):
    return merge_by_key(*_lineitem_versions(spark, sf_dir), ["l_orderkey", "l_linenumber"])


def _some_keys_null(orders):
    return orders.withColumn("o_orderkey", F.when(F.pmod("o_custkey", F.lit(5)) != 0, F.col("o_orderkey")))


def q_merge_null_keys(spark, sf_dir):
    """The merge with NULL keys on both sides: they match nothing and all stay."""
    base, deltas = (_some_keys_null(df) for df in _orders_versions(spark, sf_dir))
    return merge_by_key(base, deltas, "o_orderkey")


def q_merge_prefiltered(spark, sf_dir):
    """The merge on two keys with a filter over the delta keys: only possible matches are joined."""
    base, deltas, keys = *_lineitem_versions(spark, sf_dir), ["l_orderkey", "l_linenumber"]
    return merge_by_key(base, deltas, keys, prefilter_for(base, deltas, keys, few=0))


def q_merge_null_prefiltered(spark, sf_dir):
    """The merge with NULL keys on both sides, with a filter."""
    base, deltas = (_some_keys_null(df) for df in _orders_versions(spark, sf_dir))
    return merge_by_key(base, deltas, "o_orderkey", prefilter_for(base, deltas, "o_orderkey", few=0))


def _order_chain(spark, sf_dir):
    """Three delta tables of orders, each from a later year on."""
    o = _t(spark, sf_dir, "orders")
    return [o.filter(F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")).withColumn("o_orderstatus", F.lit(str(i)))
            for i, year in enumerate(CHAIN_YEARS)]


def q_merge_chain(spark, sf_dir):
    """A base and three delta tables in one pass; for each key the newest table that holds it wins."""
    base, _ = _orders_versions(spark, sf_dir)
    return merge_chain(_some_keys_null(base), [_some_keys_null(d) for d in _order_chain(spark, sf_dir)], "o_orderkey")


def q_merge_bucketed(spark, sf_dir):
    """Two merges of a bucketed base, each into a bucketed version, without an exchange of the base."""
    name = _unique_name("orders_bucketed")
    base, _ = _orders_versions(spark, sf_dir)
    write_bucketed(base, name, BUCKETS, ["o_orderkey"], scratch_path(spark, "tables", name))
    for deltas, year in zip(_order_chain(spark, sf_dir), CHAIN_YEARS, strict=True):
        name = merge_bucketed_version(spark, name, deltas, f"v{year}", scratch_path(spark, "tables", name, year))
    return spark.table(name)


def q_merge_chain_version(spark, sf_dir):
    """The same chain as catalog tables, into the version of the last, with a filter."""
    name, versions = _unique_name("orders"), [f"v{y}" for y in CHAIN_YEARS]
    base, _ = _orders_versions(spark, sf_dir)
    tables = {name: base} | {version_names(name, v)["deltas"]: d for v, d in zip(versions, _order_chain(spark, sf_dir), strict=True)}
    for table, rows in tables.items():
        rows.write.format("parquet").option("path", scratch_path(spark, "tables", table)).saveAsTable(table)
    return spark.table(merge_chain_version(spark, name, versions, "o_orderkey", scratch_path(spark, "tables", name), prefilter=True, few=0))


def _unique_name(prefix: str) -> str:
    return f"{prefix}_{os.urandom(6).hex()}"


def q_version_table(spark, sf_dir):
    base, deltas = _orders_versions(spark, sf_dir)
    name = _unique_name("orders")
    base.write.format("parquet").option("path", scratch_path(spark, "tables", name)).saveAsTable(name)
    version_table = merge_version(spark, name, deltas, "o_orderkey", version="v1", path=scratch_path(spark, "tables", name + "_v1"))
    return spark.table(version_table)


def q_partitioned_table(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    append_partitioned(decode_messages(_log(spark, sf_dir), EVENT_RECORD, "ts_ms"), path=path)
    return spark.read.parquet(path)


def q_create_like_append(spark, sf_dir):
    rows = decode_messages(_log(spark, sf_dir), EVENT_RECORD, "ts_ms")
    template, clone = _unique_name("events_template"), _unique_name("events_clone")
    rows.limit(0).write.format("parquet").partitionBy("mon", "day", "hour").option(
        "path", scratch_path(spark, "tables", template)).saveAsTable(template)
    create_like(spark, clone, template, path=scratch_path(spark, "tables", clone))
    insert_into(spark, rows, clone)
    return spark.table(clone)


def q_table_columns(spark, sf_dir):
    # the given orders file as an external catalog table, listed through the catalog
    name = _unique_name("orders_ext")
    spark.catalog.createTable(name, path=os.path.join(sf_dir, "orders.parquet"), source="parquet")
    return table_columns(spark, name).select("name", "ordinal")


def q_delimited_round_trip(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    path = scratch_path(spark, "delimited")
    write_delimited(docs, path)
    return read_delimited(spark, path, docs.schema)


def q_delimited_round_trip_orders(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    path = scratch_path(spark, "delimited")
    write_delimited(orders, path)
    return read_delimited(spark, path, orders.schema)


def q_delimited_odd_text(spark, sf_dir):
    """Texts that the plain form must escape, NULL and the empty text apart."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", _odd_text().alias("odd"), "text", "source")
    path = scratch_path(spark, "delimited")
    write_delimited(docs, path)
    return read_delimited(spark, path, docs.schema)


def _odd_text():
    kind = F.pmod("doc_id", F.lit(7))
    return (
        F.when(kind == 0, F.lit("")).when(kind == 1, F.lit(None)).when(kind == 2, F.concat(F.lit("|"), "lang", F.lit("|")))
        .when(kind == 3, F.concat("lang", F.lit("\r\n"), "source")).when(kind == 4, F.lit('"')).when(kind == 5, F.lit("\\N"))
        .otherwise(F.concat(F.lit("\\"), "source", F.lit("\\\\n|")))
    )


# --- publish ---------------------------------------------------------------------------------

def q_publish(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    msgs = publish(docs, "text", KEYWORDS, "doc_id", "source", PUBLISH_PARTITIONS, "documents",
                   ["doc_id", "lang", "source", "text"])
    schema = docs.select("doc_id", "lang", "source", "text").schema
    decoded = decode_payload(msgs.withColumn("key_text", F.col("key").cast("string")), schema,
                             keep=["topic", "partition", "key_text"])
    return decoded.drop("is_bad")


def q_keyword_many(spark, sf_dir):
    """Documents that hold any of a table of terms: a pair of words and a word of each benchmark text."""
    docs = _t(spark, sf_dir, "documents")
    texts = _t(spark, sf_dir, "benchmark").select(F.lower("text").alias("t"))
    terms = texts.select(F.explode(F.array(F.regexp_extract("t", BENCH_PAIR, 1), F.regexp_extract("t", BENCH_WORD, 1))).alias("term"))
    return keyword_semi_join(docs, "text", terms, "doc_id").select("doc_id", "lang", "source")


def q_publish_once(spark, sf_dir):
    """Documents published in two goes, each go twice under its id, and read back by offset range."""
    docs = _t(spark, sf_dir, "documents")
    path = scratch_path(spark, "published")
    for part in (0, 0, 1, 1, 0):
        some = docs.filter(F.pmod("doc_id", F.lit(2)) == part)
        publish_log(publish(some, "text", KEYWORDS, "doc_id", "source", PUBLISH_PARTITIONS, "documents", ["doc_id", "lang"]),
                    path, publish_id=f"go {part}")
    back = read_offset_range(read_log(spark, path), [OffsetRange("documents", p, 0, None) for p in range(PUBLISH_PARTITIONS)])
    decoded = decode_payload(back, docs.select("doc_id", "lang").schema, keep=["partition", "offset"], required=["doc_id"])
    return decoded.filter(~F.col("is_bad")).drop("is_bad")


def q_publish_replay(spark, sf_dir):
    """Documents published in two goes to a log in the shared folder, and read back by offset range."""
    docs = _t(spark, sf_dir, "documents")
    path = scratch_path(spark, "published")
    for part in (0, 1):
        some = docs.filter(F.pmod("doc_id", F.lit(2)) == part)
        publish_log(publish(some, "text", KEYWORDS, "doc_id", "source", PUBLISH_PARTITIONS, "documents", ["doc_id", "lang"]), path)
    log = read_log(spark, path)
    back = read_offset_range(log, [OffsetRange("documents", p, 0, None) for p in range(PUBLISH_PARTITIONS)])
    decoded = decode_payload(back, docs.select("doc_id", "lang").schema, keep=["partition", "offset"], required=["doc_id"])
    return decoded.filter(~F.col("is_bad")).drop("is_bad")


# --- streaming ------------------------------------------------------------------------------

def _run_stream(spark, sf_dir, app=ev.APPNAME, root=None, rows=None, quarantine=None, table=None, by_partition=False, **more):
    """Drain the log, as its own files in arrival order, into a table under ``root``."""
    root = root or scratch_path(spark, "stream")
    own = scratch_path(spark, "stream", "source")
    log = _log(spark, sf_dir)
    log = log if rows is None else log.filter(rows)
    if by_partition:  # a file per log partition and stretch of offsets, so that a batch misses some partitions
        log = log.repartition("partition", F.floor(F.col("offset") / IDLE_STRETCH)).sortWithinPartitions("offset")
    log.write.parquet(own)
    sink, olog = f"{root}/table", f"{root}/offsets"
    stream = read_log_stream(spark, own, max_files_per_trigger=max(1, spark.sparkContext.defaultParallelism // 2))
    q = start_ingest(stream, sink, olog, scratch_path(spark, "stream", "checkpoint"), EVENT_RECORD, "ts_ms", app, ev.EVENT_STEPS,
                     available_now=True, quarantine=quarantine, table=table, **more)
    drain(q, STREAM_TIMEOUT_S)
    return sink, olog


def _ingested_schema(spark):
    rows = spark.createDataFrame([], EVENT_RECORD).select(*ev.EVENT_COLUMNS, *partition_fields("ts_ms"))
    return transform_chain(rows, ev.EVENT_STEPS).schema


def q_stream_ingest(spark, sf_dir):
    table = _unique_name("events_ingested")
    _run_stream(spark, sf_dir, table=table)
    return spark.table(table).drop("appname", "batch_id")


def q_stream_two_apps(spark, sf_dir):
    """Two apps that ingest into one table: every row of both is there, and their offsets are apart."""
    root = scratch_path(spark, "stream")
    even = F.pmod("partition", F.lit(2)) == 0
    sink, _ = _run_stream(spark, sf_dir, "app one/a", root, even)
    _run_stream(spark, sf_dir, "app_two", root, ~even)
    return spark.read.parquet(sink).select("appname", "event_id", "event_type", "mon", "day", "hour")


def q_stream_committed(spark, sf_dir):
    """An ingest whose batches are shown by commit records, read through them."""
    sink, _ = _run_stream(spark, sf_dir, committed=True)
    return read_committed(spark, sink, _ingested_schema(spark)).drop("appname", "batch_id")


def q_stream_compacted(spark, sf_dir):
    """An ingest shown by commit records, compacted by size tiers, then ingested into again."""
    root, half = scratch_path(spark, "stream"), F.pmod("partition", F.lit(2)) == 0
    _run_stream(spark, sf_dir, ev.APPNAME, root, half, committed=True)
    compact_committed(spark, f"{root}/table", _ingested_schema(spark), fanout=2)
    sink, _ = _run_stream(spark, sf_dir, "second", root, ~half, committed=True)
    return read_committed(spark, sink, _ingested_schema(spark)).drop("batch_id")


def q_stream_committed_offsets(spark, sf_dir):
    """What the commit records of an ingest with idle partitions tell: per partition the offsets read, and
    whether every batch from its first on has a row for it."""
    sink, _ = _run_stream(spark, sf_dir, committed=True, idle_partitions=True, by_partition=True)
    told = committed_offsets(spark, sink)
    last = told.agg(F.max("batch_id")).first()[0]
    return told.groupBy("topic", "partition").agg(
        F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset"),
        (F.count("*") == F.lit(last) - F.min("batch_id") + 1).alias("in_every_batch"),
    )


def q_stream_app_names(spark, sf_dir):
    """Two apps with odd names that ingest into one catalog table, read through the catalog."""
    root, table = scratch_path(spark, "stream"), _unique_name("events_apps")
    for i, app in enumerate(ODD_APPS):
        _run_stream(spark, sf_dir, app, root, F.pmod("partition", F.lit(2)) == i, table=table)
    return spark.table(table).select("appname", "event_id", "event_type", "mon", "day", "hour")


def q_stream_interval(spark, sf_dir):
    """The ingest with its interval trigger: stopped once the first batch, of all files, is done."""
    root, own = scratch_path(spark, "stream"), scratch_path(spark, "stream", "source")
    _log(spark, sf_dir).write.parquet(own)
    q = start_ingest(read_log_stream(spark, own), f"{root}/table", f"{root}/offsets", scratch_path(spark, "stream", "checkpoint"),
                     EVENT_RECORD, "ts_ms", ev.APPNAME, ev.EVENT_STEPS)
    run_batches(q, 1, STREAM_TIMEOUT_S)
    return spark.read.parquet(f"{root}/table").drop("appname", "batch_id")


def q_replay_two_part_table(spark, sf_dir):
    """A replay appended to a table of a database, ``db.table``."""
    db, name = _unique_name("db"), _unique_name("replayed")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'tables', db)}'")
    replay_offsets(_log(spark, sf_dir), REPLAY_BOUNDS, EVENT_RECORD, "ts_ms", ev.EVENT_STEPS, table=f"{db}.{name}")
    return spark.table(f"{db}.{name}")


def q_stream_offset_log(spark, sf_dir):
    _, olog = _run_stream(spark, sf_dir)
    return (
        spark.read.parquet(olog)
        .groupBy("topic", "partition")
        .agg(F.min("start_offset").alias("start_offset"), F.max("end_offset").alias("end_offset"),
             F.count_if(F.col("start_offset") >= F.col("end_offset")).alias("empty_ranges"))
    )


# --- registry -------------------------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Flagship: replay offset ranges of the events log, decoded and transformed."""
    return q_replay_offsets(spark, SMOKE_DIR)


def _llm_parts() -> tuple[dict, dict]:
    """Queries and SQL of the optional ``ledgerline.llm`` subpackage and its pipeline, if present."""
    try:
        import corpus_pipeline
        from ledgerline.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name is None or not (e.name == "corpus_pipeline" or e.name.startswith("ledgerline.llm")):
            raise
        return {}, {}
    found, sql = dict(llm.QUERIES), dict(llm.ORACLE)
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _core_queries() | _llm_parts()[0]


def oracle_sql() -> dict[str, str]:
    return _core_oracle() | _llm_parts()[1]


def _core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "message_log": q_message_log,  # F7 K3 (log from a table)
        "offset_range_read": q_offset_range_read,  # S3 P8
        "starting_offset_read": q_starting_offset_read,  # S2
        "decode_payload": q_decode_payload,  # A1 A2
        "decode_bad_rows": q_decode_bad_rows,  # A1 (bad rows)
        "partition_fields": q_partition_fields,  # F4 F5
        "parse_minute_text": q_parse_minute_text,  # F3
        "reverse_time_key": q_reverse_time_key,  # F6 L1
        "sanitize_text": q_sanitize_text,  # F2
        "sanitize_upper": q_sanitize_upper,  # F2 F1
        "keyword_filter": q_keyword_filter,  # P5
        "route_partition": q_route_partition,  # F7
        "safe_casts": q_safe_casts,  # F10
        "transform_chain": q_transform_chain,  # P1 P2 L3 K10
        "preview": q_preview,  # K6 L4
        "offset_log": q_offset_log,  # E2
        "batch_counts": q_batch_counts,  # E1
        "split_cells": q_split_cells,  # E4 F8 F9 S8
        "range_covering": q_range_covering,  # S4 E3 P7
        "range_interior": q_range_interior,  # S4 E3 P7
        "newest_batches": q_newest_batches,  # L1
        "latest_offsets": q_latest_offsets,  # L2
        "starting_offsets": q_starting_offsets,  # T6
        "replay_offsets": q_replay_offsets,  # M1 S3 P3 A1 P2
        "replay_time": q_replay_time,  # M2 F3 S4 E3
        "replay_time_interior": q_replay_time_interior,  # M2 (interior)
        "replay_and_merge": q_replay_and_merge,  # M6 M2 M4
        "unchanged_rows": q_unchanged_rows,  # J1 P4
        "merge_by_key": q_merge_by_key,  # M4 U1
        "merge_composite_key": q_merge_composite_key,  # M4 (two keys, repeating)
        "version_table": q_version_table,  # K4 K8 K11
        "partitioned_table": q_partitioned_table,  # K1
        "create_like_append": q_create_like_append,  # K7 K1
        "table_columns": q_table_columns,  # K9
        "delimited_round_trip": q_delimited_round_trip,  # S6 K5
        "delimited_round_trip_orders": q_delimited_round_trip_orders,  # S6 K5
        "publish": q_publish,  # M5 P5 F2 A2 F7
        "publish_replay": q_publish_replay,  # K3 M5 S3
        "replay_to_version": q_replay_to_version,  # M6 K7 K11 M4
        "replay_quarantine": q_replay_quarantine,  # M1 A1 (bad payloads)
        "merge_null_keys": q_merge_null_keys,  # J1 M4 (NULL keys)
        "delimited_odd_text": q_delimited_odd_text,  # S6 K5 (escapes)
        "stream_two_apps": q_stream_two_apps,  # M3 T6
        "stream_ingest": q_stream_ingest,  # M3 S1 T1-T3 T5 P6
        "stream_offset_log": q_stream_offset_log,  # T4 E2 K2
        "merge_prefiltered": q_merge_prefiltered,  # J1 M4 (filter over the delta keys)
        "merge_null_prefiltered": q_merge_null_prefiltered,  # J1 M4 (filter, NULL keys)
        "merge_chain": q_merge_chain,  # M4 (a chain of deltas in one pass)
        "merge_chain_version": q_merge_chain_version,  # M4 K4 K11 (chain of catalog tables)
        "offset_log_idle": q_offset_log_idle,  # E2 T4 (partitions without messages)
        "range_interior_idle": q_range_interior_idle,  # E3 (over idle rows)
        "continuity_audit": q_continuity_audit,  # S3 E2 (gaps and islands)
        "range_islands": q_range_islands,  # E2 (coverage)
        "rows_as_bounds": q_rows_as_bounds,  # S7 T6 S2
        "keyword_many": q_keyword_many,  # P5 (a table of terms)
        "publish_once": q_publish_once,  # K3 (publish ids)
        "latest_recorded": q_latest_recorded,  # L2 T6 K2 (snapshot and tail)
        "merge_bucketed": q_merge_bucketed,  # K4 M4 (bucketed versions)
        "stream_committed": q_stream_committed,  # M3 K1 (commit records)
        "stream_compacted": q_stream_compacted,  # K1 M3 (size-tiered compaction)
        "stream_committed_offsets": q_stream_committed_offsets,  # K2 T4 E2 (commit records, idle partitions)
        "stream_app_names": q_stream_app_names,  # M3 T3 (catalog table)
        "stream_interval": q_stream_interval,  # T1
        "replay_two_part_table": q_replay_two_part_table,  # F11 M1 K1
    }


# --- DuckDB oracle -------------------------------------------------------------------------

_ROUTE = "COALESCE(CAST(('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8)) AS BIGINT) % {n}, 0)"

_LOG = f"""
rec AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, user_id, event_type, value, props, ts,
         CAST({_ROUTE.format(c="user_id", n=4)} AS INTEGER) AS "partition"
  FROM events
),
log AS (
  SELECT *, 'events' AS topic,
         row_number() OVER (PARTITION BY "partition" ORDER BY event_id) - 1 AS "offset"
  FROM rec
),
olog AS (
  SELECT 'events_ingest' AS appname, topic, "partition", (ts_ms // 1000) // 3600 AS batch_id,
         max(ts_ms // 1000) AS batch_ts, min("offset") AS start_offset, max("offset") + 1 AS end_offset
  FROM log GROUP BY topic, "partition", (ts_ms // 1000) // 3600
)"""

_FIELDS = ("CAST(month(ts) AS INTEGER) AS mon, CAST(day(ts) AS INTEGER) AS day, "
           "CAST(hour(ts) AS INTEGER) AS hour")

_REC_FIELDS = f"event_id, ts_ms, user_id, event_type, value, props, {_FIELDS}"


def _chain(src: str) -> str:
    s1 = f"SELECT event_id, ts_ms, user_id, upper(event_type) AS event_type, value, props, mon, day, hour FROM ({src})"
    s2 = f"SELECT event_id, ts_ms, user_id, event_type, value, upper(props) AS props, mon, day, hour FROM ({s1})"
    return (f"SELECT event_id, ts_ms, user_id, event_type || '/' || CAST(hour AS VARCHAR) AS event_type, "
            f"value, props, mon, day, hour FROM ({s2})")


def _bounds_pred() -> str:
    parts = []
    for r in REPLAY_BOUNDS:
        c = [f'"partition" = {r.partition}']
        if r.from_offset is not None:
            c.append(f'"offset" >= {r.from_offset}')
        if r.until_offset is not None:
            c.append(f'"offset" < {r.until_offset}')
        parts.append("(" + " AND ".join(c) + ")")
    return " OR ".join(parts)


def _range_rows(begin, end, mode: str) -> str:
    if mode == "covering":
        agg = "min(start_offset) AS lo, max(end_offset) AS hi"
    else:
        agg = "arg_min(end_offset, batch_ts) AS lo, arg_max(start_offset, batch_ts) AS hi"
    return (f"SELECT log.* FROM log JOIN (SELECT \"partition\", {agg} FROM olog "
            f"WHERE appname = 'events_ingest' AND batch_ts > {begin} AND batch_ts <= {end} "
            f"GROUP BY \"partition\") r USING (\"partition\") WHERE \"offset\" >= r.lo AND \"offset\" < r.hi")


def _ranges(begin: int, end: int, mode: str) -> str:
    if mode == "covering":
        agg = "min(start_offset) AS from_offset, max(end_offset) AS until_offset"
    else:
        agg = "arg_min(end_offset, batch_ts) AS from_offset, arg_max(start_offset, batch_ts) AS until_offset"
    return (f"WITH {_LOG} SELECT topic, \"partition\", {agg} FROM olog WHERE appname = 'events_ingest' "
            f"AND batch_ts > {begin} AND batch_ts <= {end} GROUP BY topic, \"partition\"")


def _epoch_text(t: str) -> str:
    return f"CAST(epoch(strptime('{t}', '%Y%m%dT%H:%M')) AS BIGINT)"


_KW = "(^|[^a-z0-9_])(" + "|".join(KEYWORDS) + ")([^a-z0-9_]|$)"
_PRINTABLE = r"[^\x20-\x7E\t\n\r\x0B\x0C]"

_ORDERS_BASE = f"SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{ORDERS_BASE_BEFORE}'"
_ORDERS_DELTA = (f"SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
                 f"FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_DELTA_FROM}'")
_ORDERS_UNCHANGED = (f"SELECT b.* FROM ({_ORDERS_BASE}) b LEFT JOIN ({_ORDERS_DELTA}) d "
                     f"ON b.o_orderkey = d.o_orderkey WHERE d.o_orderkey IS NULL")
_ORDERS_MERGED = f"{_ORDERS_UNCHANGED} UNION ALL {_ORDERS_DELTA}"

_NO_KEY = ("SELECT CASE WHEN o_custkey % 5 <> 0 THEN o_orderkey END AS o_orderkey, o_custkey, o_orderstatus, "
           "o_totalprice, o_orderdate, o_orderpriority FROM ({t})")

_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
            "l_returnflag, {status} AS l_linestatus, l_shipdate")
_LI_BASE = f"SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{SHIP_BASE_BEFORE}'"
_LI_DELTA = (f"SELECT {_LI_COLS.format(status=repr('U'))} FROM lineitem "
             f"WHERE l_shipdate >= TIMESTAMP '{SHIP_DELTA_FROM}'")
_LI_MERGED = (f"SELECT b.* FROM ({_LI_BASE}) b WHERE NOT EXISTS (SELECT 1 FROM ({_LI_DELTA}) d "
              f"WHERE d.l_orderkey = b.l_orderkey AND d.l_linenumber = b.l_linenumber) UNION ALL {_LI_DELTA}")

_IDLE = """
batches AS (SELECT appname, batch_id, max(batch_ts) AS ts FROM olog GROUP BY ALL),
parts AS (SELECT appname, topic, "partition", min(batch_id) AS f FROM olog GROUP BY ALL),
idle AS (
  SELECT appname, topic, "partition", batch_id, coalesce(batch_ts, ts) AS batch_ts,
         coalesce(start_offset, last_value(end_offset IGNORE NULLS) OVER w) AS start_offset,
         last_value(end_offset IGNORE NULLS) OVER w AS end_offset
  FROM parts JOIN batches USING (appname) LEFT JOIN olog USING (appname, topic, "partition", batch_id)
  WHERE batch_id >= f
  WINDOW w AS (PARTITION BY appname, topic, "partition" ORDER BY batch_id ROWS UNBOUNDED PRECEDING)
)"""

_FAULTY = f"""
cut AS (SELECT "partition", "offset" // {AUDIT_BATCH} AS id, min("offset") AS s, max("offset") + 1 AS e FROM log GROUP BY ALL),
r AS (SELECT "partition", CASE WHEN id % {AUDIT_AGAIN[0]} = {AUDIT_AGAIN[1]} THEN s - {AUDIT_EARLY} ELSE s END AS s, e
      FROM cut WHERE id % {AUDIT_SKIP[0]} <> {AUDIT_SKIP[1]})"""


def _chain_sql(keyed: str) -> str:
    """The base and each delta table over it, one after the other."""
    merged = keyed.format(t=_ORDERS_BASE)
    for i, year in enumerate(CHAIN_YEARS):
        d = keyed.format(t=f"SELECT o_orderkey, o_custkey, '{i}' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
                           f"FROM orders WHERE o_orderdate >= TIMESTAMP '{year}-01-01'")
        merged = (f"SELECT * FROM ({merged}) m WHERE NOT EXISTS (SELECT 1 FROM ({d}) d WHERE d.o_orderkey = m.o_orderkey) "
                  f"UNION ALL SELECT * FROM ({d})")
    return merged


_DECODED = "SELECT event_id, ts_ms, user_id, event_type, value, props, " + _FIELDS + " FROM log"


def _core_oracle() -> dict[str, str]:
    good = f"event_id % {BAD_EVERY} NOT IN ({', '.join(map(str, BAD_FORMS))})"
    replay_cov = _range_rows(RANGE_BEGIN, RANGE_END, "covering")
    replay_int = _range_rows(RANGE_BEGIN, RANGE_END, "interior")
    base_rows = _range_rows(_epoch_text(BASE_BEGIN), _epoch_text(BASE_END), "covering")
    delta_rows = _range_rows(_epoch_text(DELTA_BEGIN), _epoch_text(DELTA_END), "covering")
    delta_sel = (f"SELECT event_id, ts_ms, user_id, upper(event_type) AS event_type, value, props, {_FIELDS} "
                 f"FROM ({delta_rows})")
    base_sel = f"SELECT {_REC_FIELDS} FROM ({base_rows})"
    return {
        "message_log": f"WITH {_LOG} SELECT topic, \"partition\", \"offset\", CAST(event_id AS VARCHAR) AS key_text, "
                       f"epoch_us(ts) AS timestamp_us FROM log",
        "offset_range_read": f"WITH {_LOG} SELECT topic, \"partition\", \"offset\", CAST(event_id AS VARCHAR) AS key_text "
                             f"FROM log WHERE {_bounds_pred()}",
        "starting_offset_read": f"WITH {_LOG} SELECT topic, \"partition\", \"offset\", CAST(event_id AS VARCHAR) AS key_text "
                                f"FROM log JOIN (SELECT \"partition\" AS p, max(end_offset) AS s FROM olog WHERE batch_ts <= {RESUME_AT} "
                                f"GROUP BY 1) ON \"partition\" = p WHERE \"offset\" >= s",
        "decode_payload": f"WITH {_LOG} SELECT event_id, ts_ms, user_id, event_type, value, props, false AS is_bad FROM log",
        "decode_bad_rows": f"WITH {_LOG} SELECT CAST(event_id AS VARCHAR) AS key_text, "
                           + ", ".join(
                               f"CASE WHEN {good} THEN {c} END AS {c}"
                               for c in ("event_id", "ts_ms", "user_id", "event_type", "value", "props"))
                           + f", NOT ({good}) AS is_bad FROM log",
        "partition_fields": f"SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, epoch_us(ts) // 1000000 AS ts_s, {_FIELDS} "
                            f"FROM events",
        "parse_minute_text": "SELECT event_id, strftime(ts, '%Y%m%dT%H:%M') AS minute_text, "
                             "CAST(epoch(strptime(strftime(ts, '%Y%m%dT%H:%M'), '%Y%m%dT%H:%M')) AS BIGINT) AS minute_s "
                             "FROM events",
        "reverse_time_key": "SELECT event_id, 'events_ingest' || CAST(9223372036854775807 - epoch_us(ts) // 1000000 "
                            "AS VARCHAR) AS row_key FROM events",
        "sanitize_text": f"SELECT doc_id, regexp_replace(text, '{_PRINTABLE}', '', 'g') AS text_clean FROM documents",
        "sanitize_upper": f"SELECT doc_id, upper(regexp_replace(text, '{_PRINTABLE}', '', 'g')) AS text_upper FROM documents",
        "keyword_filter": f"SELECT doc_id, lang, source FROM documents WHERE regexp_matches(lower(text), '{_KW}')",
        "route_partition": f"SELECT event_id, user_id, CAST({_ROUTE.format(c='user_id', n=ROUTE_PARTITIONS)} AS INTEGER) "
                           f"AS \"partition\" FROM events",
        "safe_casts": "SELECT event_id, TRY_CAST(CAST(event_id AS VARCHAR) AS BIGINT) AS id_from_text, "
                      "TRY_CAST(event_type AS INTEGER) AS type_as_int, "
                      "TRY_CAST(regexp_extract(props, ':\\s*(-?\\d+)', 1) AS INTEGER) AS prop_k, "
                      "TRY_CAST(props AS INTEGER) AS props_as_int, "
                      "TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value_round_trip FROM events",
        "transform_chain": _chain(f"SELECT event_id, epoch_us(ts) // 1000 AS ts_ms, user_id, event_type, value, props, "
                                  f"{_FIELDS} FROM events"),
        "preview": f"WITH {_LOG} SELECT event_id, ts_ms, user_id, event_type, value, props, false AS is_bad FROM log "
                   f"ORDER BY event_id LIMIT {PREVIEW_N}",
        "offset_log": f"WITH {_LOG} SELECT * FROM olog",
        "batch_counts": f"WITH {_LOG} SELECT topic, \"partition\", (ts_ms // 1000) // 3600 AS batch_id, "
                        f"count(*) AS message_count FROM log GROUP BY ALL",
        "split_cells": f"WITH {_LOG} SELECT appname || CAST(9223372036854775807 - batch_ts AS VARCHAR) || ':' || topic "
                       f"|| ':' || CAST(\"partition\" AS VARCHAR) AS \"row\", start_offset, end_offset FROM olog",
        "range_covering": _ranges(RANGE_BEGIN, RANGE_END, "covering"),
        "range_interior": _ranges(RANGE_BEGIN, RANGE_END, "interior"),
        "newest_batches": f"WITH {_LOG} SELECT * FROM olog WHERE appname = 'events_ingest' "
                          f"ORDER BY batch_ts DESC, batch_id DESC, topic, \"partition\" LIMIT {NEWEST_N}",
        "latest_offsets": f"WITH {_LOG} SELECT topic, \"partition\", arg_max(batch_id, batch_ts) AS batch_id, "
                          f"max(batch_ts) AS batch_ts, arg_max(start_offset, batch_ts) AS start_offset, "
                          f"arg_max(end_offset, batch_ts) AS end_offset FROM olog "
                          f"WHERE appname = 'events_ingest' GROUP BY topic, \"partition\"",
        "starting_offsets": f"WITH {_LOG} SELECT topic, \"partition\", arg_max(end_offset, batch_ts) AS next_offset "
                            f"FROM olog WHERE appname = 'events_ingest' GROUP BY topic, \"partition\"",
        "replay_offsets": f"WITH {_LOG} " + _chain(f"SELECT {_REC_FIELDS} FROM log WHERE {_bounds_pred()}"),
        "replay_time": f"WITH {_LOG} " + _chain(f"SELECT {_REC_FIELDS} FROM ({replay_cov})"),
        "replay_time_interior": f"WITH {_LOG} " + _chain(f"SELECT {_REC_FIELDS} FROM ({replay_int})"),
        "replay_and_merge": f"WITH {_LOG} SELECT * FROM ({base_sel}) b WHERE b.event_id NOT IN "
                            f"(SELECT event_id FROM ({delta_sel})) UNION ALL {delta_sel}",
        "unchanged_rows": _ORDERS_UNCHANGED,
        "merge_by_key": _ORDERS_MERGED,
        "merge_composite_key": _LI_MERGED,
        "version_table": _ORDERS_MERGED,
        "partitioned_table": f"WITH {_LOG} {_DECODED}",
        "create_like_append": f"WITH {_LOG} {_DECODED}",
        "table_columns": "SELECT column_name AS name, CAST(ordinal_position AS INTEGER) AS ordinal "
                         "FROM information_schema.columns WHERE table_name = 'orders'",
        "delimited_round_trip": "SELECT * FROM documents",
        "delimited_round_trip_orders": "SELECT * FROM orders",
        "publish": f"SELECT 'documents' AS topic, CAST({_ROUTE.format(c='source', n=PUBLISH_PARTITIONS)} AS INTEGER) "
                   f"AS \"partition\", CAST(doc_id AS VARCHAR) AS key_text, doc_id, lang, source, "
                   f"regexp_replace(text, '{_PRINTABLE}', '', 'g') AS text FROM documents "
                   f"WHERE regexp_matches(lower(text), '{_KW}')",
        "stream_ingest": f"WITH {_LOG} " + _chain(f"SELECT {_REC_FIELDS} FROM log"),
        "stream_offset_log": f"WITH {_LOG} SELECT topic, \"partition\", min(\"offset\") AS start_offset, "
                             f"max(\"offset\") + 1 AS end_offset, CAST(0 AS BIGINT) AS empty_ranges FROM log GROUP BY ALL",
        "stream_two_apps": f"WITH {_LOG} SELECT CASE WHEN \"partition\" % 2 = 0 THEN 'app one/a' ELSE 'app_two' END AS appname, "
                           f"event_id, upper(event_type) || '/' || CAST(hour(ts) AS VARCHAR) AS event_type, {_FIELDS} FROM log",
        "publish_replay": f"SELECT doc_id, lang, \"partition\", row_number() OVER (PARTITION BY \"partition\" "
                          f"ORDER BY doc_id % 2, doc_id) - 1 AS \"offset\" FROM (SELECT doc_id, lang, "
                          f"CAST({_ROUTE.format(c='source', n=PUBLISH_PARTITIONS)} AS INTEGER) AS \"partition\" "
                          f"FROM documents WHERE regexp_matches(lower(text), '{_KW}'))",
        "replay_to_version": f"WITH {_LOG}, deltas AS ({delta_sel}), base AS ({base_sel}) "
                             f"SELECT *, 'deltas' AS kind FROM deltas UNION ALL "
                             f"SELECT *, 'version' AS kind FROM (SELECT * FROM base WHERE event_id NOT IN "
                             f"(SELECT event_id FROM deltas) UNION ALL SELECT * FROM deltas)",
        "replay_quarantine": f"WITH {_LOG} SELECT event_id, event_id % {QUARANTINE_EVERY} = 3 AS quarantined "
                             f"FROM log WHERE {_bounds_pred()}",
        "merge_null_keys": f"WITH b AS ({_NO_KEY.format(t=_ORDERS_BASE)}), d AS ({_NO_KEY.format(t=_ORDERS_DELTA)}) "
                           f"SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = b.o_orderkey) "
                           f"UNION ALL SELECT * FROM d",
        "merge_prefiltered": _LI_MERGED,
        "merge_null_prefiltered": f"WITH b AS ({_NO_KEY.format(t=_ORDERS_BASE)}), d AS ({_NO_KEY.format(t=_ORDERS_DELTA)}) "
                                  f"SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.o_orderkey = b.o_orderkey) "
                                  f"UNION ALL SELECT * FROM d",
        "merge_chain": _chain_sql(_NO_KEY),
        "merge_chain_version": _chain_sql("SELECT * FROM ({t})"),
        "offset_log_idle": f"WITH {_LOG}, {_IDLE} SELECT * FROM idle",
        "range_interior_idle": f"WITH {_LOG}, {_IDLE} SELECT topic, \"partition\", arg_min(end_offset, batch_id) AS from_offset, "
                               f"arg_max(start_offset, batch_id) AS until_offset FROM idle "
                               f"WHERE batch_ts > {RANGE_BEGIN} AND batch_ts <= {RANGE_END} GROUP BY ALL",
        "continuity_audit": f"""WITH {_LOG}, {_FAULTY},
            there AS (SELECT "partition", "offset" AS o FROM log WHERE "offset" % {AUDIT_HOLE[0]} NOT IN {AUDIT_HOLE[1]}),
            taken AS (SELECT "partition", o, count(*) AS c FROM (SELECT "partition", unnest(range(s, e)) AS o FROM r) GROUP BY ALL),
            ends AS (SELECT "partition", min(s) AS s, max(e) AS e FROM r GROUP BY ALL),
            span AS (SELECT "partition", least(ends.s, min(o)) AS lo, greatest(ends.e, max(o) + 1) AS hi, ends.e AS last
                     FROM ends JOIN there USING ("partition") GROUP BY "partition", ends.s, ends.e),
            grid AS (SELECT "partition", last, unnest(range(lo, hi)) AS o FROM span),
            k AS (SELECT "partition", o, unnest(list_filter([
                    CASE WHEN there.o IS NOT NULL AND c IS NULL AND o < last THEN 'gap' END, CASE WHEN c > 1 THEN 'repeated' END,
                    CASE WHEN there.o IS NULL AND c > 0 THEN 'missing' END,
                    CASE WHEN there.o IS NOT NULL AND c IS NULL AND o >= last THEN 'pending' END,
                    CASE WHEN there.o IS NULL AND c IS NULL THEN 'absent' END], lambda x: x IS NOT NULL)) AS kind
                  FROM grid LEFT JOIN taken USING ("partition", o) LEFT JOIN there USING ("partition", o)),
            i AS (SELECT *, o - row_number() OVER (PARTITION BY "partition", kind ORDER BY o) AS run FROM k)
            SELECT 'events' AS topic, "partition", kind, min(o) AS from_offset, max(o) + 1 AS until_offset
            FROM i GROUP BY "partition", kind, run""",
        "range_islands": f"""WITH {_LOG}, {_FAULTY},
            o AS (SELECT DISTINCT "partition", unnest(range(s, e)) AS o FROM r),
            i AS (SELECT *, o - row_number() OVER (PARTITION BY "partition" ORDER BY o) AS run FROM o)
            SELECT 'events' AS topic, "partition", min(o) AS from_offset, max(o) + 1 AS until_offset FROM i GROUP BY "partition", run""",
        "rows_as_bounds": f"WITH {_LOG} SELECT topic, \"partition\", \"offset\", CAST(event_id AS VARCHAR) AS key_text "
                          f"FROM log JOIN (SELECT \"partition\" AS p, max(end_offset) AS s FROM olog WHERE batch_ts <= {RESUME_AT} "
                          f"GROUP BY 1) ON \"partition\" = p WHERE \"offset\" >= s",
        "keyword_many": f"WITH t AS (SELECT DISTINCT unnest([regexp_extract(lower(text), '{BENCH_PAIR}', 1), "
                        f"regexp_extract(lower(text), '{BENCH_WORD}', 1)]) AS term FROM benchmark) "
                        f"SELECT doc_id, lang, source FROM documents WHERE EXISTS (SELECT 1 FROM t WHERE term <> '' AND "
                        f"regexp_matches(lower(text), '(^|[^a-z0-9_])' || regexp_escape(term) || '([^a-z0-9_]|$)'))",
        "publish_once": f"SELECT doc_id, lang, \"partition\", row_number() OVER (PARTITION BY \"partition\" "
                        f"ORDER BY doc_id % 2, doc_id) - 1 AS \"offset\" FROM (SELECT doc_id, lang, "
                        f"CAST({_ROUTE.format(c='source', n=PUBLISH_PARTITIONS)} AS INTEGER) AS \"partition\" "
                        f"FROM documents WHERE regexp_matches(lower(text), '{_KW}'))",
        "latest_recorded": f"WITH {_LOG} SELECT topic, \"partition\", arg_max(batch_id, batch_ts) AS batch_id, "
                           f"max(batch_ts) AS batch_ts, arg_max(start_offset, batch_ts) AS start_offset, "
                           f"arg_max(end_offset, batch_ts) AS end_offset FROM olog "
                           f"WHERE appname = 'events_ingest' GROUP BY topic, \"partition\"",
        "merge_bucketed": _chain_sql("SELECT * FROM ({t})"),
        "stream_committed": f"WITH {_LOG} " + _chain(f"SELECT {_REC_FIELDS} FROM log"),
        "stream_compacted": f"WITH {_LOG}, rows AS (" + _chain(f"SELECT {_REC_FIELDS} FROM log") + ") SELECT rows.*, CASE WHEN "
                            f"\"partition\" % 2 = 0 THEN 'events_ingest' ELSE 'second' END AS appname "
                            f"FROM rows JOIN log USING (event_id)".replace("rows.*", "rows.event_id, rows.ts_ms, rows.user_id, rows.event_type, rows.value, rows.props, mon, day, hour"),
        "stream_committed_offsets": f"WITH {_LOG} SELECT topic, \"partition\", min(\"offset\") AS start_offset, "
                                    f"max(\"offset\") + 1 AS end_offset, true AS in_every_batch FROM log GROUP BY ALL",
        "stream_app_names": f"WITH {_LOG} SELECT CASE WHEN \"partition\" % 2 = 0 THEN '{ODD_APPS[0]}' ELSE '{ODD_APPS[1]}' END AS appname, "
                            f"event_id, upper(event_type) || '/' || CAST(hour(ts) AS VARCHAR) AS event_type, {_FIELDS} FROM log",
        "stream_interval": f"WITH {_LOG} " + _chain(f"SELECT {_REC_FIELDS} FROM log"),
        "replay_two_part_table": f"WITH {_LOG} " + _chain(f"SELECT {_REC_FIELDS} FROM log WHERE {_bounds_pred()}"),
        "delimited_odd_text": "SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '|' || lang || '|' "
                              "WHEN 3 THEN lang || chr(13) || chr(10) || source WHEN 4 THEN '\"' WHEN 5 THEN chr(92) || 'N' "
                              "ELSE chr(92) || source || chr(92) || chr(92) || 'n|' END AS odd, text, source FROM documents",
    }
