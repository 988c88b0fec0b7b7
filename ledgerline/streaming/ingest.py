"""M3: continuous ingest of a message stream into a partitioned table.

Per micro-batch (``foreachBatch``), on the same batch of rows:

1. take the batch's offset ranges (one row per topic partition); a batch without messages ends here;
2. decode the payloads, derive ``mon, day, hour``, run the transform chain, and
   write the rows to ``<sink>/appname=<app>/batch_id=<id>/mon=/day=/hour=`` by
   overwriting that batch's folder - a retried batch replaces everything it wrote
   before (stale hour folders included) instead of adding copies, and apps that
   share a table never meet; with ``table`` the folder is shown in that catalog table;
3. only then record the offset ranges in the offset log, keyed by
   (appname, batch_id), also by overwrite.

The query checkpoint records which offsets each batch_id covered, so after a
failure Spark replays the same batch with the same id and both writes are
idempotent.  Batch ids are the query's epoch ids plus a base kept next to the
checkpoint, so a new query (new checkpoint) of the same app continues after the
batches already recorded instead of replacing them.  Bad payloads go to an
optional quarantine path, keyed the same way; without one they fail the batch
(or are left out, if ``on_bad="drop"``).

With ``committed`` step 2 writes to a new folder for every attempt and the batch is shown by one
record (``sinks.manifest``): readers of ``read_committed`` see each batch whole, as it was or as it is.
With ``idle_partitions`` step 3 also records, as a consumer of all its partitions does, an empty range
for every partition known so far that had no message in the batch.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.codec import BAD_COL, decode_payload
from ledgerline.operators.offsets import batch_offsets, with_idle_partitions
from ledgerline.operators.transform import transform_chain
from ledgerline.plans.replay import decode_messages
from ledgerline.schemas import OFFSET_LOG, PARTITION_FIELDS
from ledgerline.sinks.manifest import commit_batch, new_attempt
from ledgerline.sinks.snapshots import recent_entries, snapshot_offsets
from ledgerline.sinks.tables import batch_path, overwrite_batch, path_missing, register_batch, write_batch_folder, write_offset_log

# Fixed value: the default interval between micro-batches, in seconds.
DEFAULT_TRIGGER_SECONDS = 180

SNAPSHOT_EVERY = 100  # batches between snapshots of the ends, where idle partitions are recorded

_log = logging.getLogger(__name__)


def _log_metrics(batch_id: int, metrics: dict) -> None:
    _log.info("ingest batch %s: %s", batch_id, metrics)


def _observed(seen: Observation, batch: DataFrame) -> dict:
    """The counts of the batch's write.  Where nothing was left to write, the adaptive plan may have
    dropped the observed node: then every message was bad."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        n = batch.count()
        return {"rows": n, "bad_rows": n}


def batch_writer(
    schema: T.StructType,
    time_field: str,
    sink: str,
    offset_log_path: str,
    appname: str,
    steps=None,
    fmt: str = "json",
    quarantine: str | None = None,
    on_metrics: Callable[[int, dict], None] | None = _log_metrics,
    cache_batch: bool = False,
    batch_base: int = 0,
    avro_schema: str | None = None,
    with_year: bool = False,
    table: str | None = None,
    on_bad: str | None = None,
    committed: bool = False,
    idle_partitions: bool = False,
):
    """The ``foreachBatch`` function of :func:`start_ingest`.

    Rows and offsets are keyed by ``appname`` and ``batch_base + epoch id`` (see
    :func:`batch_id_base`).  ``on_bad`` is as in ``decode_messages``.

    The batch is read twice: for its offsets (of a columnar file log that is four
    columns) and for its data, by one write that also counts.  With ``cache_batch``,
    or if bad messages are to be kept, it is read once and held meanwhile.
    ``on_metrics(batch_id, {"rows": n, "bad_rows": m})`` receives the counts.
    """
    parts = [*(["year"] if with_year else []), *PARTITION_FIELDS]
    on_bad = on_bad or ("quarantine" if quarantine else "fail")
    if committed and table:
        raise ValueError("a committed sink is read by read_committed; it has no catalog table")

    def ends_before(spark, batch_id: int) -> DataFrame:
        """What earlier batches recorded, one row per topic partition."""
        mine = recent_entries(spark, offset_log_path, appname, before=batch_id)
        return mine.groupBy("topic", "partition").agg(F.max_by("end_offset", "batch_id").alias("end_offset"))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch_id = int(batch_base) + int(epoch_id)
        hold = cache_batch or bool(quarantine)
        if hold:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stamp = F.lit(batch_id).cast("long")
            ranges = batch_offsets(batch, appname, stamp).collect()  # one row per topic partition
            if not ranges:
                return
            if quarantine:
                raw = batch.withColumn("__message", F.struct("topic", "partition", "offset", "key", "value"))
                decoded = decode_payload(raw, schema, fmt=fmt, keep=["__message"], avro_schema=avro_schema, required=[time_field])
                bad = decoded.filter(F.col(BAD_COL)).select("__message.*")
                bad.write.mode("overwrite").parquet(batch_path(quarantine, appname, batch_id))
            seen = Observation(f"ingest_{batch_id}")
            rows = decode_messages(batch, schema, time_field, fmt, with_year, on_bad="drop" if quarantine else on_bad,
                                   avro_schema=avro_schema, counts=seen)
            out = transform_chain(rows, steps)
            messages = sum(r["end_offset"] - r["start_offset"] for r in ranges)
            spark = batch.sparkSession
            if committed:
                folder = new_attempt(sink, appname, batch_id)
                write_batch_folder(out.withColumn("appname", F.lit(appname)), folder, parts, messages)
            else:
                overwrite_batch(out, sink, appname, batch_id, parts, messages)
            if table:
                register_batch(spark, table, sink, out, appname, batch_id, parts)
            offsets = spark.createDataFrame(ranges, OFFSET_LOG)
            if idle_partitions:
                newest = max(r["batch_ts"] for r in ranges)
                offsets = with_idle_partitions(offsets, ends_before(spark, batch_id), appname, batch_id, newest)
            if committed:
                cells = offsets.select("topic", "partition", "batch_ts", "start_offset", "end_offset").collect()  # one per topic partition
                counts = _observed(seen, batch)
                commit_batch(spark, sink, appname, batch_id, folder, cells, counts["rows"] - counts["bad_rows"], counts["bad_rows"])
            write_offset_log(offsets.coalesce(1), offset_log_path)
            if idle_partitions and (batch_id + 1) % SNAPSHOT_EVERY == 0:
                snapshot_offsets(spark, offset_log_path, appname)
            if on_metrics:
                on_metrics(batch_id, _observed(seen, batch))
        finally:
            if hold:
                batch.unpersist()

    return write_batch


def _fetched_by_query(stream: DataFrame) -> bool:
    """Whether each read of a micro-batch fetches from brokers again: a source that is not files."""
    plan = stream._jdf.queryExecution().analyzed()
    leaves = plan.collectLeaves()
    names = [leaves.apply(i).getClass().getSimpleName() for i in range(leaves.size())]
    return any(n != "StreamingRelation" for n in names)  # file streams are StreamingRelation, Kafka's StreamingRelationV2


def start_ingest(
    stream: DataFrame,
    sink: str,
    offset_log_path: str,
    checkpoint: str,
    schema: T.StructType,
    time_field: str,
    appname: str,
    steps=None,
    trigger_seconds: int = DEFAULT_TRIGGER_SECONDS,
    available_now: bool = False,
    fmt: str = "json",
    quarantine: str | None = None,
    query_name: str | None = None,
    on_metrics: Callable[[int, dict], None] | None = _log_metrics,
    cache_batch: bool | None = None,
    avro_schema: str | None = None,
    with_year: bool = False,
    table: str | None = None,
    on_bad: str | None = None,
    committed: bool = False,
    idle_partitions: bool = False,
) -> StreamingQuery:
    """Start the ingest query; ``available_now`` drains what is there and stops.

    One ingest query per ``appname`` at a time (as with a single consumer).  With ``table`` the rows
    are also a catalog table over ``sink``; with ``committed`` they are read by ``sinks.manifest.read_committed``.  ``cache_batch`` defaults to the source's kind: batches from
    Kafka are cached, those from files are not.
    """
    decode_payload(stream, schema, fmt=fmt, avro_schema=avro_schema)  # a missing connector shows here
    cache_batch = _fetched_by_query(stream) if cache_batch is None else cache_batch
    base = batch_id_base(stream.sparkSession, checkpoint, offset_log_path, appname)
    writer = stream.writeStream.foreachBatch(
        batch_writer(schema, time_field, sink, offset_log_path, appname, steps, fmt, quarantine, on_metrics,
                     cache_batch, base, avro_schema, with_year, table, on_bad, committed, idle_partitions)
    ).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()


BASE_FILE = "_ledgerline_batch_base"


def batch_id_base(spark, checkpoint: str, offset_log_path: str, appname: str) -> int:
    """First batch id of a query, so ids stay unique per app across queries.

    A query's own epoch ids restart at 0 with every new checkpoint; a second
    query writing to the same table and offset log would otherwise replace the
    first one's ``batch_id=0``.  The base is the next id after the app's
    largest recorded batch, kept next to the checkpoint so that a restart from
    the same checkpoint maps each epoch to the same id again; it is written once,
    before the first batch.  Only a path that is not there counts as "nothing recorded": any
    other read error is raised, as a wrong base would replace batches.
    """
    marker = f"{checkpoint.rstrip('/')}/{BASE_FILE}"
    try:
        return int(spark.read.text(marker).first()[0])
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
    top = None
    try:
        recorded = spark.read.schema(OFFSET_LOG).parquet(offset_log_path).filter(F.col("appname") == F.lit(appname))
        top = recorded.agg(F.max("batch_id")).first()[0]
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
    base = 0 if top is None else int(top) + 1
    spark.createDataFrame([(str(base),)], "value string").coalesce(1).write.mode("errorifexists").text(marker)
    return base


def run_ingest(query: StreamingQuery, timeout_s: float | None = None) -> bool:
    """Wait for the query (at most ``timeout_s``); True when it has stopped, False if it still runs."""
    if timeout_s is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(timeout_s))


def run_batches(query: StreamingQuery, batches: int, timeout_s: float) -> None:
    """Let a query with an interval trigger run until ``batches`` batches with messages are done, and stop it."""
    until = time.monotonic() + timeout_s
    while True:
        if query.exception():
            raise query.exception()
        done = {p["batchId"] for p in query.recentProgress if p["numInputRows"] > 0}
        if len(done) >= batches or time.monotonic() > until:
            query.stop()
            if len(done) < batches:
                raise TimeoutError(f"{len(done)} of {batches} batches after {timeout_s:g} s")
            return
        time.sleep(0.2)


def drain(query: StreamingQuery, timeout_s: float) -> None:
    """Wait for a query that stops by itself; a query that has not ended by then is stopped and a
    ``TimeoutError`` raised, as what it wrote is only a part."""
    if not run_ingest(query, timeout_s):
        query.stop()
        raise TimeoutError(f"the ingest had not ended after {timeout_s:g} s")
    if query.exception():
        raise query.exception()
