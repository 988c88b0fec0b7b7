"""The driver tables as log inputs: ``events`` published as a message log.

Log layout: topic ``events``; partition = md5 route of ``user_id`` over 4
partitions; offsets in ``event_id`` order within a partition; key = event id
text; value = JSON of the event record with ``ts_ms``; timestamp = ``ts``
read as UTC.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.timefields import epoch_millis
from ledgerline.operators.offsets import batch_offsets, hourly_batches
from ledgerline.operators.sequence import DEFAULT_BLOCK_ROWS
from ledgerline.schemas import EVENT_RECORD
from ledgerline.sources.log import log_from_table, ntz_as_utc_instant

# Fixed values of the log fixture: topic, partition count, app name of the
# offset log, and the batch width of the hourly offset log.
TOPIC = "events"
N_PARTITIONS = 4
APPNAME = "events_ingest"
BATCH_SECONDS = 3600

# Transform steps in the shape of the consumer's ini: each a SELECT list read
# from the step before.  sql10 sorts between sql01 and sql02 (text order).
EVENT_STEPS = {
    "sql01": "SELECT event_id, ts_ms, user_id, upper(event_type) AS event_type, value, props, mon, day, hour",
    "sql02": "SELECT event_id, ts_ms, user_id, event_type, value, upper(props) AS props, mon, day, hour",
    "sql10": "SELECT event_id, ts_ms, user_id, concat(event_type, '/', CAST(hour AS STRING)) AS event_type, "
             "value, props, mon, day, hour",
}
EVENT_COLUMNS = [f.name for f in EVENT_RECORD.fields]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def event_records(events: DataFrame) -> DataFrame:
    """events -> the payload record (ts as epoch ms)."""
    return events.select(
        "event_id", epoch_millis("ts").alias("ts_ms"), "user_id", "event_type", "value", "props", "ts"
    )


def events_log(spark: SparkSession, sf_dir: str, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """The MESSAGE_LOG built from ``events``."""
    rec = event_records(table(spark, sf_dir, "events"))
    return log_from_table(
        rec,
        topic=TOPIC,
        key=F.col("event_id"),
        route=F.col("user_id"),
        order_col="event_id",
        timestamp=ntz_as_utc_instant("ts"),
        payload_cols=EVENT_COLUMNS,
        n_partitions=N_PARTITIONS,
        block_rows=block_rows,
    )


def hourly_offset_log(log: DataFrame, appname: str = APPNAME) -> DataFrame:
    """OFFSET_LOG of a log cut into hourly batches."""
    return batch_offsets(hourly_batches(log, BATCH_SECONDS), appname)
