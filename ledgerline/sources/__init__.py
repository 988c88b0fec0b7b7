"""Sources: message logs (tables, files, Kafka) and delimited text."""

from ledgerline.sources.delimited import read_delimited
from ledgerline.sources.log import (
    OffsetRange,
    kafka_assign_json,
    kafka_offsets_json,
    log_from_table,
    ntz_as_utc_instant,
    read_from_offsets,
    read_kafka_range,
    read_kafka_stream,
    read_log,
    read_log_stream,
    read_offset_range,
    resume_points,
)

__all__ = [
    "OffsetRange", "kafka_assign_json", "kafka_offsets_json", "log_from_table", "ntz_as_utc_instant", "read_delimited",
    "read_from_offsets", "read_kafka_range", "read_kafka_stream", "read_log", "read_log_stream",
    "read_offset_range", "resume_points",
]
