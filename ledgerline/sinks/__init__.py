"""Sinks: partitioned, versioned, delimited and log tables."""

from ledgerline.sinks.ledger import publish_once, published_ids
from ledgerline.sinks.manifest import committed_batches, committed_offsets, compact_committed, drop_superseded, read_committed
from ledgerline.sinks.snapshots import latest_recorded, snapshot_offsets
from ledgerline.sinks.tables import (
    append_log,
    append_partitioned,
    compact,
    compact_offset_log,
    create_like,
    create_table,
    frame_columns,
    insert_into,
    offset_deltas_name,
    overwrite_batch,
    overwrite_partitions,
    publish_log,
    read_offset_log,
    table_columns,
    version_names,
    write_delimited,
    write_log,
    write_offset_log,
    write_version,
)

__all__ = [
    "append_log", "append_partitioned", "committed_batches", "committed_offsets", "compact", "compact_committed", "compact_offset_log",
    "create_like", "create_table", "drop_superseded", "frame_columns", "insert_into", "latest_recorded", "offset_deltas_name",
    "overwrite_batch", "overwrite_partitions", "publish_log", "publish_once", "published_ids", "read_committed", "read_offset_log",
    "snapshot_offsets", "table_columns", "version_names", "write_delimited", "write_log", "write_offset_log", "write_version",
]
