"""DataFrame -> DataFrame operators."""

from ledgerline.operators.audit import audit_offsets, is_continuous, log_islands, range_islands
from ledgerline.operators.codec import MissingConnectorError, decode_payload, encode_payload
from ledgerline.operators.keywords import keyword_semi_join
from ledgerline.operators.merge import merge_by_key, merge_by_key_outer_join, merge_chain, prefilter_for, unchanged_rows
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
    scan_offset_log,
    starting_offsets,
    starting_offsets_json,
)
from ledgerline.operators.sequence import assign_sequence
from ledgerline.operators.transform import ordered_steps, preview, transform_chain

__all__ = [
    "MissingConnectorError", "assign_sequence", "audit_offsets", "batch_counts", "batch_offsets", "carry_forward", "cells_to_ranges",
    "decode_payload", "encode_payload", "hourly_batches", "is_continuous", "keyword_semi_join", "latest_offsets", "log_islands",
    "merge_by_key", "merge_by_key_outer_join", "merge_chain", "newest_batches", "offset_cells", "ordered_steps", "prefilter_for",
    "preview", "range_islands", "resolve_range", "scan_offset_log", "starting_offsets", "starting_offsets_json", "transform_chain",
    "unchanged_rows",
]
