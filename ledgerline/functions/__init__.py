"""Column-level functions.  All are built-in Spark expressions (codegen'd)."""

from ledgerline.functions.casts import safe_cast
from ledgerline.functions.routing import route_partition
from ledgerline.functions.text import keyword_match, printable_ascii
from ledgerline.functions.timefields import (
    epoch_micros,
    epoch_millis,
    millis_to_seconds,
    millis_to_wallclock,
    minute_text,
    parse_minute_text,
    partition_fields,
    reverse_time_key,
)

__all__ = [
    "epoch_micros",
    "epoch_millis",
    "keyword_match",
    "millis_to_seconds",
    "millis_to_wallclock",
    "minute_text",
    "parse_minute_text",
    "partition_fields",
    "printable_ascii",
    "reverse_time_key",
    "route_partition",
    "safe_cast",
]
