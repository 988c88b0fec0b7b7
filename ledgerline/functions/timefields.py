"""Epoch and wall-clock helpers.

Every conversion here is independent of ``spark.sql.session.timeZone``: epochs
are taken from the calendar fields of ``timestamp_ntz`` values by integer
arithmetic (no cast through a zone, so daylight-saving gaps and overlaps do not
matter), and minute text is parsed with an explicit zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The minute-text layout of the time-range arguments, and the
# largest signed 64-bit integer used to reverse time in offset-log keys.
MINUTE_TEXT_FORMAT = "yyyyMMdd'T'HH:mm"
MAX_LONG = 9223372036854775807



def _epoch_ntz() -> Column:
    # a typed NTZ literal: no session time zone is involved
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ value read as UTC wall-clock."""
    ts = _col(ts)
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    minutes = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return minutes * 60_000_000 + micros


def floor_div(c, n: int) -> Column:
    """Exact integer division rounding toward minus infinity (no double round trip)."""
    c = _col(c)
    return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n))


def epoch_millis(ts) -> Column:
    """Epoch milliseconds, rounded down from the microseconds."""
    return floor_div(epoch_micros(ts), 1000)


def millis_to_seconds(ms) -> Column:
    """Epoch ms -> epoch s by integer division rounding down."""
    return floor_div(ms, 1000)


def millis_to_wallclock(ms) -> Column:
    """Epoch ms -> TIMESTAMP_NTZ holding the UTC wall-clock time."""
    return F.timestamp_add("MILLISECOND", _col(ms), _epoch_ntz())


def partition_fields(ms, with_year: bool = False) -> list[Column]:
    """``mon, day, hour`` (and optionally ``year``) of an epoch-ms column, in UTC."""
    wall = millis_to_wallclock(ms)
    cols = [F.month(wall).alias("mon"), F.dayofmonth(wall).alias("day"), F.hour(wall).alias("hour")]
    if with_year:
        cols.insert(0, F.year(wall).alias("year"))
    return cols


def minute_text(ts) -> Column:
    """Wall-clock minute text ``YYYYMMDDTHH:MM`` of a TIMESTAMP_NTZ."""
    ts = _col(ts)
    text = F.format_string("%04d%02d%02dT%02d:%02d", F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts))
    return F.when(ts.isNotNull(), text)


def parse_minute_text(text) -> Column:
    """``YYYYMMDDTHH:MM`` read as UTC -> epoch seconds; NULL for malformed text."""
    zoned = F.try_to_timestamp(F.concat(_col(text), F.lit("Z")), F.lit(MINUTE_TEXT_FORMAT + "X"))
    return F.unix_seconds(zoned)


def reverse_time_key(app, seconds) -> Column:
    """Offset-log row key: app name + (2^63-1 - seconds), newest first in text order."""
    app_col = F.lit(app) if isinstance(app, str) else app
    return F.concat(app_col, (F.lit(MAX_LONG) - _col(seconds).cast("long")).cast("string"))
