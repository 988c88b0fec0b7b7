"""Stable partition routing: the same key always lands in the same partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def route_partition(key, n: int) -> Column:
    """Partition in ``0..n-1`` from the first 32 bits of md5(key as text).

    Portable (any engine with md5 gives the same routing); a NULL key goes to 0.
    """
    if n <= 0:
        raise ValueError("number of partitions must be positive")
    c = F.col(key) if isinstance(key, str) else key
    head = F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("long")
    return F.coalesce(F.pmod(head, F.lit(n)), F.lit(0)).cast("int")
