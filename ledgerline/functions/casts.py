"""Casts that yield NULL instead of failing on dirty input (ANSI mode is on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_cast(c, to: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(to)
