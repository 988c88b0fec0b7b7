"""Ordered chain of SQL projections, and an ordered preview."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

_SELECT = re.compile(r"^\s*select\s+", re.IGNORECASE)


def ordered_steps(steps: Mapping[str, str] | Iterable[tuple[str, str]] | None) -> list[tuple[str, str]]:
    """Steps sorted by name as text (``sql10`` sorts before ``sql2``)."""
    if steps is None:
        return []
    items = list(steps.items()) if isinstance(steps, Mapping) else list(steps)
    return sorted(items, key=lambda kv: kv[0])


def transform_chain(df: DataFrame, steps: Mapping[str, str] | Iterable[tuple[str, str]] | None) -> DataFrame:
    """Apply each step's SELECT list to the result of the step before.

    A step is ``"SELECT <list>"`` or a bare ``<list>``, read from the previous
    result.  No step, or ``None``, is the identity.  Everything stays one lazy
    plan: Catalyst collapses the projections into one Project, so no step runs
    a job of its own.
    """
    out = df
    for _name, text in ordered_steps(steps):
        select_list = _SELECT.sub("", text.strip().rstrip(";").rstrip(), count=1)
        # the formatter reads braces as placeholders; the step text is literal SQL
        escaped = select_list.replace("{", "{{").replace("}", "}}")
        out = out.sparkSession.sql(f"SELECT {escaped} FROM {{src}}", src=out)
    return out


def preview(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """First ``n`` rows in ``keys`` order (a top-k: per-task top-n, then merge)."""
    return df.orderBy(*keys).limit(n)
