"""Versioned tables: build ``<table>_<version>`` from a base table and its deltas."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.merge import merge_by_key, merge_chain, prefilter_for
from ledgerline.sinks.tables import version_names, write_version

# Fixed value: layout of a generated version stamp.
VERSION_LAYOUT = "%Y%m%d_%H%M"


def version_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime(VERSION_LAYOUT)


def merge_version(
    spark: SparkSession,
    base_table: str,
    deltas: DataFrame,
    keys,
    version: str | None = None,
    path: str | None = None,
    partition_cols=(),
    prefilter: bool = True,
    **limits,
) -> str:
    """M4 written out: ``base_table`` merged with ``deltas`` on ``keys`` into a new table.

    The base is never overwritten in place (a table being read cannot be);
    each merge makes a new version, named after ``version`` (default: now).  With ``prefilter`` the
    deltas' keys are counted, and where they are many a filter over them keeps the base rows that cannot
    match out of the join (``limits``: see ``prefilter_for``).
    """
    base = spark.table(base_table)
    found = prefilter_for(base, deltas, keys, **limits) if prefilter else None
    merged = merge_by_key(base, deltas, keys, found)
    return write_version(merged, base_table, version or version_stamp(), path=path, partition_cols=partition_cols)


def merge_chain_version(
    spark: SparkSession,
    base_table: str,
    versions: list[str],
    keys,
    path: str | None = None,
    partition_cols=(),
    **options,
) -> str:
    """The deltas tables ``<base_table>_deltas_<v>`` of all ``versions``, oldest first, merged with the base
    in one pass into the version table of the last (``options``: see ``merge_chain``)."""
    if not versions:
        raise ValueError("at least one version is needed")
    deltas = [spark.table(version_names(base_table, v)["deltas"]) for v in versions]
    merged = merge_chain(spark.table(base_table), deltas, keys, **options)
    return write_version(merged, base_table, versions[-1], path=path, partition_cols=partition_cols)
