"""M5: prepare records for a log: keyword filter, clean text, encode, route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.routing import route_partition
from ledgerline.functions.text import keyword_match, printable_ascii
from ledgerline.operators.codec import connector_checked, encode_column
from ledgerline.sources.log import ORDER_COL


def publish(
    df: DataFrame,
    text_col: str,
    terms: list[str],
    key_col: str,
    route_col: str,
    n_partitions: int,
    topic: str,
    payload_cols: list[str],
    fmt: str = "json",
    avro_schema: str | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """Rows holding any of ``terms`` -> ``key value topic partition timestamp __order`` messages.

    The text is cleaned to printable ASCII before encoding; the partition is a
    stable hash route of ``route_col``.  ``timestamp`` is the messages' time (default: now) and
    ``__order`` the key as a number (else its hash), by which a table-backed log numbers them.
    Output feeds ``sinks.tables.publish_log``.
    """
    order = F.coalesce(F.col(key_col).cast("string").try_cast("long"), F.xxhash64(key_col))
    cleaned = df.filter(keyword_match(text_col, terms)).withColumn(text_col, printable_ascii(text_col))
    return connector_checked(lambda: cleaned.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        encode_column(payload_cols, fmt, avro_schema).alias("value"),
        F.lit(topic).alias("topic"),
        route_partition(route_col, n_partitions).alias("partition"),
        (F.current_timestamp() if timestamp is None else timestamp).alias("timestamp"),
        order.alias(ORDER_COL),
    ), fmt)
