"""Versions that merge without a shuffle of the base: bucketed tables, version after version.

A bucketed version holds every key in one of ``buckets`` buckets.  Merging it joins each bucket with
the delta keys of that bucket: the scan of the base keeps its buckets, so only the deltas are exchanged,
and the new version is written in the same buckets, two files to each (the base's rows and the deltas').
Rows with a NULL key share a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.keyfilter import any_null
from ledgerline.plans.versions import version_stamp
from ledgerline.sinks.tables import version_names


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str]]:
    """Number of buckets and the bucket columns of a catalog table."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if "Num Buckets" not in told:
        raise ValueError(f"{table} is not bucketed")
    columns = told["Bucket Columns"].strip("[]").split(", ")
    return int(told["Num Buckets"]), [c.strip("`") for c in columns]


def write_bucketed(df: DataFrame, table: str, buckets: int, keys: list[str], path: str | None = None) -> str:
    """Write ``df`` as the table ``table`` in ``buckets`` buckets by ``keys``: a first base version."""
    return _save(df.repartition(buckets, *keys), table, buckets, keys, path)


def _save(df: DataFrame, table: str, buckets: int, keys: list[str], path: str | None) -> str:
    w = df.write.mode("errorifexists").format("parquet").bucketBy(buckets, *keys)
    (w.option("path", path) if path else w).saveAsTable(table)
    return table


def merged_buckets(spark: SparkSession, base_table: str, deltas: DataFrame) -> DataFrame:
    """The merge of a bucketed base with ``deltas`` on its bucket columns, bucket by bucket."""
    buckets, keys = bucket_spec(spark, base_table)
    base = spark.table(base_table)
    missing = [c for c in base.columns if c not in deltas.columns]
    if missing:
        raise ValueError(f"deltas lack base columns {missing}")
    typed = deltas.select(*[F.col(c).cast(base.schema[c].dataType).alias(c) for c in base.columns])
    # a join that keeps the base's buckets: the distinct delta keys of a bucket are its hash table
    delta_keys = typed.select(*keys).filter(~any_null(keys)).dropDuplicates(keys).repartition(buckets, *keys).hint("shuffle_hash")
    unchanged = base.join(delta_keys, keys, "left_anti").select(*base.columns)
    return unchanged.unionByName(typed.repartition(buckets, *keys))


def merge_bucketed_version(spark: SparkSession, base_table: str, deltas: DataFrame, version: str | None = None, path: str | None = None) -> str:
    """``base_table`` (bucketed) merged with ``deltas`` on its bucket columns into the version table
    ``<base_table>_<version>``, bucketed alike; delta columns are cast to the base's types."""
    buckets, keys = bucket_spec(spark, base_table)
    name = version_names(base_table, version or version_stamp())["version"]
    return _save(merged_buckets(spark, base_table, deltas), name, buckets, keys, path)
