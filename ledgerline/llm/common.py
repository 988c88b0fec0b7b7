"""Small helpers shared by the operators: staged tables, checked broadcasts, word expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

from ledgerline.session import scratch_path

ASCII_WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BROADCAST_ROWS = 1_000_000  # most rows of a side that is broadcast; beyond it the join shuffles
BROADCAST_BYTES = 64 << 20  # most bytes of a side whose rows hold arrays or texts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 500  # rows with whole texts or sets that a Python task gets at a time


def staged(df: DataFrame, name: str = "stage", batch_rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts the lineage and
    survives a lost executor, whose share Spark reads again from the files.  The shuffle files
    of the write go with it, as nothing reads them again.  ``batch_rows``: most rows that Python
    functions in ``df`` get at a time, for rows that hold whole texts or sets."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    before = {CLEANUP: spark.conf.get(CLEANUP, "false")}
    spark.conf.set(CLEANUP, "true")
    if batch_rows is not None:
        before[BATCH] = spark.conf.get(BATCH)
        spark.conf.set(BATCH, str(min(batch_rows, int(before[BATCH])) if int(before[BATCH]) > 0 else batch_rows))
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, as counted now; else
    ``df`` as it is, so that the join shuffles.  Call it on staged or small tables."""
    return F.broadcast(df) if df.count() <= max_rows else df


def _bytes(col: Column, kind: DataType) -> Column:
    if isinstance(kind, (StringType, BinaryType)):
        return F.octet_length(col) + 16
    if isinstance(kind, ArrayType):
        if isinstance(kind.elementType, StructType):
            return 8 * len(kind.elementType) * F.size(col)
        return F.octet_length(F.array_join(col, " ")) if isinstance(kind.elementType, StringType) else 8 * F.size(col)
    return F.lit(8)


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``checked_broadcast`` for rows that hold arrays or texts: their bytes are bounded too."""
    size = sum((F.coalesce(_bytes(F.col(f.name), f.dataType), F.lit(0)) for f in df.schema), F.lit(0)).cast("long")
    rows, held = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and held <= max_bytes else df


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased and nothing else (``lower`` alone would fold other letters too)."""
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, UPPER.lower()))


def word_count(col: Column) -> Column:
    """Number of words between ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(col, F.lit(ASCII_WORD)), F.lit(0)).cast("long")
