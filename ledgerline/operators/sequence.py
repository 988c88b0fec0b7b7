"""Dense per-group sequence numbers (log offsets) without one task per group.

``row_number() OVER (PARTITION BY p ORDER BY k)`` sends every row of a group
to a single task; a log partition can hold a third of all messages.  Here a
group of more than ``block_rows`` rows is cut into blocks along its order key:

1. one row per group is measured: its rows, and ``SEGMENTS`` + 1 quantiles of
   the order key, written once so that every later step sees the same bounds;
2. a row's block is its quantile segment, cut evenly into as many parts as the
   segment's share of rows asks for - sparse, clustered and outlying ids all
   give blocks of about ``block_rows`` rows;
3. rows per (group, block) are counted, with partial aggregation; a prefix sum
   over the counts gives each block's base, written once, as every use of the
   numbered rows needs it.  There are at most
   rows / block_rows + SEGMENTS + 1 blocks in a group, whatever its ids;
4. rows are numbered within their block and the base is added.

Rows are shuffled once, by step 4's window: the bases are broadcast unless they
are very many.  If no group has more than ``block_rows`` rows, step 1 says so
and the rows are numbered by the plain window, whose tasks are then no larger.

Rows with a NULL order key come first; a NULL group is a group.  No row is
lost and the result equals the plain ``row_number`` form (rows that tie in the
order key are numbered in an arbitrary order, as there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

DEFAULT_BLOCK_ROWS = 1 << 20
SEGMENTS = 64
STRIDE = 8  # bounds between those looked at first
BROADCAST_GROUPS = 20_000
BROADCAST_BLOCKS = 1_000_000


def group_bounds(df: DataFrame, group_cols: list[str], order_col: str) -> DataFrame:
    """One row per group: its columns, ``__rows`` and ``__bounds`` (quantiles of the order key)."""
    steps = [i / SEGMENTS for i in range(SEGMENTS + 1)]
    bounds = F.percentile_approx(F.col(order_col).cast("long"), steps, 10_000)
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__rows"), bounds.alias("__bounds"))


def assign_sequence(
    df: DataFrame,
    group_cols: list[str],
    order_col: str,
    out_col: str = "offset",
    block_rows: int = DEFAULT_BLOCK_ROWS,
    start: int = 0,
) -> DataFrame:
    """Add ``out_col`` = start + rank of ``order_col`` (integral) within ``group_cols``."""
    if block_rows <= 0:
        raise ValueError("block_rows must be positive")
    spark = df.sparkSession
    largest = df.groupBy(*group_cols).count().agg(F.max("count")).first()[0] or 0
    if largest <= block_rows:
        over = Window.partitionBy(*group_cols).orderBy(order_col)
        return df.withColumn(out_col, (F.row_number().over(over) - 1 + F.lit(start)).cast("long"))

    path = scratch_path(spark, "sequence")
    group_bounds(df, group_cols, order_col).write.parquet(path)
    names = {c: f"__g_{c}" for c in group_cols}
    bounds = spark.read.parquet(path).withColumnsRenamed(names)
    each = F.sequence(F.lit(STRIDE - 1), F.lit(SEGMENTS), F.lit(STRIDE))
    bounds = bounds.withColumn("__coarse", F.transform(each, lambda i: F.get("__bounds", i)))
    if bounds.count() <= BROADCAST_GROUPS:
        bounds = F.broadcast(bounds)
    same = None
    for c, g in names.items():
        test = df[c].eqNullSafe(bounds[g])
        same = test if same is None else same & test
    blk = "__blk"
    tagged = df.join(bounds, same).withColumn(blk, F.col(order_col).cast("long"))
    tagged = _with_blocks(tagged, blk, block_rows).select(*df.columns, blk)
    keys = [*group_cols, blk]

    counts = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group_cols).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    path = scratch_path(spark, "sequence")
    counts.select(
        *[F.col(c).alias(f"__b_{c}") for c in keys], F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base")
    ).write.parquet(path)
    bases = spark.read.parquet(path)
    if bases.count() <= BROADCAST_BLOCKS:
        bases = F.broadcast(bases)
    within = Window.partitionBy(*keys).orderBy(order_col)
    numbered = tagged.withColumn("__rn", F.row_number().over(within))
    same = numbered[blk].eqNullSafe(bases[f"__b_{blk}"])  # never null; == would repeat the block's expression in a filter
    for c in group_cols:
        same = same & numbered[c].eqNullSafe(bases[f"__b_{c}"])
    out = (F.col("__base") + F.col("__rn") - 1 + F.lit(start)).cast("long")
    return numbered.join(bases, same).withColumn(out_col, out).select(*df.columns, out_col)


def _with_blocks(rows: DataFrame, blk: str, block_rows: int) -> DataFrame:
    """``blk``, the order key, replaced by the row's block.

    The segment is the number of bounds up to the key.  It is counted among every ``STRIDE``-th bound, then
    among those that follow, in columns of their own, so that each row looks once at few bounds."""
    key, at = F.col(blk), F.col("__at")
    up_to = lambda bounds: F.size(F.filter(bounds, lambda b: b <= key))
    rows = rows.withColumn("__at", up_to(F.col("__coarse")) * STRIDE)
    rows = rows.withColumn("__at", at + up_to(F.slice("__bounds", at + 1, F.lit(STRIDE))))
    rows = rows.withColumn("__low", F.get("__bounds", at - 1)).withColumn("__width", F.get("__bounds", at) - F.col("__low"))
    rows = rows.withColumn("__parts", F.ceil(F.col("__rows") / (SEGMENTS * block_rows)))
    part = F.least(F.col("__parts") - 1, F.floor((key - F.col("__low")) * F.col("__parts") / F.greatest("__width", F.lit(1))))
    block = F.when(key.isNull(), F.lit(-1)).otherwise(at * F.col("__parts") + F.coalesce(part, F.lit(0)))  # at 0: below all
    return rows.withColumn(blk, block.cast("long"))
