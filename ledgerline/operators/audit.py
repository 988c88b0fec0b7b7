"""Continuity audit: is every offset of the log ingested once, and is what was ingested still there?

Offset ranges are half-open.  Two steps, both aggregates and ordered scans within a topic partition:

* **islands**: a set of offsets, or of ranges, as the fewest ranges that cover it.  For a log at rest the
  offsets are cut into slices of ``slice_width``, islands are found within each slice, and those that
  touch across slices are joined; so a log partition that holds a third of all messages is spread over
  many tasks, and only islands travel further.
* **sweep**: range starts and ends as +1 and -1 at their offsets, summed per offset (a partial and a final
  aggregate) and then along the offsets; between two neighbouring offsets the depth says how often the
  stretch was ingested.  Stretches of one kind that touch are one row.

The last step sees, per app and topic partition, two events for each recorded batch and for each island
of the log.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.timefields import floor_div

SLICE_WIDTH = 1 << 22  # offsets of a slice
TOPIC_PARTITION = ("topic", "partition")

# The kinds of stretches that an audit reports.
GAP = "gap"  # in the log, between or before ingested offsets, never ingested
REPEATED = "repeated"  # ingested more than once
MISSING = "missing"  # ingested, no longer in the log
PENDING = "pending"  # in the log, after the last ingested offset
ABSENT = "absent"  # neither in the log nor ingested, between offsets that are


def _joined(ranges: DataFrame, keys: list[str], kind: list[str] | None = None) -> DataFrame:
    """Ranges that do not overlap (``from_offset``, ``until_offset``), those that touch and agree in
    ``kind`` made one."""
    same = [*keys, *(kind or [])]
    order = Window.partitionBy(*same).orderBy("from_offset")
    starts = F.coalesce(F.col("from_offset") > F.lag("until_offset").over(order), F.lit(True))
    run = F.sum(F.col("__starts").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        ranges.withColumn("__starts", starts).withColumn("__run", run).groupBy(*same, "__run")
        .agg(F.min("from_offset").alias("from_offset"), F.max("until_offset").alias("until_offset"))
        .select(*same, "from_offset", "until_offset")
    )


def log_islands(log: DataFrame, keys: tuple[str, ...] = TOPIC_PARTITION, slice_width: int = SLICE_WIDTH) -> DataFrame:
    """The offsets of a log as ranges: ``keys``, ``from_offset``, ``until_offset``.  An offset that
    comes twice counts once."""
    sliced = log.select(*keys, "offset", floor_div("offset", slice_width).alias("__slice"))
    rank = F.dense_rank().over(Window.partitionBy(*keys, "__slice").orderBy("offset"))
    found = sliced.withColumn("__run", F.col("offset") - rank).groupBy(*keys, "__slice", "__run")
    found = found.agg(F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"))
    return _joined(found.drop("__slice", "__run"), list(keys))


def range_islands(ranges: DataFrame, keys: tuple[str, ...] = ("appname", *TOPIC_PARTITION)) -> DataFrame:
    """Ranges (``start_offset``, ``end_offset``; they may overlap or be empty) as the fewest ranges:
    a range begins an island where it starts beyond every end so far (a running maximum)."""
    full = ranges.filter(F.col("start_offset") < F.col("end_offset"))
    order = Window.partitionBy(*keys).orderBy("start_offset", "end_offset")
    before = F.max("end_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("start_offset") > before, F.lit(True)).cast("long")
    run = F.sum("__starts").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        full.withColumn("__starts", starts).withColumn("__run", run).groupBy(*keys, "__run")
        .agg(F.min("start_offset").alias("from_offset"), F.max("end_offset").alias("until_offset"))
        .select(*keys, "from_offset", "until_offset")
    )


def _events(ranges: DataFrame, keys: list[str], start: str, end: str, depth: Column, stored: Column) -> DataFrame:
    """+ at the start, - at the end of every range that is not empty."""
    ends = F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("sign")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("sign")))
    each = ranges.filter(F.col(start) < F.col(end)).select(*keys, F.explode(ends).alias("e"), depth.alias("depth"), stored.alias("stored"))
    return each.select(*keys, "e.at", (F.col("depth") * F.col("e.sign")).alias("depth"), (F.col("stored") * F.col("e.sign")).alias("stored"))


def audit_offsets(offset_log: DataFrame, log: DataFrame, slice_width: int = SLICE_WIDTH) -> DataFrame:
    """``appname, topic, partition, kind, from_offset, until_offset``: the stretches of each app's topic
    partitions where log and offset log disagree.

    ``gap`` (in the log, never ingested, with later offsets ingested), ``repeated`` (ingested more than
    once), ``missing`` (ingested, no longer in the log, as after compaction or expiry), ``pending`` (in
    the log, after the last ingested offset) and ``absent`` (in neither, between others).  A stretch can
    be both repeated and missing and then has a row of each.  Only topic partitions that the app has
    recorded are audited; a range of no offsets tells that a partition is known.
    """
    keys = ["appname", *TOPIC_PARTITION]
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    known = offset_log.groupBy(*keys).agg(F.max("end_offset").alias("__last"))
    here = log_islands(log, slice_width=slice_width).join(known, list(TOPIC_PARTITION))
    taken = _events(offset_log, keys, "start_offset", "end_offset", one, none)
    stored = _events(here, keys, "from_offset", "until_offset", none, one)
    ended = known.select(*keys, F.col("__last").alias("at"), none.alias("depth"), none.alias("stored"))  # stretches end here too
    events = taken.unionByName(stored).unionByName(ended).groupBy(*keys, "at").agg(F.sum("depth").alias("depth"), F.sum("stored").alias("stored"))
    order = Window.partitionBy(*keys).orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = events.select(
        *keys, F.col("at").alias("from_offset"), F.lead("at").over(order).alias("until_offset"),
        F.sum("depth").over(so_far).alias("depth"), F.sum("stored").over(so_far).alias("stored"),
    ).filter(F.col("until_offset").isNotNull()).join(known, keys)
    taken, there, later = F.col("depth") > 0, F.col("stored") > 0, F.col("from_offset") >= F.col("__last")
    kinds = [
        (there & ~taken & ~later, GAP), (F.col("depth") > 1, REPEATED), (taken & ~there, MISSING),
        (there & ~taken & later, PENDING), (~taken & ~there, ABSENT),
    ]
    told = F.array_compact(F.array(*[F.when(test, F.lit(kind)) for test, kind in kinds]))
    return _joined(swept.select(*keys, "from_offset", "until_offset", F.explode(told).alias("kind")), keys, ["kind"])


def is_continuous(audit: DataFrame, kinds: tuple[str, ...] = (GAP, REPEATED, MISSING)) -> bool:
    """Whether an audit reports none of ``kinds``."""
    return audit.filter(reduce(lambda a, b: a | b, [F.col("kind") == k for k in kinds])).isEmpty()
