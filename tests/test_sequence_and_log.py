"""Offset assignment, log building, range reads."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.sequence import assign_sequence
from ledgerline.plans import events as ev
from ledgerline.sources.log import OffsetRange, read_from_offsets, read_offset_range

from tests.support import SF_SMALL


def _naive(df):
    w = Window.partitionBy("g").orderBy("id")
    return df.withColumn("offset", F.row_number().over(w) - 1)


@settings(max_examples=8, deadline=None, derandomize=True)
@given(ids=st.lists(st.integers(min_value=-10_000, max_value=10_000), unique=True, max_size=60),
       width=st.integers(min_value=1, max_value=50))
def test_sequence_equals_row_number(spark, ids, width):
    rows = [(i, abs(i) % 3) for i in ids]
    df = spark.createDataFrame(rows, "id long, g int")
    got = sorted(tuple(r) for r in assign_sequence(df, ["g"], "id", "offset", block_rows=width).collect())
    want = sorted(tuple(r) for r in _naive(df).select("id", "g", "offset").collect())
    assert [(a, b, c) for a, b, c in got] == want


def test_events_log_is_dense_per_partition(spark):
    log = ev.events_log(spark, SF_SMALL, block_rows=97)
    stats = log.groupBy("partition").agg(F.count("*").alias("n"), F.min("offset").alias("lo"),
                                        F.max("offset").alias("hi"), F.countDistinct("offset").alias("d")).collect()
    assert sum(r["n"] for r in stats) == 1000
    for r in stats:
        assert r["lo"] == 0 and r["hi"] == r["n"] - 1 and r["d"] == r["n"]


def test_block_rows_do_not_change_the_log(spark):
    a = ev.events_log(spark, SF_SMALL, block_rows=13)
    b = ev.events_log(spark, SF_SMALL, block_rows=1 << 30)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_offset_range_read_bounds(spark):
    log = ev.events_log(spark, SF_SMALL)
    got = read_offset_range(log, [OffsetRange("events", 0, 10, 20), ("events", 1, 5, None)])
    rows = got.select("partition", "offset").collect()
    assert all((r[0] == 0 and 10 <= r[1] < 20) or (r[0] == 1 and r[1] >= 5) for r in rows)
    n1 = log.filter("partition = 1").count()
    assert len(rows) == 10 + (n1 - 5)
    assert read_offset_range(log, []).count() == 0
    # an inverted range is empty
    assert read_offset_range(log, [OffsetRange("events", 0, 20, 10)]).count() == 0


def test_sequence_keeps_null_keys_and_groups(spark):
    rows = [(None, 1), (5, 1), (3, 1), (None, None), (7, None), (1, None), (2, 2)]
    df = spark.createDataFrame(rows, "id long, g int")
    for width in (1, 100):
        got = sorted((tuple(r) for r in assign_sequence(df, ["g"], "id", block_rows=width).collect()), key=repr)
        assert got == sorted([(None, 1, 0), (3, 1, 1), (5, 1, 2), (None, None, 0), (1, None, 1), (7, None, 2), (2, 2, 0)], key=repr)


def test_sequence_blocks_are_bounded_whatever_the_ids(spark):
    import ledgerline.operators.sequence as seq

    step = 1 << 21
    sparse = spark.range(6000).select((F.col("id") * step).alias("id"), F.lit(0).alias("g"))
    outliers = spark.range(6000).select(F.when(F.col("id") < 3, -(1 << 60) + F.col("id")).otherwise(F.col("id")).alias("id"), F.lit(0).alias("g"))
    for df in (sparse, outliers):
        out = assign_sequence(df, ["g"], "id", block_rows=50)
        assert out.select("offset").exceptAll(spark.range(6000).select("id")).count() == 0
        joined = out._jdf.queryExecution().optimizedPlan().toString()
        assert "__blk" in joined
    # the count table: at most rows / block_rows + SEGMENTS + 1 blocks, and blocks of about block_rows rows
    bounds = seq.group_bounds(sparse, ["g"], "id").first()
    assert bounds["__rows"] == 6000 and len(bounds["__bounds"]) == seq.SEGMENTS + 1
    blocks = [sum(lo <= i * step < hi for i in range(6000)) for lo, hi in zip(bounds["__bounds"], bounds["__bounds"][1:])]
    assert max(blocks) <= 2 * 6000 / seq.SEGMENTS


def test_many_ranges_are_one_predicate(spark, scratch):
    from ledgerline.sinks.tables import write_log
    from ledgerline.sources.log import read_log

    path = scratch("log")
    write_log(ev.events_log(spark, SF_SMALL), path)
    log = read_log(spark, path)
    ranges = [OffsetRange("events", p, 3, 9) for p in range(4)] + [OffsetRange("other", p, 0, 5 + p % 3) for p in range(300)]
    got = read_offset_range(log, ranges)
    assert got.count() == read_offset_range(log, ranges[:4]).count() == 24
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "GreaterThanOrEqual(offset" in plan and "LessThan(offset" in plan
    # the same bounds as a table: joined, one row per partition, partitions pruned, a window of offsets at the scan
    table = spark.createDataFrame([(r.topic, r.partition, r.from_offset, r.until_offset) for r in ranges],
                                  "topic string, partition int, from_offset long, until_offset long")
    joined = read_offset_range(log, table)
    assert joined.exceptAll(got).count() == 0 and joined.count() == 24
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("FileScan") == 2  # the log, the bounds
    scan = plan.split("FileScan")[1]
    assert "GreaterThanOrEqual(offset,0)" in scan and "LessThan(offset,9)" in scan and "partition#" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert read_offset_range(log, table.limit(0)).count() == 0


def test_from_offsets_and_dataframe_bounds(spark):
    log = ev.events_log(spark, SF_SMALL)
    starts = spark.createDataFrame([("events", 2, 100, None)],
                                   "topic string, partition int, from_offset long, until_offset long")
    got = read_from_offsets(log, starts)
    assert got.count() == log.filter("partition = 2 AND offset >= 100").count()


def test_range_read_is_pushed_to_the_scan(spark, scratch):
    path = scratch("log")
    ev.events_log(spark, SF_SMALL).write.partitionBy("topic", "partition").parquet(path)
    at_rest = spark.read.parquet(path)
    plan = read_offset_range(at_rest, [OffsetRange("events", 0, 10, 20)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "partition" in plan
    assert "PushedFilters" in plan and "offset" in plan


def test_log_at_rest_splits_a_hot_partition(spark, scratch):
    import os

    from ledgerline.sinks.tables import write_log
    from ledgerline.sources.log import read_log

    # every message in partition 0: the write must still use several tasks / files
    hot = ev.events_log(spark, SF_SMALL).withColumn("partition", F.lit(0)).withColumn(
        "offset", F.row_number().over(Window.orderBy("key")) - 1)
    path = scratch("hot")
    # tiny data would be coalesced into one task; switch that off (and use narrow slices) to see the split
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        write_log(hot, path, slice_width=100)
    finally:
        spark.conf.set(key, old)
    local = path[len("file:"):] if path.startswith("file:") else path
    files = [f for f in os.listdir(os.path.join(local, "topic=events", "partition=0")) if f.endswith(".parquet")]
    assert len(files) > 1
    back = read_log(spark, path)
    assert back.count() == 1000 and back.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]


def test_blocks_are_found_once_and_rows_shuffled_once(spark):
    import ledgerline.operators.sequence as seq

    rows = spark.range(20_000).select((F.col("id") * F.col("id") % 99_991).alias("id"), (F.col("id") % 3).cast("int").alias("g"), F.lit("x").alias("v"))
    rows = rows.dropDuplicates(["id", "g"])
    out = assign_sequence(rows, ["g"], "id", block_rows=10)
    assert out.select("id", "g", "offset").exceptAll(_naive(rows).select("id", "g", "offset")).isEmpty()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("filter(") == 2  # each level of bounds is looked at once a row
    executed = assign_sequence(spark.range(20_000).withColumn("g", F.lit(1)), ["g"], "id", block_rows=10)
    assert executed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert seq.STRIDE < seq.SEGMENTS


def test_blocks_at_and_beyond_every_bound(spark):
    for least in (-90, 0):  # keys below, at and above the bounds, null keys and null groups
        rows = [(i * 3 + least, g) for i in range(300) for g in (1, None)]
        rows += [(None, 1), (None, None), (-(1 << 60), 1), (1 << 60, None)]
        df = spark.createDataFrame(rows, "id long, g int")
        for width in (1, 50):
            got = assign_sequence(df, ["g"], "id", block_rows=width)
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, _naive(df).collect()), key=repr)
