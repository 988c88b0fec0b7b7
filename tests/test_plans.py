"""Plan regression checks: the shapes the performance rests on."""

import __spark_entry__ as entry
from ledgerline.plans import events as ev
from ledgerline.plans.replay import decode_messages, replay_offsets, replay_time
from ledgerline.schemas import EVENT_RECORD
from ledgerline.sinks.tables import write_log
from ledgerline.sources.log import read_log

from tests.support import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_replay_from_a_log_at_rest_has_no_shuffle_and_pushes_offsets(spark, scratch):
    path = scratch("log")
    write_log(ev.events_log(spark, SF_SMALL), path)
    log = read_log(spark, path)
    olog_path = scratch("olog")
    ev.hourly_offset_log(log).write.parquet(olog_path)
    replay = replay_time(log, spark.read.parquet(olog_path), ev.APPNAME, entry.RANGE_BEGIN, entry.RANGE_END,
                         EVENT_RECORD, "ts_ms", ev.EVENT_STEPS)
    plan = _plan(replay)
    # the log side is never shuffled: the bounds, one row per partition, are broadcast
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    log_scan = next(x for x in plan.split("FileScan") if "value" in x.split("ReadSchema")[-1][:80])
    # the bounds are computed once: the least and the greatest, and the partitions, are literals at the scan
    assert "GreaterThanOrEqual(offset" in log_scan and "LessThan(offset" in log_scan
    assert "partition#" in log_scan.split("PartitionFilters: [")[1].split("]")[0]
    assert plan.count("FileScan") <= 3  # the log, the bounds, and these once more where partitions prune at run time


def test_replay_of_listed_ranges_is_a_pushed_down_scan(spark, scratch):
    path = scratch("log")
    write_log(ev.events_log(spark, SF_SMALL), path)
    plan = _plan(replay_offsets(read_log(spark, path), entry.REPLAY_BOUNDS, EVENT_RECORD, "ts_ms", ev.EVENT_STEPS))
    assert "Exchange" not in plan
    assert "PartitionFilters: [" in plan and "GreaterThanOrEqual(offset" in plan and "LessThan(offset" in plan


def test_merge_reads_the_base_once(spark):
    assert _plan(entry.queries()["merge_by_key"](spark, SF_SMALL)).count("FileScan") == 3  # base, delta keys, deltas


def test_map_only_queries_do_not_shuffle(spark):
    for name in ("transform_chain", "publish", "keyword_filter", "sanitize_text", "partition_fields",
                 "route_partition", "safe_casts"):
        assert "Exchange" not in _plan(entry.queries()[name](spark, SF_SMALL)), name


def test_payload_is_parsed_once(spark):
    decoded = decode_messages(ev.events_log(spark, SF_SMALL), EVENT_RECORD, "ts_ms")
    assert _plan(decoded).count("from_json") == 1


def test_offset_log_aggregates_are_partial(spark):
    plan = _plan(entry.queries()["latest_offsets"](spark, SF_SMALL))
    assert "partial_max_by" in plan
