"""M1/M2 properties: replay is exact, and replaying batch by batch equals one replay."""

from functools import reduce

from pyspark.sql import functions as F

from ledgerline.operators.sequence import assign_sequence
from ledgerline.plans import events as ev
from ledgerline.plans.replay import decode_messages, replay_offsets, replay_time
from ledgerline.schemas import EVENT_RECORD
from ledgerline.sinks.tables import write_log
from ledgerline.sources.log import OffsetRange, read_log, read_offset_range

from tests.support import SF_SMALL

BEGIN, END = 1704412800, 1705017600


def test_batch_by_batch_equals_one_replay(spark, scratch):
    path = scratch("log")
    write_log(ev.events_log(spark, SF_SMALL), path)
    log = read_log(spark, path)
    olog = ev.hourly_offset_log(log)
    end = BEGIN + 86400  # one day: a few dozen batches keep the union small
    once = replay_time(log, olog, ev.APPNAME, BEGIN, end, EVENT_RECORD, "ts_ms")
    batches = olog.filter((F.col("batch_ts") > BEGIN) & (F.col("batch_ts") <= end)).collect()
    assert batches
    pieces = [
        replay_offsets(log, [OffsetRange(b["topic"], b["partition"], b["start_offset"], b["end_offset"])],
                       EVENT_RECORD, "ts_ms")
        for b in batches
    ]
    one_by_one = reduce(lambda a, b: a.unionByName(b), pieces)
    assert one_by_one.count() == once.count()
    assert one_by_one.exceptAll(once).count() == 0


def test_replay_time_reads_only_its_batches(spark):
    log = ev.events_log(spark, SF_SMALL)
    olog = ev.hourly_offset_log(log)
    got = replay_time(log, olog, ev.APPNAME, BEGIN, END, EVENT_RECORD, "ts_ms")
    # covering: every message of every batch whose newest second is in (BEGIN, END]
    hours = olog.filter((F.col("batch_ts") > BEGIN) & (F.col("batch_ts") <= END)).select("partition", "batch_id")
    decoded = decode_messages(log.withColumn("batch_id", F.floor(F.unix_seconds("timestamp") / 3600).cast("long")),
                              EVENT_RECORD, "ts_ms")
    want = (log.withColumn("batch_id", F.floor(F.unix_seconds("timestamp") / 3600).cast("long"))
            .join(hours, ["partition", "batch_id"]).count())
    assert got.count() == want
    assert decoded.count() == log.count()
    # minute-text arguments mean the same instants
    txt = replay_time(log, olog, ev.APPNAME, "20240105T00:00", "20240112T00:00", EVENT_RECORD, "ts_ms")
    assert txt.count() == got.count()


def test_sequence_with_a_hot_group(spark):
    # a third of the rows in one group: blocks keep the window tasks small
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 7 + 1).alias("g"))
    out = assign_sequence(df, ["g"], "id", "offset", block_rows=50)
    stats = out.groupBy("g").agg(F.count("*").alias("n"), F.max("offset").alias("hi"),
                                 F.countDistinct("offset").alias("d")).collect()
    assert all(r["hi"] == r["n"] - 1 == r["d"] - 1 for r in stats)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__blk" in plan and "Window" in plan


def test_bad_payloads_of_a_replay(spark, scratch):
    import pytest
    from pyspark.sql import Observation

    log = ev.events_log(spark, SF_SMALL)
    broken = log.withColumn("value", F.when(F.col("offset") % 10 == 0, F.lit(b"")).otherwise(F.col("value")))
    bounds = [OffsetRange("events", 0, 0, 50)]
    n, n_bad = (read_offset_range(broken, bounds).filter(c).count() for c in ("true", "offset % 10 = 0"))
    with pytest.raises(Exception, match="bad payload: events 0"):
        replay_offsets(broken, bounds, EVENT_RECORD, "ts_ms").collect()
    seen = Observation("replay")
    assert replay_offsets(broken, bounds, EVENT_RECORD, "ts_ms", on_bad="drop", counts=seen).count() == n - n_bad
    assert seen.get == {"rows": n, "bad_rows": n_bad}
    path = scratch("quarantine")
    good = replay_offsets(broken, bounds, EVENT_RECORD, "ts_ms", quarantine=path)
    assert good.count() + spark.read.parquet(path).count() == n
    with pytest.raises(ValueError):
        decode_messages(log, EVENT_RECORD, "ts_ms", on_bad="quarantine")


def test_a_replay_result_is_what_was_written(spark, scratch):
    log = ev.events_log(spark, SF_SMALL)
    out = replay_offsets(log, [OffsetRange("events", 0, 0, 30)], EVENT_RECORD, "ts_ms", sink=scratch("t"))
    assert out.count() == 30 and "from_json" not in out._jdf.queryExecution().executedPlan().toString()


def test_a_replay_does_not_mix_layouts(spark, scratch):
    import pytest

    from ledgerline.streaming.ingest import batch_writer

    log = ev.events_log(spark, SF_SMALL).filter("offset < 20")
    sink = scratch("ingested")
    batch_writer(EVENT_RECORD, "ts_ms", sink, scratch("o"), "a")(log, 0)
    before = spark.read.parquet(sink).count()
    with pytest.raises(ValueError, match="another layout"):
        replay_offsets(log, [OffsetRange("events", 0, 0, 5)], EVENT_RECORD, "ts_ms", sink=sink)
    assert spark.read.parquet(sink).count() == before


def test_replay_appends_to_a_catalog_table(spark, scratch):
    log = ev.events_log(spark, SF_SMALL)
    bounds = [OffsetRange("events", 0, 0, 30), OffsetRange("events", 1, 0, 20)]
    replay_offsets(log, bounds, EVENT_RECORD, "ts_ms", ev.EVENT_STEPS, sink=scratch("t"), table="replayed_t1")
    replay_offsets(log, bounds, EVENT_RECORD, "ts_ms", ev.EVENT_STEPS, table="replayed_t1")
    t = spark.table("replayed_t1")
    assert t.count() == 100 and t.columns[-3:] == ["mon", "day", "hour"]
