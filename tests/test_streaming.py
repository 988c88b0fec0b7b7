"""stream = batch, restart adds nothing, offsets logged per batch."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.offsets import starting_offsets, starting_offsets_json
from ledgerline.plans import events as ev
from ledgerline.plans.replay import decode_messages
from ledgerline.operators.transform import transform_chain
from ledgerline.schemas import EVENT_RECORD
from ledgerline.sources.log import OffsetRange, read_log_stream
from ledgerline.streaming.ingest import batch_writer, drain, run_ingest, start_ingest

from tests.support import SF_SMALL


def _write_source(spark, root, files=4):
    src = os.path.join(root, "log")
    ev.events_log(spark, SF_SMALL).repartitionByRange(files, "offset").write.parquet(src)
    return src


def _ingest(spark, src, root):
    sink, olog, ckpt = (os.path.join(root, n) for n in ("table", "offsets", "ckpt"))
    q = start_ingest(read_log_stream(spark, src, max_files_per_trigger=1), sink, olog, ckpt, EVENT_RECORD, "ts_ms",
                     ev.APPNAME, ev.EVENT_STEPS, available_now=True)
    assert run_ingest(q, timeout_s=600)
    assert q.exception() is None
    return sink, olog


def test_stream_equals_batch_and_restart_adds_none(spark, scratch):
    root = scratch("stream")
    src = _write_source(spark, root)
    sink, olog = _ingest(spark, src, root)
    streamed = spark.read.parquet(sink).drop("appname", "batch_id")
    batch = transform_chain(decode_messages(ev.events_log(spark, SF_SMALL), EVENT_RECORD, "ts_ms"), ev.EVENT_STEPS)
    assert streamed.count() == 1000
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0
    n_batches = spark.read.parquet(olog).select("batch_id").distinct().count()
    assert n_batches == 4  # one file per trigger
    # restart from the same checkpoint: nothing new to read, nothing added
    _ingest(spark, src, root)
    assert spark.read.parquet(sink).count() == 1000
    log = spark.read.parquet(olog)
    folded = log.groupBy("partition").agg(F.min("start_offset").alias("s"), F.max("end_offset").alias("e"),
                                         F.sum(F.col("end_offset") - F.col("start_offset")).alias("n")).collect()
    assert sum(r["n"] for r in folded) == 1000 and all(r["s"] == 0 and r["e"] == r["n"] for r in folded)
    assert set(starting_offsets_json(starting_offsets(log, ev.APPNAME))) != set()


def test_rerun_of_a_batch_id_replaces_itself(spark, scratch):
    root = scratch("rerun")
    sink, olog = os.path.join(root, "table"), os.path.join(root, "offsets")
    write = batch_writer(EVENT_RECORD, "ts_ms", sink, olog, ev.APPNAME)
    batch = ev.events_log(spark, SF_SMALL).filter("offset < 50")
    write(batch, 0)
    write(batch, 0)  # a retried batch
    write(batch.limit(0), 1)  # an empty batch writes nothing
    assert spark.read.parquet(sink).count() == batch.count()
    assert spark.read.parquet(olog).count() == 4


def test_stream_from_recorded_offsets(spark, scratch):
    root = scratch("resume")
    src_dir = _write_source(spark, root, files=2)
    stream = read_log_stream(spark, src_dir, starts=[OffsetRange("events", 0, 100), OffsetRange("events", 1, 5)])
    name = "resume_t"
    q = stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.table(name)
    log = ev.events_log(spark, SF_SMALL)
    want = log.filter("(partition = 0 AND offset >= 100) OR (partition = 1 AND offset >= 5) OR partition > 1")
    assert got.count() == want.count()


def test_bad_payloads_go_to_quarantine_and_are_counted(spark, scratch):
    root = scratch("quarantine")
    sink, olog, bad = (os.path.join(root, n) for n in ("table", "offsets", "bad"))
    seen = {}
    write = batch_writer(EVENT_RECORD, "ts_ms", sink, olog, ev.APPNAME, quarantine=bad,
                         on_metrics=lambda b, m: seen.setdefault(b, m))
    batch = ev.events_log(spark, SF_SMALL).filter("offset < 40")
    broken = batch.withColumn("value", F.when(F.col("offset") % 10 == 0, F.substring("value", 1, 5))
                              .otherwise(F.col("value")))
    write(broken, 3)
    n = broken.count()
    n_bad = broken.filter("offset % 10 = 0").count()
    assert seen[3] == {"rows": n, "bad_rows": n_bad}
    assert spark.read.parquet(sink).count() == n - n_bad
    quarantined = spark.read.parquet(bad)
    assert quarantined.count() == n_bad and set(quarantined.columns) >= {"key", "value", "offset", "appname", "batch_id"}
    # the offset log still covers every message, good or bad
    assert spark.read.parquet(olog).agg(F.sum(F.col("end_offset") - F.col("start_offset"))).first()[0] == n


def test_compaction_keeps_every_row(spark, scratch):
    from ledgerline.sinks.tables import compact

    root = scratch("compact")
    src = _write_source(spark, root, files=4)
    sink, _ = _ingest(spark, src, root)
    dst = os.path.join(root, "compacted")
    compact(spark, sink, dst)
    before = spark.read.parquet(sink).drop("appname", "batch_id")
    after = spark.read.parquet(dst)
    assert sorted(after.columns) == sorted(before.columns)
    assert after.count() == before.count() == 1000
    assert after.select(*before.columns).exceptAll(before).count() == 0
    local = lambda p: p[len("file:"):] if p.startswith("file:") else p
    n_files = lambda p: sum(f.endswith(".parquet") for _, _, fs in os.walk(local(p)) for f in fs)
    assert n_files(dst) < n_files(sink)


def test_crash_between_data_and_offsets_then_restart(spark, scratch, monkeypatch):
    import ledgerline.streaming.ingest as ingest

    root = scratch("crash")
    src = _write_source(spark, root, files=4)
    real = ingest.write_offset_log
    calls = {"n": 0}

    def flaky(rows, path, idempotent=True):
        calls["n"] += 1
        if calls["n"] == 2:  # batch 1: its data is written, then the job dies
            raise RuntimeError("executor lost")
        real(rows, path, idempotent)

    monkeypatch.setattr(ingest, "write_offset_log", flaky)
    sink, olog, ckpt = (os.path.join(root, n) for n in ("table", "offsets", "ckpt"))

    def run():
        q = start_ingest(read_log_stream(spark, src, max_files_per_trigger=1), sink, olog, ckpt, EVENT_RECORD,
                         "ts_ms", ev.APPNAME, ev.EVENT_STEPS, available_now=True)
        try:
            q.awaitTermination(600)
        except Exception:  # noqa: BLE001 - the first run fails by design
            pass
        return q

    first = run()
    assert first.exception() is not None
    second = run()
    assert second.exception() is None
    table = spark.read.parquet(sink)
    assert table.count() == 1000 and table.select("event_id").distinct().count() == 1000
    log = spark.read.parquet(olog)
    assert log.agg(F.sum(F.col("end_offset") - F.col("start_offset"))).first()[0] == 1000
    assert log.select("batch_id").distinct().count() == 4


def test_cached_batches_give_the_same_result(spark, scratch):
    root = scratch("cached")
    sink, olog = os.path.join(root, "table"), os.path.join(root, "offsets")
    write = batch_writer(EVENT_RECORD, "ts_ms", sink, olog, ev.APPNAME, ev.EVENT_STEPS, cache_batch=True)
    batch = ev.events_log(spark, SF_SMALL).filter("offset < 60")
    write(batch, 5)
    write(batch, 5)
    want = transform_chain(decode_messages(batch, EVENT_RECORD, "ts_ms"), ev.EVENT_STEPS)
    got = spark.read.parquet(sink).drop("appname", "batch_id")
    assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0
    assert not batch.is_cached


def test_new_query_resumes_from_recorded_offsets(spark, scratch):
    from ledgerline.sources.log import resume_points

    root = scratch("resume_log")
    log = ev.events_log(spark, SF_SMALL)
    early, late = os.path.join(root, "early"), os.path.join(root, "late")
    log.filter("offset < 100").write.parquet(early)
    sink, olog = os.path.join(root, "table"), os.path.join(root, "offsets")
    q = start_ingest(read_log_stream(spark, early), sink, olog, os.path.join(root, "ckpt1"), EVENT_RECORD, "ts_ms",
                     ev.APPNAME, available_now=True)
    run_ingest(q, 600)
    # the whole log arrives elsewhere; a new query with a new checkpoint resumes where the offset log ends
    log.write.parquet(late)
    starts = resume_points(starting_offsets(spark.read.parquet(olog), ev.APPNAME))
    assert {s.from_offset for s in starts} == {100}
    q2 = start_ingest(read_log_stream(spark, late, starts=starts), sink, olog, os.path.join(root, "ckpt2"),
                      EVENT_RECORD, "ts_ms", ev.APPNAME, available_now=True)
    run_ingest(q2, 600)
    table = spark.read.parquet(sink)
    assert table.count() == 1000 and table.select("event_id").distinct().count() == 1000


def test_ingest_then_compact_then_merge_a_version(spark, scratch):
    from ledgerline.plans.replay import replay_offsets
    from ledgerline.plans.versions import merge_version
    from ledgerline.sinks.tables import compact

    root = scratch("lifecycle")
    src = _write_source(spark, root, files=2)
    sink, _ = _ingest(spark, src, root)
    compact(spark, sink, os.path.join(root, "v0"))
    base_name = f"events_{os.urandom(4).hex()}"
    spark.read.parquet(os.path.join(root, "v0")).write.option("path", os.path.join(root, "base")).saveAsTable(base_name)
    log = ev.events_log(spark, SF_SMALL)
    deltas = replay_offsets(log, [OffsetRange("events", 0, 0, 50)], EVENT_RECORD, "ts_ms",
                            {"sql01": "SELECT event_id, ts_ms, user_id, 'fixed' AS event_type, value, props, mon, day, hour"})
    name = merge_version(spark, base_name, deltas, ["event_id"], version="v1", path=os.path.join(root, "v1"))
    merged = spark.table(name)
    assert merged.count() == 1000
    assert merged.filter("event_type = 'fixed'").count() == 50


def test_a_batch_of_only_bad_payloads_leaves_the_table_readable(spark, scratch):
    root = scratch("allbad")
    sink, olog = os.path.join(root, "table"), os.path.join(root, "offsets")
    write = batch_writer(EVENT_RECORD, "ts_ms", sink, olog, ev.APPNAME, on_metrics=None, on_bad="drop")
    log = ev.events_log(spark, SF_SMALL)
    write(log.filter("offset < 20"), 0)
    write(log.filter("offset >= 20 AND offset < 30").withColumn("value", F.lit(b"{bad")), 1)
    write(log.filter("offset >= 30 AND offset < 40"), 2)
    table = spark.read.parquet(sink)
    assert table.count() == log.filter("offset < 20 OR (offset >= 30 AND offset < 40)").count()
    assert sorted(r[0] for r in table.select("batch_id").distinct().collect()) == [0, 2]
    assert spark.read.parquet(olog).select("batch_id").distinct().count() == 3  # offsets of the bad batch too


def test_two_apps_share_a_table(spark, scratch):
    root = scratch("apps")
    sink, olog = f"{root}/table", f"{root}/offsets"
    log = ev.events_log(spark, SF_SMALL).filter("offset < 50")
    for app in ("a", "b/c=d e%"):
        batch_writer(EVENT_RECORD, "ts_ms", sink, olog, app)(log, 0)
    table = spark.read.parquet(sink)
    assert {r[0]: r[1] for r in table.groupBy("appname").count().collect()} == {"a": log.count(), "b/c=d e%": log.count()}


def test_an_unreadable_offset_log_stops_a_new_query(spark, scratch):
    from ledgerline.streaming.ingest import batch_id_base

    root = scratch("unreadable")
    olog = f"{root}/offsets"
    assert batch_id_base(spark, f"{root}/c0", olog, "a") == 0  # nothing recorded yet
    batch_writer(EVENT_RECORD, "ts_ms", f"{root}/table", olog, "a")(ev.events_log(spark, SF_SMALL).filter("offset < 5"), 4)
    assert batch_id_base(spark, f"{root}/c1", olog, "a") == 5
    assert batch_id_base(spark, f"{root}/c1", olog, "a") == 5  # the marker stands
    assert batch_id_base(spark, f"{root}/c2", olog, "other") == 0
    spark.createDataFrame([("not parquet",)], "value string").write.text(f"{olog}/appname=a/batch_id=9")
    with pytest.raises(Exception, match="(?i)parquet|corrupt|magic"):
        batch_id_base(spark, f"{root}/c3", olog, "a")


def test_bad_payloads_fail_a_batch_by_default_and_none_reaches_the_table(spark, scratch):
    root = scratch("bad")
    log = ev.events_log(spark, SF_SMALL).filter("offset < 40")
    value = F.col("value")
    kinds = [F.lit(b""), F.lit(b"  "), F.lit(b"{}"), F.concat(value, F.lit(b"{\"x\"")), F.lit(b"[]"), F.lit(b"7"), F.lit(None).cast("binary")]
    broken = log
    for i, kind in enumerate(kinds):
        broken = broken.withColumn("value", F.when(F.col("offset") == i, kind).otherwise(value))
    with pytest.raises(Exception, match="bad payload"):
        batch_writer(EVENT_RECORD, "ts_ms", f"{root}/t0", f"{root}/o0", "a")(broken, 0)
    seen = {}
    batch_writer(EVENT_RECORD, "ts_ms", f"{root}/t", f"{root}/o", "a", quarantine=f"{root}/q", on_metrics=lambda b, m: seen.update(m))(broken, 0)
    n, n_bad = broken.count(), broken.filter(F.col("offset") < len(kinds)).count()
    assert seen == {"rows": n, "bad_rows": n_bad}
    table = spark.read.parquet(f"{root}/t")
    assert table.count() == n - n_bad and table.filter("mon IS NULL OR event_id IS NULL").count() == 0
    assert spark.read.parquet(f"{root}/q").count() == n_bad


def test_ingest_into_a_catalog_table_with_years(spark, scratch):
    root = scratch("catalog")
    name = f"ingested_{os.urandom(4).hex()}"
    log = ev.events_log(spark, SF_SMALL)
    write = batch_writer(EVENT_RECORD, "ts_ms", f"{root}/t", f"{root}/o", "it's", table=name, with_year=True)
    for i, part in enumerate(("offset < 100", "offset >= 100", "offset >= 100")):
        write(log.filter(part), min(i, 1))  # the last one again
    table = spark.table(name)
    assert table.count() == 1000 and {r[0] for r in table.select("year").distinct().collect()} == {2024}
    assert table.columns[-6:] == ["appname", "batch_id", "year", "mon", "day", "hour"]


def test_a_query_that_does_not_end_raises(spark, scratch):
    root = scratch("endless")
    src = _write_source(spark, root, files=2)
    q = start_ingest(read_log_stream(spark, src, max_files_per_trigger=1), f"{root}/t", f"{root}/o", f"{root}/c", EVENT_RECORD, "ts_ms",
                     "a", trigger_seconds=1)
    with pytest.raises(TimeoutError):
        drain(q, 3)
    assert not q.isActive


def test_a_batch_is_scanned_at_most_twice(spark, scratch):
    root = scratch("scans")
    path = f"{root}/log"
    ev.events_log(spark, SF_SMALL).write.parquet(path)
    counter = spark.sparkContext.accumulator(0)

    def counted(batches):
        counter.add(1)
        yield from batches

    batch = spark.read.parquet(path).coalesce(1).mapInArrow(counted, spark.read.parquet(path).schema)
    batch_writer(EVENT_RECORD, "ts_ms", f"{root}/t", f"{root}/o", "a")(batch, 0)
    assert counter.value <= 2
    before = counter.value
    batch_writer(EVENT_RECORD, "ts_ms", f"{root}/t", f"{root}/o", "a", cache_batch=True)(batch, 1)
    assert counter.value - before == 1


def test_offset_log_compaction_prunes_on_time(spark, scratch):
    from ledgerline.operators.offsets import OFFSET_LOG_COLUMNS, scan_offset_log
    from ledgerline.sinks.tables import compact_offset_log, read_offset_log, write_offset_log

    root = scratch("olog")
    rows = ev.hourly_offset_log(ev.events_log(spark, SF_SMALL))
    write_offset_log(rows, f"{root}/log")
    compact_offset_log(spark, f"{root}/log", f"{root}/compact", files=3)
    compact = read_offset_log(spark, f"{root}/compact")
    assert compact.columns == OFFSET_LOG_COLUMNS
    assert compact.exceptAll(rows).count() == 0 and compact.count() == rows.count()
    assert len(compact.inputFiles()) <= 3
    plan = scan_offset_log(compact, ev.APPNAME, 0, 5)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(batch_ts" in plan and "PartitionFilters: [isnotnull(appname" in plan


def test_app_names_are_whole_in_the_catalog_table(spark, scratch):
    """Names with characters that paths escape, and others that they do not."""
    root = scratch("names")
    table = "names_" + root.rsplit("/", 1)[-1]
    batch = ev.events_log(spark, SF_SMALL).filter("offset < 20")
    apps = ["app+1", "a,b", "caf\u00e9", "x=1%20/y", "it's \\ \"q\" #[]{}", "app one/a", "a:b*c?^"]
    for app in apps:
        batch_writer(EVENT_RECORD, "ts_ms", os.path.join(root, "table"), os.path.join(root, "offsets"), app, table=table)(batch, 0)
    n = batch.count()
    assert {r["appname"]: r["count"] for r in spark.table(table).groupBy("appname").count().collect()} == dict.fromkeys(apps, n)
    assert {r["appname"]: r["count"] for r in spark.read.parquet(os.path.join(root, "table")).groupBy("appname").count().collect()} == dict.fromkeys(apps, n)
    assert spark.table(table).filter("appname = 'app+1' AND batch_id = 0").count() == n
    with pytest.raises(ValueError):
        batch_writer(EVENT_RECORD, "ts_ms", os.path.join(root, "table"), os.path.join(root, "offsets"), "")(batch, 0)


def test_a_batch_of_only_bad_payloads_with_a_catalog_table(spark, scratch):
    for more in ({"quarantine": True}, {"on_bad": "drop"}):
        root = scratch("allbad")
        table = "allbad_" + root.rsplit("/", 1)[-1]
        if "quarantine" in more:
            more = {"quarantine": os.path.join(root, "bad")}
        seen = {}
        write = batch_writer(EVENT_RECORD, "ts_ms", os.path.join(root, "table"), os.path.join(root, "offsets"), "a", table=table,
                             on_metrics=lambda b, m, s=seen: s.setdefault(b, m), **more)
        log = ev.events_log(spark, SF_SMALL).filter("offset < 30")
        write(log.withColumn("value", F.lit(b"{")), 0)
        write(log, 1)
        n = log.count()
        assert spark.table(table).count() == n and seen == {0: {"rows": n, "bad_rows": n}, 1: {"rows": n, "bad_rows": 0}}


def test_batches_of_files_are_not_cached(spark, scratch):
    from ledgerline.streaming.ingest import _fetched_by_query

    path = os.path.join(scratch("kafka"), "kafka")  # the name of a path says nothing about the source
    ev.events_log(spark, SF_SMALL).limit(5).write.parquet(path)
    assert not _fetched_by_query(read_log_stream(spark, path))
    assert _fetched_by_query(spark.readStream.format("rate").load())
