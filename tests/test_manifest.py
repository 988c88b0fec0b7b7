"""Committed batches: readers see each batch whole, before, during and after a rewrite."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import events as ev
from ledgerline.plans.replay import decode_messages
from ledgerline.schemas import EVENT_RECORD
from ledgerline.sinks.manifest import (
    commit_batch,
    committed_batches,
    compact_committed,
    committed_offsets,
    drop_superseded,
    generations,
    new_attempt,
    read_committed,
    tier_of,
)
from ledgerline.sinks.tables import read_offset_log
from ledgerline.streaming import ingest
from ledgerline.streaming.ingest import batch_writer

from tests.support import SF_SMALL

APP = "app+1 é/=%"


@pytest.fixture(scope="module")
def schema(spark):
    return decode_messages(ev.events_log(spark, SF_SMALL), EVENT_RECORD, "ts_ms").schema


def _writer(root, **more):
    sink, olog = os.path.join(root, "table"), os.path.join(root, "offsets")
    return sink, olog, batch_writer(EVENT_RECORD, "ts_ms", sink, olog, APP, committed=True, **more)


def test_nothing_committed_reads_as_empty(spark, scratch, schema):
    sink = scratch("none")
    assert committed_batches(spark, sink).count() == 0 and read_committed(spark, sink, schema).count() == 0


def test_batches_and_their_rewrite(spark, scratch, schema):
    sink, olog, write = _writer(scratch("committed"))
    log = ev.events_log(spark, SF_SMALL)
    first, second = log.filter("offset < 50"), log.filter("offset >= 50 AND offset < 80")
    write(first, 0)
    before = read_committed(spark, sink, schema)
    write(second, 1)
    write(first.filter("offset < 20"), 0)  # a retry that holds less
    now = read_committed(spark, sink, schema)
    assert now.filter("batch_id = 0").count() == first.filter("offset < 20").count()
    assert now.filter("batch_id = 1").count() == second.count()
    assert [r[0] for r in now.select("appname").distinct().collect()] == [APP]
    # a reader that began before the rewrite reads what it saw then, whole
    assert before.count() == first.count() and before.select("batch_id").distinct().count() == 1
    assert read_committed(spark, sink, schema, F.col("batch_id") == 1).count() == second.count()
    told = {r["batch_id"]: r for r in committed_batches(spark, sink).collect()}
    assert told[0]["attempt"] == 2 and told[1]["attempt"] == 1 and told[1]["rows"] == second.count() and told[1]["bad_rows"] == 0
    assert sorted(map(tuple, committed_offsets(spark, sink).collect())) == sorted(map(tuple, read_offset_log(spark, olog).collect()))
    assert drop_superseded(spark, sink) == 1
    assert read_committed(spark, sink, schema).count() == now.count()


def test_an_attempt_without_its_record_is_not_seen(spark, scratch, schema, monkeypatch):
    sink, olog, write = _writer(scratch("crash"))
    log = ev.events_log(spark, SF_SMALL)
    write(log.filter("offset < 50"), 0)

    def crash(*args, **kwargs):
        raise RuntimeError("the driver died before the record")

    with monkeypatch.context() as m:
        m.setattr(ingest, "commit_batch", crash)
        with pytest.raises(RuntimeError):
            write(log.filter("offset < 70"), 0)
        with pytest.raises(RuntimeError):
            write(log.filter("offset >= 50"), 1)
    assert read_committed(spark, sink, schema).count() == log.filter("offset < 50").count()
    write(log.filter("offset >= 50"), 1)  # the retry
    assert read_committed(spark, sink, schema).count() == log.count()


def test_a_batch_of_only_bad_payloads(spark, scratch, schema):
    root = scratch("bad")
    sink, olog, write = _writer(root, quarantine=os.path.join(root, "bad"))
    bad = ev.events_log(spark, SF_SMALL).filter("offset < 30").withColumn("value", F.lit(b"{}"))
    write(bad, 0)
    assert read_committed(spark, sink, schema).count() == 0
    told = committed_batches(spark, sink).first()
    assert told["rows"] == 0 and told["bad_rows"] == bad.count() and told["files"] == []
    assert committed_offsets(spark, sink).agg(F.sum(F.col("end_offset") - F.col("start_offset"))).first()[0] == bad.count()


def test_two_apps_keep_apart(spark, scratch, schema):
    sink = scratch("apps")
    rows = decode_messages(ev.events_log(spark, SF_SMALL), EVENT_RECORD, "ts_ms").withColumn("appname", F.lit("x"))
    for app in ("a", "A", "b"):
        folder = new_attempt(sink, app, 4)
        rows.withColumn("appname", F.lit(app)).limit(10).write.partitionBy("mon", "day", "hour").parquet(folder)
        commit_batch(spark, sink, app, 4, folder, [("events", 0, 7, 0, 10)], 10, 0)
    got = {r["appname"]: r["count"] for r in read_committed(spark, sink, schema).groupBy("appname").count().collect()}
    assert got == {"a": 10, "A": 10, "b": 10}


def test_idle_partitions_are_recorded(spark, scratch):
    sink, olog, write = _writer(scratch("idle"), idle_partitions=True)
    log = ev.events_log(spark, SF_SMALL)
    write(log.filter("partition = 1 AND offset < 10"), 0)
    write(log.filter("partition = 2 AND offset < 5"), 1)
    write(log.filter("partition = 1 AND offset >= 10 AND offset < 12"), 2)
    write(log.filter("partition = 1 AND offset >= 10 AND offset < 12"), 2)  # a retry records the same
    got = sorted((r["batch_id"], r["partition"], r["start_offset"], r["end_offset"]) for r in read_offset_log(spark, olog).collect())
    assert got == [(0, 1, 0, 10), (1, 1, 10, 10), (1, 2, 0, 5), (2, 1, 10, 12), (2, 2, 5, 5)]
    ends = read_offset_log(spark, olog).groupBy("partition").agg(F.max("end_offset")).collect()
    assert {tuple(r) for r in ends} == {(1, 12), (2, 5)}


def test_a_catalog_table_and_commit_records_exclude_each_other(scratch):
    with pytest.raises(ValueError):
        batch_writer(EVENT_RECORD, "ts_ms", scratch("x"), scratch("y"), APP, committed=True, table="t")


def _rows(df):
    return sorted(map(tuple, df.select("batch_id", "event_id", "event_type", "hour").collect()))


def test_compaction_by_tiers(spark, scratch, schema):
    sink, olog, write = _writer(scratch("tiers"))
    log = ev.events_log(spark, SF_SMALL)
    for i in range(5):
        write(log.filter(f"offset >= {10 * i} AND offset < {10 * i + 10}"), i)
    want = _rows(read_committed(spark, sink, schema))
    assert len(compact_committed(spark, sink, schema)) == 1
    assert _rows(read_committed(spark, sink, schema)) == want
    assert all("/generations/" in f for f in read_committed(spark, sink, schema).inputFiles())
    # a second pass has one generation and three batches of the tier: it reads these alone
    assert compact_committed(spark, sink, schema) == []
    for i in range(5, 8):
        write(log.filter(f"offset >= {10 * i} AND offset < {10 * i + 10}"), i)
    assert {("data" if "/data/" in f else "generations") for f in read_committed(spark, sink, schema).inputFiles()} == {"data", "generations"}
    write(log.filter("offset < 3"), 2)  # a covered batch is rewritten
    want = [r for r in want if r[0] != 2] + _rows(read_committed(spark, sink, schema, F.col("batch_id").isin(2, 5, 6, 7)))
    assert _rows(read_committed(spark, sink, schema)) == sorted(want)
    assert sum(r[0] == 2 for r in want) == log.filter("offset < 3").count()
    made = compact_committed(spark, sink, schema)
    assert len(made) == 1 and [r["gen"] for r in generations(spark, sink).collect()] == made
    assert _rows(read_committed(spark, sink, schema)) == sorted(want)
    assert read_committed(spark, sink, schema, F.col("batch_id") == 6).count() == log.filter("offset >= 60 AND offset < 70").count()


def test_a_pass_reads_only_what_came_since(spark, scratch, schema, monkeypatch):
    """Large generations stay: a pass touches the batches since the last one."""
    from ledgerline.sinks import manifest

    sink, olog, write = _writer(scratch("since"))
    log = ev.events_log(spark, SF_SMALL)
    for i in range(8):
        write(log.filter(f"offset >= {10 * i} AND offset < {10 * i + 10}"), i)
        if i == 3:
            compact_committed(spark, sink, schema, smallest=200_000)
            first = {f for r in generations(spark, sink).collect() for f in r["files"]}
    read = []
    real = manifest._read_files
    monkeypatch.setattr(manifest, "_read_files", lambda s, k, b, files, full: read.extend(files) or real(s, k, b, files, full))
    monkeypatch.setattr(manifest, "tier_of", lambda size, *a: 1 if size >= manifest._bytes(spark, sink, sorted(first)) else 0)
    assert len(compact_committed(spark, sink, schema)) == 1
    assert read and not set(read) & first and all(f.startswith("data/") and int(f.split("batch_id=")[1].split("/")[0]) > 3 for f in read)
    assert read_committed(spark, sink, schema).count() == log.filter("offset < 80").count()


def test_tiers():
    assert [tier_of(s, 100, 4) for s in (0, 100, 101, 400, 401, 1600, 1601)] == [0, 0, 1, 1, 2, 2, 3]
