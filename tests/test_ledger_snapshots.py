"""Publishes that may be repeated, and latest offsets from a snapshot and its tail."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.offsets import latest_offsets
from ledgerline.plans import events as ev
from ledgerline.sinks import ledger, snapshots
from ledgerline.sinks.ledger import publish_once, published_ids
from ledgerline.sinks.snapshots import latest_recorded, recent_entries, recorded_batches, snapshot_offsets
from ledgerline.sinks.tables import publish_log, read_offset_log, write_offset_log
from ledgerline.sources.log import read_log

from tests.support import SF_SMALL


def _messages(spark, ids):
    rows = spark.createDataFrame([(i, i % 3) for i in ids], "i long, p int")
    text = F.col("i").cast("string").cast("binary")
    return rows.select(text.alias("key"), text.alias("value"), F.lit("t").alias("topic"), F.col("p").alias("partition"),
                       F.timestamp_seconds(F.lit(0)).alias("timestamp"), F.col("i").alias("__order"))


def _whole(spark, path, ids):
    """Every message once, offsets without gap or repeat in each partition."""
    rows = read_log(spark, path).select("partition", "offset", F.col("key").cast("string").cast("long").alias("i")).collect()
    assert sorted(r["i"] for r in rows) == sorted(ids)
    for p in range(3):
        assert sorted(r["offset"] for r in rows if r["partition"] == p) == list(range(sum(i % 3 == p for i in ids)))


def test_a_repeat_adds_nothing(spark, scratch):
    path = scratch("log")
    assert publish_once(spark, path, _messages(spark, range(20)), "a") == 20
    assert publish_once(spark, path, _messages(spark, range(20)), "a") == 0
    assert publish_once(spark, path, _messages(spark, range(20, 31)), "b") == 11
    publish_log(_messages(spark, range(31, 33)), path)  # without an id, as before
    publish_log(_messages(spark, range(20)), path, publish_id="a")
    _whole(spark, path, range(33))
    assert {(r[0], r[2], r[3]) for r in published_ids(spark, path).collect()} == {
        ("a", 0, 7), ("a", 1, 7), ("a", 2, 6), ("b", 0, 11), ("b", 1, 10), ("b", 2, 10)}
    assert publish_once(spark, path, _messages(spark, []), "none") == 0 and publish_once(spark, path, _messages(spark, []), "none") == 0
    with pytest.raises(ValueError):
        publish_once(spark, path, _messages(spark, [1]), "")


class Crash(RuntimeError):
    pass


def _crash(*args, **kwargs):
    raise Crash


def test_a_crash_before_offsets_are_taken(spark, scratch, monkeypatch):
    path = scratch("log")
    publish_once(spark, path, _messages(spark, range(5)), "first")
    real = ledger.number_messages

    def numbered_then_crash(*args):
        real(*args)
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(ledger, "number_messages", numbered_then_crash)
        with pytest.raises(Crash):
            publish_once(spark, path, _messages(spark, range(5, 12)), "a")
    publish_once(spark, path, _messages(spark, range(12, 15)), "other")  # takes the offsets meanwhile
    assert publish_once(spark, path, _messages(spark, range(5, 12)), "a") == 7
    _whole(spark, path, range(15))


def test_a_crash_between_offsets_and_messages(spark, scratch, monkeypatch):
    path = scratch("log")
    publish_once(spark, path, _messages(spark, range(5)), "first")
    with monkeypatch.context() as m:
        m.setattr(ledger, "append_numbered", _crash)
        with pytest.raises(Crash):
            publish_once(spark, path, _messages(spark, range(5, 12)), "a")
    publish_once(spark, path, _messages(spark, range(12, 15)), "other")
    assert publish_once(spark, path, _messages(spark, range(5, 12)), "a") == 7  # into the offsets it had taken
    _whole(spark, path, range(15))


def test_a_crash_within_the_messages(spark, scratch, monkeypatch):
    path = scratch("log")
    real = ledger.append_numbered

    def half(rows, where):
        real(rows.filter("offset % 2 = 0"), where)
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(ledger, "append_numbered", half)
        with pytest.raises(Crash):
            publish_once(spark, path, _messages(spark, range(12)), "a")
    assert publish_once(spark, path, _messages(spark, range(12)), "a") == 6
    assert publish_once(spark, path, _messages(spark, range(12)), "a") == 0
    _whole(spark, path, range(12))


def test_latest_from_a_snapshot_and_its_tail(spark, scratch):
    path = scratch("offsets")
    app = "app+1 é"
    whole = ev.hourly_offset_log(ev.events_log(spark, SF_SMALL), app)
    ids = sorted(r[0] for r in whole.select("batch_id").distinct().collect())[:12]
    write_offset_log(whole.filter(F.col("batch_id").isin(ids[:8])), path)
    write_offset_log(whole.filter(F.col("batch_id").isin(ids[:3])).withColumn("appname", F.lit("other")), path)
    assert recorded_batches(spark, path, app) == ids[:8]
    assert snapshot_offsets(spark, path, app) == ids[7] and snapshot_offsets(spark, path, app) == ids[7]
    write_offset_log(whole.filter(F.col("batch_id").isin(ids[8:11])), path)
    rows = lambda df: sorted(map(tuple, df.collect()))
    want = rows(latest_offsets(read_offset_log(spark, path), app))
    assert rows(latest_recorded(spark, path, app)) == want
    # of the log's eleven batches the snapshot and three folders are read
    folders = {os.path.dirname(f) for f in recent_entries(spark, path, app).inputFiles()}
    assert len(folders) == 4 and sum("-snapshots/" in f for f in folders) == 1
    before = whole.filter(F.col("batch_id") < ids[5])
    assert rows(latest_recorded(spark, path, app, before=ids[5])) == rows(latest_offsets(before, app))
    assert snapshot_offsets(spark, path, app) == ids[10]  # from the last one and its tail
    assert len(recent_entries(spark, path, app).inputFiles()) == 1 and rows(latest_recorded(spark, path, app)) == want
    assert latest_recorded(spark, path, "nobody").count() == 0 and snapshot_offsets(spark, path, "nobody") is None


def test_a_half_written_snapshot_is_not_used(spark, scratch):
    path = scratch("offsets")
    whole = ev.hourly_offset_log(ev.events_log(spark, SF_SMALL))
    write_offset_log(whole, path)
    last = snapshot_offsets(spark, path, ev.APPNAME)
    broken = f"{snapshots._snapshots(path, ev.APPNAME)}/batch-{last}/_SUCCESS"
    place = spark._jvm.org.apache.hadoop.fs.Path(broken)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)
    assert "-snapshots/" not in "".join(recent_entries(spark, path, ev.APPNAME).inputFiles())
    assert sorted(map(tuple, latest_recorded(spark, path, ev.APPNAME).collect())) == sorted(map(tuple, latest_offsets(whole, ev.APPNAME).collect()))
