"""Kafka / Avro options, and the keyed publish sink."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.codec import MissingConnectorError, avro_schema_of, decode_payload, encode_payload
from ledgerline.plans.publish import publish
from ledgerline.schemas import EVENT_RECORD
from ledgerline.sinks.tables import publish_log
from ledgerline.sources.log import (
    OffsetRange,
    is_missing_source,
    kafka_assign_json,
    kafka_offsets_json,
    read_kafka_range,
    read_kafka_stream,
)

from tests.support import SF_SMALL


def test_kafka_offset_specs():
    ranges = [OffsetRange("t", 0, 120, 180), OffsetRange("t", 1, None, None)]
    assert json.loads(kafka_offsets_json(ranges, "start")) == {"t": {"0": 120, "1": -2}}
    assert json.loads(kafka_offsets_json(ranges, "end")) == {"t": {"0": 180, "1": -1}}
    assert json.loads(kafka_assign_json(ranges + [OffsetRange("u", 3, 0, 1)])) == {"t": [0, 1], "u": [3]}


def test_missing_kafka_package_is_a_clear_error(spark):
    with pytest.raises(MissingConnectorError):
        read_kafka_range(spark, "localhost:1", [OffsetRange("t", 0, 0, 5)])
    with pytest.raises(MissingConnectorError):
        read_kafka_stream(spark, "localhost:1", "t")


def test_missing_avro_package_is_a_clear_error(spark):
    df = spark.createDataFrame([(1, 2, 3, "a", 1.0, "p")], EVENT_RECORD)
    with pytest.raises(MissingConnectorError):
        encode_payload(df, df.columns, fmt="avro")
    with pytest.raises(MissingConnectorError):
        decode_payload(df.select(F.lit(b"x").alias("value")), EVENT_RECORD, fmt="avro",
                       avro_schema='{"type": "record", "name": "r", "fields": []}')


def test_publish_to_a_parquet_log(spark, scratch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    msgs = publish(docs, "text", ["the"], "doc_id", "source", 4, "documents", ["doc_id", "text"])
    path = scratch("published")
    publish_log(msgs, path)
    back = spark.read.parquet(path)
    assert back.count() == msgs.count() > 0
    assert {r["partition"] for r in back.select("partition").distinct().collect()} <= {0, 1, 2, 3}
    # every message of one source lands in one partition
    per_source = msgs.join(docs.select(F.col("doc_id").cast("string").cast("binary").alias("key"), "source"), "key")
    assert per_source.groupBy("source").agg(F.countDistinct("partition").alias("n")).filter("n > 1").count() == 0
    # the published text is printable ASCII only
    texts = decode_payload(back, docs.select("doc_id", "text").schema).select("text").collect()
    assert all(all(c in "\t\n\r\x0b\x0c" or " " <= c <= "~" for c in r[0]) for r in texts)


@pytest.mark.parametrize("most", [1_000_000, 1])
def test_append_log_continues_offsets(spark, scratch, monkeypatch, most):
    import ledgerline.sinks.tables as tables
    from ledgerline.sinks.tables import append_log

    monkeypatch.setattr(tables, "BROADCAST_BOUNDS", most)  # 1: the shuffled join
    from ledgerline.sources.log import read_log

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    msgs = publish(docs, "text", ["the"], "doc_id", "source", 4, "documents", ["doc_id", "text"]).join(
        docs.select(F.col("doc_id").cast("string").cast("binary").alias("key"), "doc_id"), "key")
    path = scratch("doclog")
    first, second = msgs.filter("doc_id % 2 = 0"), msgs.filter("doc_id % 2 = 1")
    append_log(spark, path, first, "doc_id")
    append_log(spark, path, second, "doc_id")
    log = read_log(spark, path)
    assert log.count() == msgs.count()
    stats = log.groupBy("partition").agg(F.count("*").alias("n"), F.min("offset").alias("lo"),
                                        F.max("offset").alias("hi"), F.countDistinct("offset").alias("d")).collect()
    assert all(r["lo"] == 0 and r["hi"] == r["n"] - 1 and r["d"] == r["n"] for r in stats)
    # the second append numbers after the first, per partition
    firsts = first.groupBy("partition").count().collect()
    for r in firsts:
        later = log.join(second.select("key"), "key").filter(F.col("partition") == r["partition"])
        if later.count():
            assert later.agg(F.min("offset")).first()[0] == r["count"]


def test_avro_reaches_the_connector_in_every_pipeline(spark, scratch):
    """Without the spark-avro package each pipeline names it; none stops earlier."""
    from ledgerline.plans import events as ev
    from ledgerline.plans.replay import replay_offsets, replay_time
    from ledgerline.sources.log import log_from_table, read_log_stream
    from ledgerline.streaming.ingest import batch_writer, start_ingest

    log = ev.events_log(spark, SF_SMALL)
    path = scratch("log")
    log.write.parquet(path)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bounds = [OffsetRange("events", 0, 0, 5)]
    schema = avro_schema_of(EVENT_RECORD)
    assert [f["name"] for f in json.loads(schema)["fields"]] == EVENT_RECORD.fieldNames()
    calls = [
        lambda **k: replay_offsets(log, bounds, EVENT_RECORD, "ts_ms", **k),
        lambda **k: replay_time(log, ev.hourly_offset_log(log), ev.APPNAME, 0, 1 << 40, EVENT_RECORD, "ts_ms", **k),
        lambda **k: start_ingest(read_log_stream(spark, path), scratch("t"), scratch("o"), scratch("c"), EVENT_RECORD, "ts_ms", "app", **k),
        lambda **k: batch_writer(EVENT_RECORD, "ts_ms", scratch("t"), scratch("o"), "app", **k)(log.limit(5), 0),
        lambda **k: publish(docs, "text", ["the"], "doc_id", "source", 4, "documents", ["doc_id", "text"], **k),
        lambda **k: log_from_table(docs, "d", F.col("doc_id"), F.col("source"), "doc_id", F.current_timestamp(), ["doc_id"], 2, **k),
    ]
    for call in calls:
        for more in ({}, {"avro_schema": schema}):
            with pytest.raises(MissingConnectorError):
                call(fmt="avro", **more)


def test_kafka_errors_pass_through_but_for_the_missing_package(spark):
    docs = spark.createDataFrame([(1, "the", "s")], "doc_id long, text string, source string")
    msgs = publish(docs, "text", ["the"], "doc_id", "source", 4, "t", ["doc_id"])
    with pytest.raises(MissingConnectorError):
        publish_log(msgs, "t", fmt="kafka", bootstrap_servers="localhost:1")
    assert not is_missing_source(RuntimeError("kafka broker not available"), "kafka")
    assert read_kafka_range(spark, "localhost:1", []).count() == 0
    assert read_kafka_range(spark, "localhost:1", [OffsetRange("t", 0, 9, 4)]).count() == 0


def test_published_messages_replay_by_offset(spark, scratch):
    from ledgerline.sources.log import read_log, read_offset_range

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = scratch("published")
    publish_log(publish(docs, "text", ["the"], "doc_id", "source", 2, "d", ["doc_id"], timestamp=F.lit("2024-01-01 00:00:00").cast("timestamp")), path)
    log = read_log(spark, path)
    assert log.filter("offset IS NULL OR timestamp IS NULL").count() == 0
    assert read_offset_range(log, [OffsetRange("d", 0, 2, 5), OffsetRange("d", 1, 0, 1)]).count() == 4
