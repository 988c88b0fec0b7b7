"""The original record shape end to end: status records through log, replay, chain and table."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.plans.replay import replay_offsets
from ledgerline.schemas import STATUS
from ledgerline.sinks.tables import create_table, table_columns
from ledgerline.sources.log import OffsetRange, log_from_table, ntz_as_utc_instant

FIELDS = [f.name for f in STATUS.fields] + ["mon", "day", "hour"]


def _step(**changed):
    """A SELECT list over all record fields, some of them changed."""
    return "SELECT " + ", ".join(f"{changed[c]} AS {c}" if c in changed else c for c in FIELDS)


STEPS = {"s1": _step(text="ucase(text)"), "s2": _step(screen_name="ucase(screen_name)")}

ROWS = [
    (1, "u1", 1484934490444, 822222222222222222, 10, 20, 30, "spark | python\nrocks", "alice"),
    (2, "u2", 1484938090444, 822222222222222223, 11, 21, 31, "Straße", "bob"),
    (3, "u1", 1484941690444, 822222222222222224, 12, 22, 32, None, "alice"),
]


def test_status_records_end_to_end(spark, scratch):
    status = spark.createDataFrame(ROWS, STATUS).withColumn(
        "ts", F.timestamp_millis("tweet_ts").cast("timestamp_ntz"))
    log = log_from_table(status, topic="statuses", key=F.col("tweet_id"), route=F.col("screen_name"),
                         order_col="tweet_id", timestamp=ntz_as_utc_instant("ts"),
                         payload_cols=[f.name for f in STATUS.fields], n_partitions=1)
    assert [r["offset"] for r in log.orderBy("offset").collect()] == [0, 1, 2]
    table_schema = T.StructType([*STATUS.fields, *[T.StructField(c, T.IntegerType()) for c in ("mon", "day", "hour")]])
    create_table(spark, "status_records_t1", table_schema, path=scratch("status"), partition_cols=["mon", "day", "hour"])
    cols = table_columns(spark, "status_records_t1").collect()
    assert [c["name"] for c in cols][-3:] == ["mon", "day", "hour"] and cols[-1]["is_partition"]
    out = replay_offsets(log, [OffsetRange("statuses", 0, 0, 3)], STATUS, "tweet_ts", STEPS,
                         table="status_records_t1")
    got = {r["kid"]: r for r in spark.table("status_records_t1").collect()}
    assert out.count() == 3 and len(got) == 3
    assert got[1]["text"] == "SPARK | PYTHON\nROCKS" and got[1]["screen_name"] == "ALICE"
    assert got[2]["text"] == "STRASSE"  # Spark's upper maps the sharp s to SS
    assert got[3]["text"] is None
    assert got[1]["tweet_id"] == 822222222222222222  # a long, not an int
    assert (got[1]["mon"], got[1]["day"], got[1]["hour"]) == (1, 20, 17)  # 2017-01-20 17:48 UTC
