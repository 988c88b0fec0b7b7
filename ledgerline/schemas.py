"""Fixed record schemas."""

from pyspark.sql import types as T

# Kafka-shaped message log (the columns of Spark's Kafka source).
MESSAGE_LOG = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

# One typed row per (app, topic, partition, batch); end_offset is exclusive.
OFFSET_LOG = T.StructType(
    [
        T.StructField("appname", T.StringType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("batch_ts", T.LongType(), True),
        T.StructField("start_offset", T.LongType(), True),
        T.StructField("end_offset", T.LongType(), True),
    ]
)

# Status record in table column order; tweet_id is a long (the payload's type).
STATUS = T.StructType(
    [
        T.StructField("kid", T.IntegerType(), True),
        T.StructField("id_str", T.StringType(), True),
        T.StructField("tweet_ts", T.LongType(), True),
        T.StructField("tweet_id", T.LongType(), True),
        T.StructField("followers_count", T.IntegerType(), True),
        T.StructField("statuses_count", T.IntegerType(), True),
        T.StructField("friends_count", T.IntegerType(), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("screen_name", T.StringType(), True),
    ]
)

# Payload of the events-backed log used by the tests and the driver queries.
EVENT_RECORD = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts_ms", T.LongType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)

# Time partition columns derived from the record's epoch-millisecond field.
PARTITION_FIELDS = ("mon", "day", "hour")
