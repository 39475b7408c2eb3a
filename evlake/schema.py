"""Schemas shared by every part of the lake."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a topic reader delivers, whatever the topic is backed by.
TOPIC = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

#: The object-event table: one row per notification record.
EVENTS = T.StructType(
    [
        T.StructField("ingest_time", T.TimestampType(), nullable=False),
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("record_index", T.IntegerType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_source", T.StringType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("object_key", T.StringType()),
        T.StructField("object_size", T.LongType()),
        T.StructField("object_etag", T.StringType()),
        T.StructField("raw_event", T.StringType(), nullable=False),
    ]
)

#: Identifies one row of the table; a second row with the same key is a copy.
ROW_KEY = ["kafka_topic", "kafka_partition", "kafka_offset", "record_index"]

#: What names a stored object.
OBJECT_KEYS = "bucket string, object_key string"

#: Name of the partition column derived from ``ingest_time``.
DAY = "ingest_time_day"


def utc_day(ts: Column) -> Column:
    """The UTC calendar day of a timestamp, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int"))
