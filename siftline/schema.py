"""Schemas and fixed names shared by sources, operators and sinks."""

from pyspark.sql import types as T

# Tags and status as consumers of the tables know them.
PROFANITY = "PROFANITY"
SAFE = "SAFE"
ERROR_STATUS = "ERROR"

# The message fields in wire order.
MESSAGE_FIELDS = (
    "account_id",
    "message_id",
    "message_body",
    "correlation_id",
    "message_status",
    "timestamp",
    "profanity_type",
)

MESSAGE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in MESSAGE_FIELDS])

# Lake rows: the message fields with ``timestamp`` as a UTC wall clock.
LAKE_SCHEMA = T.StructType(
    [
        T.StructField(name, T.TimestampNTZType() if name == "timestamp" else T.StringType())
        for name in MESSAGE_FIELDS
    ]
)
LAKE_DAY = "timestamp_day"

# Where a source brings it, the place of a row in its source.
POSITION_SCHEMA = T.StructType([T.StructField("source_partition", T.IntegerType()), T.StructField("offset", T.LongType())])
POSITION = tuple(POSITION_SCHEMA.fieldNames())

# Analytics rows: ``timestamp`` becomes ``event_time``.
OLAP_FIELDS = tuple("event_time" if name == "timestamp" else name for name in MESSAGE_FIELDS)
OLAP_SCHEMA = T.StructType(
    [
        T.StructField(name, T.TimestampNTZType() if name == "event_time" else T.StringType())
        for name in OLAP_FIELDS
    ]
)
OLAP_MONTH = "event_month"
OLAP_KEY = ("account_id", "message_id")

# What the analytics table stores on top of its visible columns.
OLAP_STORED_SCHEMA = T.StructType(
    [
        *OLAP_SCHEMA.fields,
        T.StructField("inserted_at", T.TimestampNTZType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Table and topic names.
PROFANE_TABLE = "profanity_messages"
SAFE_TABLE = "safe_messages"
OLAP_TABLE = "message_events"
INPUT_TOPIC = "profanity_words"
FEED_TOPIC = "output-topic"
CONSUMER_GROUP = "flink-test"
