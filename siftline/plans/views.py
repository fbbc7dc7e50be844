"""The test tables in message shape.

No test table has every message field, so each view derives the missing ones by
a rule that SQL can repeat. Some rules plant the irregular input the operators
exist for: bad timestamps, undecodable JSON, second versions, late arrivals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.functions.instants import parse_instant, wall_clock
from siftline.operators.classify import classify
from siftline.schema import MESSAGE_FIELDS, OLAP_FIELDS

# Instants are spread from here on; INGEST stands in for the current time.
START = "2024-01-01T00:00:00Z"
INGEST = "2024-02-01T00:00:00Z"
EVENT_WORDS = ["error"]
START_SECONDS = 1_704_067_200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ingest_ts() -> Column:
    return F.lit(INGEST).cast("timestamp")


def _iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _message(rows: DataFrame, *extra: str, **fields: Column) -> DataFrame:
    fields.setdefault("profanity_type", F.lit(None))
    return rows.select(*extra, *(fields[name].cast("string").alias(name) for name in MESSAGE_FIELDS))


def document_messages(documents: DataFrame) -> DataFrame:
    """One message per document, seven minutes apart."""
    return _message(
        documents,
        account_id=F.col("source"),
        message_id=F.col("doc_id"),
        message_body=F.col("text"),
        correlation_id=F.concat(F.lit("doc-"), "doc_id"),
        message_status=F.col("lang"),
        timestamp=_iso(F.lit(START_SECONDS) + F.col("doc_id") * 420),
    )


def conversation_messages(conversations: DataFrame, *extra: str) -> DataFrame:
    """One message per turn, a minute apart, an hour per conversation."""
    return _message(
        conversations,
        *extra,
        account_id=F.col("conv_id"),
        message_id=F.concat_ws("-", "conv_id", "turn"),
        message_body=F.col("text"),
        correlation_id=F.lit(None),
        message_status=F.col("role"),
        timestamp=_iso(F.lit(START_SECONDS) + (F.col("conv_id") * 60 + F.col("turn")) * 60),
    )


def event_messages(events: DataFrame, *extra: str) -> DataFrame:
    """One message per event, its own microsecond time."""
    return _message(
        events,
        *extra,
        account_id=F.col("user_id"),
        message_id=F.col("event_id"),
        message_body=F.concat_ws(" ", "event_type", "props"),
        correlation_id=F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("e-"), "event_id")),
        message_status=F.col("event_type"),
        timestamp=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
    )


def irregular_event_messages(events: DataFrame) -> DataFrame:
    """Event messages, some with a missing, malformed or unusual timestamp."""
    key = F.col("event_id")
    stamp = (
        F.when(key % 17 == 0, F.lit(None))
        .when(key % 19 == 0, F.lit(""))
        .when(key % 23 == 0, F.lit("some day soon"))
        .when(key % 29 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(key % 31 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
        .when(key % 37 == 0, F.lit("2024-02-30T10:00:00Z"))
        .when(key % 41 == 0, F.date_format("ts", "yyyy-MM-dd't'HH:mm:ss.SSSSSS'999z'"))
        .when(key % 43 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'"))
        .otherwise(F.col("timestamp"))
    )
    return event_messages(events, "event_id", "ts").withColumn("timestamp", stamp).drop("event_id", "ts")


def positioned_event_messages(events: DataFrame) -> DataFrame:
    """Event messages from three partitions of a source."""
    return event_messages(events, "event_id").select(
        *MESSAGE_FIELDS, (F.col("event_id") % 3).cast("int").alias("source_partition"), F.col("event_id").alias("offset")
    )


def conversation_values(conversations: DataFrame) -> DataFrame:
    """Turns as JSON values with their arrival position, some of them undecodable.

    Decodable ones include extra fields and numbers of every form in a string field.
    """
    key = F.col("conv_id") * 7 + F.col("turn")
    fields = [F.col(f) for f in MESSAGE_FIELDS if f not in ("account_id", "profanity_type")]
    rest = F.substring(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 2, 2_000_000_000)
    head = F.lit('{"account_id":')
    quoted = F.concat(F.lit('"'), "account_id", F.lit('",'))
    number = (
        F.when(key % 4 == 1, F.concat("account_id", F.lit(".50")))
        .when(key % 4 == 2, F.concat("account_id", F.lit("e5")))
        .when(key % 4 == 3, F.concat(F.lit("123456789012345678901234567890123456789"), "account_id", F.lit(".10")))
        .otherwise(F.col("account_id"))
    )
    value = (
        F.when(key % 13 == 0, F.concat(F.lit("not json "), "message_id"))
        .when(key % 17 == 0, F.lit(""))
        .when(key % 19 == 0, F.lit("null"))
        .when(key % 23 == 0, F.concat(F.lit("[1,"), "account_id", F.lit("]")))
        .when(key % 29 == 0, F.concat(head, F.lit('{"id":'), "account_id", F.lit("},"), rest))
        .when(key % 31 == 0, F.concat(head, quoted, F.lit('"profanity_type":"RUDE",'), rest))
        .when(key % 37 == 0, F.concat(F.lit('{"a":'), head, F.lit("2.750},"), F.lit('"account_id":1.50,'), rest))
        .when(key % 5 == 0, F.concat(head, number, F.lit(","), rest))
        .when(key % 3 == 0, F.concat(head, quoted, F.lit('"extra":{"a":[1]},"profanity_type":"SAFE",'), rest))
        .otherwise(F.concat(head, quoted, rest))
    )
    shaped = conversation_messages(conversations, "conv_id", "turn")
    return shaped.select(
        (F.col("conv_id") % 3).cast("int").alias("source_partition"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("offset"),
        value.alias("value"),
    )


def document_values(documents: DataFrame) -> DataFrame:
    """Documents as JSON values; some with a bad or missing timestamp, some cut off."""
    key = F.col("message_id").cast("long")
    stamp = (
        F.when(key % 13 == 0, F.lit("not a time"))
        .when(key % 17 == 0, F.lit(""))
        .otherwise(F.col("timestamp"))
    )
    messages = document_messages(documents).withColumn("timestamp", stamp)
    cut = F.substring("value", 1, 20)
    values = messages.select("*", F.to_json(F.struct(*MESSAGE_FIELDS)).alias("value"))
    return values.select(F.when(key % 19 == 0, cut).otherwise(F.col("value")).alias("value"))


def event_table(events: DataFrame, *extra: str) -> DataFrame:
    """Events as a stored analytics table: classified, with a native ``event_time``."""
    stored = event_messages(events, "ts", *extra).withColumnRenamed("ts", "event_time")
    classified = classify(stored.fillna("", ["correlation_id"]), EVENT_WORDS)
    return classified.select(*OLAP_FIELDS, *extra)


def event_versions(events: DataFrame) -> DataFrame:
    """Stored analytics rows: every event once and some of them again.

    A third of the keys has a second version a minute later, some of those a
    third in the same second from a later batch, and some keys come back a month
    later. One scan makes all of them.
    """
    key = F.col("event_id")
    versions = F.array_compact(
        F.array(
            F.lit(0),
            F.when(key % 3 == 0, F.lit(1)),
            F.when(key % 15 == 0, F.lit(2)),
            F.when(key % 21 == 0, F.lit(3)),
        )
    )
    at = wall_clock(ingest_ts())
    version = F.col("version")
    numbered = event_table(events, "event_id").withColumn("version", F.explode(versions))
    return numbered.select(
        "account_id",
        "message_id",
        F.when(version == 0, F.col("message_body"))
        .otherwise(F.concat_ws(" v", "message_body", version))
        .alias("message_body"),
        "correlation_id",
        "message_status",
        F.when(version == 3, F.col("event_time") + F.expr("INTERVAL 31 DAYS"))
        .otherwise(F.col("event_time"))
        .alias("event_time"),
        "profanity_type",
        F.when(version == 0, at).otherwise(at + F.expr("INTERVAL 60 SECONDS")).alias("inserted_at"),
        version.cast("long").alias("batch_id"),
    )


def event_arrivals(events: DataFrame) -> DataFrame:
    """Events in arrival order of three sources, some out of time order, some of unknown source or place."""
    key = F.col("event_id")
    shift = (
        F.when(key % 7 == 0, F.expr("INTERVAL 45 MINUTES"))
        .when(key % 5 == 0, F.expr("INTERVAL 5 SECONDS"))
        .otherwise(F.expr("INTERVAL 0 SECONDS"))
    )
    return events.select(
        F.when(key % 101 != 0, F.col("user_id") % 3).alias("source_partition"),
        F.when(key % 103 != 0, key).alias("offset"),
        (F.col("ts") - shift).alias("event_ts"),
    )


def skewed_event_messages(events: DataFrame) -> DataFrame:
    """Event messages of three sources in arrival order; the clock of one is two hours behind."""
    source = F.col("user_id") % 3
    behind = F.when(source == 1, F.expr("INTERVAL 2 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
    jitter = F.when(F.col("event_id") % 5 == 0, F.expr("INTERVAL 5 SECONDS")).otherwise(F.expr("INTERVAL 0 SECONDS"))
    shifted = events.withColumn("ts", F.col("ts") - behind - jitter)
    return event_messages(shifted, "event_id", "user_id").select(
        *MESSAGE_FIELDS, source.alias("source_partition"), F.col("event_id").alias("offset")
    )


def word_lines(documents: DataFrame) -> DataFrame:
    """Every line of the documents, untrimmed, as the lines of a word list."""
    return documents.select(F.explode(F.split("text", "\n")).alias("value"))


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    """A large lexicon: the long words of the benchmark passages."""
    return (
        benchmark.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word"))
        .where(F.length("word") >= 10)
        .distinct()
    )


def rough_words(benchmark: DataFrame) -> DataFrame:
    """A word list as people write it: mixed case, blanks around, one letter, long passages with one beginning."""
    long = F.substring("text", 1, 90)
    shapes = F.array(
        F.concat(F.lit("  "), F.upper(F.substring("text", 1, 12)), F.lit("\t")),
        F.initcap(F.substring("text", 20, 7)),
        F.concat(long, F.lit(" not there")),
        F.when(F.col("item_id") % 3 == 0, long),
        F.when(F.col("item_id") % 3 == 1, F.substring("text", 1, 70)),
        F.when(F.col("item_id") % 5 == 0, F.lit("")),
        F.when(F.col("item_id") % 7 == 0, F.lit(" ñ ")),
        F.lit(None),
    )
    return benchmark.select(F.explode(shapes).alias("word"))


def parsed_instants(messages: DataFrame) -> DataFrame:
    return messages.select(
        "message_id", "timestamp", wall_clock(parse_instant(F.col("timestamp"))).alias("instant")
    )
