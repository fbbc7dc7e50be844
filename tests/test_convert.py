"""Row conversion, cell by cell."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siftline.functions.instants import month_number, parse_instant, wall_clock
from siftline.functions.sizes import readable_size
from siftline.operators import convert
from siftline.sources.local import messages

NOW = dt.datetime(2025, 6, 1, 12, 0, 0, 123456)
FULL = {
    "account_id": "u-8",
    "message_id": "5521",
    "message_body": "the ferry leaves at noon",
    "correlation_id": "trip/3",
    "message_status": "queued",
    "timestamp": "2025-01-01T10:00:00Z",
    "profanity_type": "PROFANITY",
}
STRINGS = ["account_id", "message_id", "message_body", "correlation_id", "message_status"]
INSTANT = dt.datetime(2025, 1, 1, 10)


def _now():
    return F.lit("2025-06-01T12:00:00.123456Z").cast("timestamp")


def _lake(spark, **changes):
    return convert.lake_rows(messages(spark, [{**FULL, **changes}]), _now()).first().asDict()


def _olap(spark, **changes):
    return convert.olap_rows(messages(spark, [{**FULL, **changes}]), _now()).first().asDict()


def _event_time(spark, timestamp):
    row = messages(spark, [{"timestamp": timestamp}]).select(
        wall_clock(convert.event_time(F.col("timestamp"), _now())).alias("t")
    )
    return row.first().t


def test_all_fields_are_copied(spark):
    assert _lake(spark) == {**FULL, "timestamp": INSTANT}
    expected = {k: v for k, v in FULL.items() if k != "timestamp"}
    assert _olap(spark) == {**expected, "event_time": INSTANT}


@pytest.mark.parametrize("field", STRINGS)
def test_null_string_becomes_empty(spark, field):
    assert _lake(spark, **{field: None})[field] == ""
    assert _olap(spark, **{field: None})[field] == ""


def test_null_type_becomes_safe(spark):
    assert _lake(spark, profanity_type=None)["profanity_type"] == "SAFE"
    assert _olap(spark, profanity_type=None)["profanity_type"] == "SAFE"


def test_null_timestamp_is_the_ingest_time(spark):
    assert _lake(spark, timestamp=None) == {**FULL, "timestamp": NOW}
    assert _olap(spark, timestamp=None)["event_time"] == NOW.replace(microsecond=123000)
    assert _event_time(spark, None) == NOW


BAD = ["", "half past ten", "2025-01-01", "2025-01-01T10:00:00", "2025-01-01T10:00:00+02:00",
       "2025-01-01T10:00Z", "2025-02-30T10:00:00Z", "2025-13-01T10:00:00Z", " 2025-01-01T10:00:00Z",
       "2025-01-01 10:00:00Z", "+2025-01-01T10:00:00Z", "12025-01-01T10:00:00Z", "2025-01-01T25:00:00Z",
       "2025-01-01T24:00:01Z", "2025-01-01T24:00:00.5Z", "2025-02-30T24:00:00Z", "2025-01-01T22:59:60Z"]


@pytest.mark.parametrize("timestamp", BAD)
def test_bad_timestamp_has_three_answers(spark, timestamp):
    blank = dict.fromkeys(STRINGS, "")
    assert _lake(spark, timestamp=timestamp) == {
        **blank,
        "message_status": "ERROR",
        "timestamp": NOW,
        "profanity_type": "SAFE",
    }
    kept = {k: v for k, v in FULL.items() if k != "timestamp"}
    assert _olap(spark, timestamp=timestamp) == {
        **kept,
        "event_time": NOW.replace(microsecond=123000),
    }
    assert _event_time(spark, timestamp) == NOW


GOOD = {
    "2023-03-09T05:07:11.042Z": dt.datetime(2023, 3, 9, 5, 7, 11, 42000),
    "2025-12-25T15:30:45.123456789Z": dt.datetime(2025, 12, 25, 15, 30, 45, 123456),
    "2025-12-25t15:30:45z": dt.datetime(2025, 12, 25, 15, 30, 45),
    "2025-12-25T15:30:45.Z": dt.datetime(2025, 12, 25, 15, 30, 45),
    "1969-12-31T23:59:59.999Z": dt.datetime(1969, 12, 31, 23, 59, 59, 999000),
    "2024-12-31T24:00:00Z": dt.datetime(2025, 1, 1),
    "2024-02-28T24:00:00.000Z": dt.datetime(2024, 2, 29),
    "2016-12-31T23:59:60Z": dt.datetime(2016, 12, 31, 23, 59, 59),
    "2016-12-31T23:59:60.5Z": dt.datetime(2016, 12, 31, 23, 59, 59, 500000),
    "2024-02-29T00:00:00Z": dt.datetime(2024, 2, 29),
}


@pytest.mark.parametrize("timestamp", GOOD)
def test_instants(spark, timestamp):
    instant = GOOD[timestamp]
    assert _lake(spark, timestamp=timestamp)["timestamp"] == instant
    millis = instant.replace(microsecond=instant.microsecond // 1000 * 1000)
    assert _olap(spark, timestamp=timestamp)["event_time"] == millis
    assert _event_time(spark, timestamp) == instant


@pytest.mark.parametrize(
    "body",
    [
        "Ελληνικά, 한국어, 🦊 and naïve",
        "<a href='x'>\\ % _ \" ` ~</a>",
        "one line after another; " * 1200,
        "\t",
        " blank before",
        "blank after  ",
    ],
)
def test_text_is_kept_as_it_is(spark, body):
    assert _lake(spark, message_body=body)["message_body"] == body
    assert _olap(spark, message_body=body)["message_body"] == body


def test_calendar_buckets(spark):
    row = spark.range(1).select(
        month_number(F.lit("2024-11-30 23:59:59").cast("timestamp_ntz")).alias("m"),
        parse_instant(F.lit(None).cast("string")).alias("none"),
    ).first()
    assert (row.m, row.none) == (202411, None)


def test_readable_size(spark):
    sizes = [0, 1, 1023, 1024, 1536, 5 * 1024**2, 3 * 1024**4, 2**62]
    df = spark.createDataFrame([(n,) for n in sizes], "n bigint").select(readable_size(F.col("n")))
    assert [r[0] for r in df.collect()] == [
        "0.00 B", "1.00 B", "1023.00 B", "1.00 KiB", "1.50 KiB", "5.00 MiB", "3.00 TiB", "4.00 EiB",
    ]
