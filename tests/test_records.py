"""The feed as records: keys that a replay repeats, and reading without the repeats."""

import datetime as dt
import json

from pyspark.sql import functions as F

from siftline.operators.classify import classify, profane_only
from siftline.schema import MESSAGE_FIELDS
from siftline.sinks.batches import as_stream
from siftline.sinks.records import RecordFiles, header, records, without_repeats
from siftline.sources.local import messages

AT = dt.datetime(2025, 6, 1, 12)


def _batch(spark, ids, batch_id=0, placed=True):
    rows = messages(spark, [{"message_id": str(i), "message_body": "a gun"} for i in ids])
    rows = rows.withColumn("ingest_ts", F.lit(AT + dt.timedelta(hours=batch_id)).cast("timestamp"))
    if placed:
        rows = rows.withColumn("source_partition", F.lit(0)).withColumn("offset", F.col("message_id").cast("long"))
    return profane_only(classify(rows, ["gun"]))


def _read(spark, feed, root, remembered="1 day"):
    query = (
        without_repeats(feed.read_stream(spark), remembered)
        .writeStream.option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/read").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    values = spark.read.schema("value string, sent timestamp").parquet(f"{root}/read").collect()
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    return sorted(int(json.loads(r.value)["message_id"]) for r in values), kept[-1] if kept else 0


def test_values_are_unchanged_and_keys_are_those_of_the_place(spark):
    with as_stream(spark, "q"):
        rows = records(_batch(spark, [7]), 3).select("value", *(header(h).alias(h) for h in ("query", "batch", "row", "sent", "none"))).collect()
    assert list(json.loads(rows[0].value)) == list(MESSAGE_FIELDS)
    assert (rows[0].query, rows[0].batch, rows[0].row, rows[0].none) == ("q", "3", "0-7", None)
    assert int(rows[0].sent) == int(AT.replace(tzinfo=dt.UTC).timestamp()) * 1_000_000


def test_a_replayed_batch_leaves_the_read_feed_unchanged(spark, tmp_path):
    feed = RecordFiles(f"{tmp_path}/records")
    with as_stream(spark, "q"):
        feed(_batch(spark, range(10)), 0)
        assert _read(spark, feed, tmp_path)[0] == list(range(10))
        for batch_id, ids in ((0, range(10)), (1, range(10, 15)), (0, range(10)), (1, range(10, 15))):
            feed(_batch(spark, ids, batch_id), batch_id)
        assert _read(spark, feed, tmp_path)[0] == list(range(15))
    assert feed.read(spark).count() == 40 and without_repeats(feed.read(spark)).count() == 15


def test_what_is_remembered_is_bounded(spark, tmp_path):
    feed = RecordFiles(f"{tmp_path}/records")
    sizes = []
    with as_stream(spark, "q"):
        for batch_id in range(6):
            feed(_batch(spark, range(batch_id * 100, batch_id * 100 + 100), batch_id), batch_id)
            ids, kept = _read(spark, feed, tmp_path, "90 minutes")
            sizes.append(kept)
    assert ids == list(range(600)) and max(sizes) <= 300


def test_two_queries_do_not_hide_each_other(spark, tmp_path):
    feed = RecordFiles(f"{tmp_path}/records")
    for name in ("q1", "q2"):
        with as_stream(spark, name):
            feed(_batch(spark, range(3)), 0)
    assert _read(spark, feed, tmp_path)[0] == [0, 0, 1, 1, 2, 2]


def test_records_without_a_key_are_all_kept(spark, tmp_path):
    feed = RecordFiles(f"{tmp_path}/records")
    feed(_batch(spark, [1, 1], placed=False), 0)
    feed(_batch(spark, [2]).withColumn("offset", F.lit(None).cast("long")), 0)
    assert without_repeats(feed.read(spark)).count() == 3
    assert _read(spark, feed, tmp_path)[0] == [1, 1, 2]
