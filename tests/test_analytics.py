"""The moderation queries on small hand-made tables, and the plans they get."""

import datetime as dt
import random

from pyspark.sql import functions as F

from siftline.operators import analytics, late

T0 = dt.datetime(2025, 1, 1)


def _rows(spark, rows):
    return spark.createDataFrame(
        rows, "account_id string, message_id string, profanity_type string, event_time timestamp_ntz"
    )


def _small(spark):
    return _rows(
        spark,
        [
            ("a", "1", "PROFANITY", T0 + dt.timedelta(hours=1)),
            ("a", "2", "SAFE", T0 + dt.timedelta(hours=1, minutes=59)),
            ("b", "3", "PROFANITY", T0 + dt.timedelta(hours=25)),
            ("b", "4", "SAFE", T0 + dt.timedelta(hours=26)),
            ("c", "5", "SAFE", T0 + dt.timedelta(hours=48)),
            ("c", "5", "SAFE", T0 + dt.timedelta(hours=49)),
        ],
    )


def _list(df):
    return [tuple(r) for r in df.collect()]


def test_counts(spark):
    rows = _small(spark)
    assert _list(analytics.count_all(rows)) == [(6,)]
    assert sorted(_list(analytics.count_by_type(rows))) == [("PROFANITY", 2), ("SAFE", 4)]


def test_share_rounds_ties_to_even(spark):
    rows = spark.range(800).select(
        F.when(F.col("id") == 0, "PROFANITY").otherwise("SAFE").alias("profanity_type")
    )
    assert sorted(_list(analytics.type_share(rows))) == [("PROFANITY", 1, 0.12), ("SAFE", 799, 99.88)]


def test_time_queries(spark):
    rows, now = _small(spark), F.lit("2025-01-03T01:00:00").cast("timestamp_ntz")
    # The bound itself is excluded.
    assert sorted(r.message_id for r in analytics.recent(rows, now).collect()) == ["4", "5", "5"]
    assert _list(analytics.messages_per_hour(rows, now)) == [
        (T0 + dt.timedelta(hours=26), 1),
        (T0 + dt.timedelta(hours=48), 1),
        (T0 + dt.timedelta(hours=49), 1),
    ]
    assert _list(analytics.daily_trend(rows)) == [
        (dt.date(2025, 1, 1), 1, 1),
        (dt.date(2025, 1, 2), 1, 1),
        (dt.date(2025, 1, 3), 0, 2),
    ]


def test_account_queries(spark):
    rows = _small(spark)
    assert _list(analytics.top_profane_accounts(rows)) == [("a", 1), ("b", 1)]
    assert _list(analytics.top_profane_accounts(rows, 1)) == [("a", 1)]
    assert _list(analytics.account_hour_heatmap(rows)) == [
        ("a", 1, 2), ("b", 1, 1), ("b", 2, 1), ("c", 0, 1), ("c", 1, 1),
    ]
    assert _list(analytics.duplicate_keys(rows)) == [("c", "5", 2)]
    assert [r.message_id for r in analytics.latest_messages(rows, 3).collect()] == ["5", "5", "4"]


def test_latest_messages_with_ties_and_few_rows(spark):
    rng = random.Random(3)
    rows = [
        (f"a{rng.randrange(4)}", f"{n:03}", "SAFE", T0 + dt.timedelta(minutes=rng.randrange(12)))
        for n in range(60)
    ]
    ordered = sorted(rows, key=lambda r: (-r[3].timestamp(), r[0], r[1]))
    for n in (1, 7, 59, 60, 100):
        assert _list(analytics.latest_messages(_rows(spark, rows), n)) == ordered[:n]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, tmp_path):
    _small(spark).write.parquet(f"{tmp_path}/t")
    rows, now = spark.read.parquet(f"{tmp_path}/t"), F.lit("2025-01-03T01:00:00").cast("timestamp_ntz")
    latest = _plan(analytics.latest_messages(rows))
    assert "TakeOrderedAndProject" in latest and "GreaterThanOrEqual(event_time,Scalar" in latest
    assert "TakeOrderedAndProject" in _plan(analytics.top_profane_accounts(rows))
    hourly = _plan(analytics.messages_per_hour(rows, now))
    assert "GreaterThan(event_time" in hourly and "ReadSchema: struct<event_time:timestamp_ntz>" in hourly
    assert "EqualTo(profanity_type,PROFANITY)" in _plan(analytics.top_profane_accounts(rows))
    for query in (analytics.count_by_type, analytics.duplicate_keys, analytics.account_hour_heatmap):
        assert "partial_count" in _plan(query(rows))


def test_late_rows_match_a_plain_loop_for_any_chunking(spark):
    rng = random.Random(7)
    # Source 0 holds most of the rows.
    arrived = [
        (0 if rng.random() < 0.8 else 1 + n % 2, n, T0 + dt.timedelta(seconds=n + rng.choice([0, -5, -10, -11, -90])))
        for n in range(500)
    ]
    newest, expected = {}, {}
    for source, offset, at in arrived:
        newest[source] = max(newest.get(source, at), at)
        mark = newest[source] - dt.timedelta(seconds=10)
        expected[(source, offset)] = (mark, at < mark)
    rng.shuffle(arrived)
    df = spark.createDataFrame(arrived, "source_partition int, offset bigint, event_ts timestamp_ntz")
    for chunk_rows in (1, 7, 100, 10_000):
        marked = late.mark_late(df.repartition(5), chunk_rows=chunk_rows)
        got = {(r.source_partition, r.offset): (r.watermark, r.is_late) for r in marked.collect()}
        assert got == expected
    assert 0 < sum(flag for _, flag in expected.values()) < 500
