"""What the sinks leave on storage, and what a retry or merge does to it."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftline.operators import analytics
from siftline.operators.classify import classify, profane_only
from siftline.operators.dedup import latest_versions
from siftline.schema import LAKE_SCHEMA, MESSAGE_FIELDS, OLAP_FIELDS, PROFANE_TABLE, SAFE_TABLE
from siftline.sinks import batches, copies
from siftline.sinks.feed import FileFeed, TopicFeed
from siftline.sinks.lake import TABLES, LakeSink
from siftline.sinks.layout import HASH, NONE, RANGE, bytes_per_row, distribute, sized, target_file_size
from siftline.sinks.olap import OlapSink
from siftline.sources import tables
from siftline.sources.local import messages


def _batch(spark, rows, at="2025-06-01T12:00:00.5Z"):
    stamped = messages(spark, rows).withColumn("ingest_ts", F.lit(at).cast("timestamp"))
    return classify(stamped, ["gun"])


def _row(n, body="fine", day=1, **changes):
    return {
        "account_id": f"a{n % 3}",
        "message_id": f"m{n}",
        "message_body": body,
        "timestamp": f"2025-01-{day:02}T10:00:00Z",
        **changes,
    }


MIXED = [_row(i, "a gun" if i % 2 else "fine", 1 + i % 3) for i in range(12)]


def _ids(df):
    return sorted(r.message_id for r in df.select("message_id").collect())


def test_lake_routes_and_partitions_by_day(spark, tmp_path):
    lake = LakeSink(str(tmp_path))
    lake(_batch(spark, MIXED), 0)
    for table, kind in ((PROFANE_TABLE, "PROFANITY"), (SAFE_TABLE, "SAFE")):
        rows = lake.read(spark, table)
        assert rows.count() == 6
        assert [r[0] for r in rows.select("profanity_type").distinct().collect()] == [kind]
        days = {p.name for p in (tmp_path / table / "stream_id=direct" / "batch=0").glob("timestamp_day=*")}
        assert days == {"timestamp_day=2025-01-01", "timestamp_day=2025-01-02", "timestamp_day=2025-01-03"}
        assert rows.select(*MESSAGE_FIELDS).schema == LAKE_SCHEMA


def test_profane_row_with_bad_time_lands_blank_in_safe(spark, tmp_path):
    batch = _batch(spark, [_row(1, "a gun", timestamp="yesterday")])
    lake, olap, feed = LakeSink(f"{tmp_path}/l"), OlapSink(f"{tmp_path}/o"), FileFeed(f"{tmp_path}/f")
    for sink in (lake, olap, feed):
        sink(batch, 0)
    assert lake.read(spark, PROFANE_TABLE).count() == 0
    blank = lake.read(spark, SAFE_TABLE).first()
    assert (blank.message_id, blank.message_status, blank.profanity_type) == ("", "ERROR", "SAFE")
    assert olap.read(spark).first().profanity_type == "PROFANITY"
    assert json.loads(feed.read(spark).first().value)["timestamp"] == "yesterday"


def test_lake_range_scan_prunes_days(spark, tmp_path):
    lake = LakeSink(str(tmp_path))
    lake(_batch(spark, MIXED), 0)
    found = analytics.lake_range(lake.read(spark, SAFE_TABLE), dt.datetime(2025, 1, 2, 9))
    assert found.count() == 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "timestamp_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThan(timestamp" in plan


def test_repeated_batch_changes_nothing(spark, tmp_path):
    lake, olap, feed = LakeSink(f"{tmp_path}/l"), OlapSink(f"{tmp_path}/o"), FileFeed(f"{tmp_path}/f")
    with batches.as_stream(spark, "s"):
        for batch_id in (0, 1, 1, 0):
            batch = _batch(spark, [_row(batch_id * 10 + i, "gun" if i else "ok") for i in range(3)])
            feed(profane_only(batch), batch_id)
            lake(batch, batch_id)
            olap(batch, batch_id)
    assert feed.read(spark).count() == 4
    assert lake.read(spark, PROFANE_TABLE).count() == 4
    assert lake.read(spark, SAFE_TABLE).count() == 2
    assert olap.read_all(spark).count() == 6


def test_new_rows_under_a_used_id_are_an_error(spark, tmp_path):
    lake = LakeSink(str(tmp_path))
    lake(_batch(spark, MIXED), 0)
    with pytest.raises(FileExistsError):
        lake(_batch(spark, MIXED), 0)


def test_half_written_batch_is_invisible_and_replaced(spark, tmp_path):
    lake = LakeSink(str(tmp_path))
    lake(_batch(spark, MIXED), 0)
    lake(_batch(spark, MIXED), 1)
    done = tmp_path / SAFE_TABLE / "stream_id=direct" / "batch=1" / "_SUCCESS"
    done.unlink()
    assert lake.read(spark, SAFE_TABLE).count() == 6
    (tmp_path / PROFANE_TABLE / "stream_id=direct" / "batch=1" / "_SUCCESS").unlink()
    lake(_batch(spark, MIXED[:4]), 1)
    assert lake.read(spark, SAFE_TABLE).count() == 8
    assert lake.read(spark, PROFANE_TABLE).count() == 8


def test_empty_tables_read_as_empty(spark, tmp_path):
    lake, olap, feed = LakeSink(f"{tmp_path}/l"), OlapSink(f"{tmp_path}/o"), FileFeed(f"{tmp_path}/f")
    assert lake.read(spark, SAFE_TABLE).count() == olap.read(spark).count() == feed.read(spark).count() == 0
    empty = _batch(spark, [])
    for sink in (lake, olap, feed):
        sink(empty, 0)
    assert lake.read(spark, SAFE_TABLE).count() == olap.read(spark).count() == feed.read(spark).count() == 0


def test_olap_layout(spark, tmp_path):
    olap = OlapSink(str(tmp_path))
    rows = [_row(i, timestamp=f"2025-0{1 + i % 2}-05T00:00:00.123456Z") for i in range(9, -1, -1)]
    olap(_batch(spark, rows), 7)
    folder = tmp_path / "message_events" / "stream_id=direct" / "batch=7"
    assert {p.name for p in folder.glob("event_month=*")} == {"event_month=202501", "event_month=202502"}
    for path in folder.glob("event_month=*/*.parquet"):
        stored = spark.read.parquet(str(path)).collect()
        keys = [(r.account_id, r.message_id) for r in stored]
        assert keys == sorted(keys)
        assert {r.inserted_at for r in stored} == {dt.datetime(2025, 6, 1, 12)}
        assert {r.event_time.microsecond for r in stored} == {123000}
        assert {r.batch_id for r in stored} == {7}
    assert tuple(olap.read(spark).columns) == (*OLAP_FIELDS, "event_month")
    now = F.lit("2025-02-05T01:00:00").cast("timestamp_ntz")
    for found in (analytics.recent(olap.read(spark), now), analytics.recent(olap.read_all(spark), now)):
        assert found.count() == 5
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "(event_month" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_newest_version_wins_inside_a_month(spark, tmp_path):
    olap = OlapSink(str(tmp_path))
    olap(_batch(spark, [_row(1, "old"), _row(2, "only")], "2025-06-01T12:00:00Z"), 0)
    olap(_batch(spark, [_row(1, "new")], "2025-06-01T12:05:00Z"), 1)
    olap(_batch(spark, [_row(1, "same second")], "2025-06-01T12:05:00.9Z"), 2)
    olap(_batch(spark, [_row(1, "moved", timestamp="2025-02-01T00:00:00Z")], "2025-06-01T11:00:00Z"), 3)
    assert sorted(r.message_body for r in olap.read(spark).collect()) == ["moved", "only", "same second"]
    assert olap.read_all(spark).count() == 5
    duplicates = analytics.duplicate_keys(olap.read_all(spark)).collect()
    assert [(r.message_id, r.occurrences) for r in duplicates] == [("m1", 4)]


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark, tmp_path):
    olap = OlapSink(str(tmp_path))
    olap(_batch(spark, MIXED), 0)
    plan = olap.read(spark)._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(event_month")[1]
    assert "WindowGroupLimit" in below and ", Partial" in below


def test_a_table_cut_by_key_is_deduplicated_without_a_shuffle(spark, tmp_path):
    olap = OlapSink(str(tmp_path / "olap"))
    for batch_id in range(3):
        rows = [_row(i, f"v{batch_id}", timestamp=f"2025-0{1 + i % 2}-05T00:00:00Z") for i in range(30)]
        olap(_batch(spark, rows, f"2025-06-01T12:0{batch_id}:00Z"), batch_id)
    name = f"bucketed_{tmp_path.name}"
    stored = tables.store_bucketed(olap.read_all(spark).drop("event_month"), name, f"{tmp_path}/table", 4)
    latest = latest_versions(stored)
    for found in (latest, analytics.duplicate_keys(stored)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    assert sorted(map(tuple, latest.select(*OLAP_FIELDS).collect())) == sorted(map(tuple, olap.read(spark).select(*OLAP_FIELDS).collect()))
    assert analytics.duplicate_keys(stored).count() == 30
    # A bound on the month still prunes, and one file holds a bucket of a month.
    assert len(list(tmp_path.glob("table/event_month=202501/*.parquet"))) <= 4
    spark.sql(f"DROP TABLE {name}")


def test_olap_merge_stores_latest_versions_only(spark, tmp_path):
    olap = OlapSink(str(tmp_path))
    assert olap.merge(spark) == [] and olap.read_merged(spark).count() == 0
    for batch_id in range(3):
        rows = [_row(i, f"v{batch_id}") for i in range(20)]
        olap(_batch(spark, rows, f"2025-06-01T12:0{batch_id}:00Z"), batch_id)
    latest = sorted(map(tuple, olap.read(spark).collect()))
    assert olap.merge(spark) == [202501]
    merged = olap.read_merged(spark)
    assert sorted(map(tuple, merged.select(*OLAP_FIELDS, "event_month").collect())) == latest
    assert analytics.duplicate_keys(merged).count() == 0
    # A batch written after the merge is in the versions at once, and in the merged table after the next.
    olap(_batch(spark, [_row(3, "v9")], "2025-06-01T13:00:00Z"), 3)
    assert (olap.read_all(spark).count(), olap.read_merged(spark).where("message_body = 'v9'").count()) == (61, 0)
    olap.merge(spark)
    merged = olap.read_merged(spark)
    assert (merged.count(), merged.where("message_body = 'v9'").count()) == (20, 1)
    assert sorted({r.batch_id for r in merged.collect()}) == [2, 3]
    for path in Path(olap.merged_path).glob("event_month=*/*.parquet"):
        keys = [(r.account_id, r.message_id) for r in spark.read.parquet(str(path)).collect()]
        assert keys == sorted(keys)


def test_olap_merge_rewrites_only_months_with_new_batches(spark, tmp_path):
    olap = OlapSink(str(tmp_path))
    olap(_batch(spark, [_row(1), _row(2, timestamp="2025-02-03T00:00:00Z")]), 0)
    olap(_batch(spark, [_row(3)]), 1)
    assert olap.merge(spark) == [202501, 202502]
    february = {p.name for p in Path(olap.merged_path).glob("event_month=202502/*.parquet")}
    olap(_batch(spark, [_row(1, "newer")], "2025-06-01T13:00:00Z"), 2)
    assert olap.merge(spark) == [202501]
    assert {p.name for p in Path(olap.merged_path).glob("event_month=202502/*.parquet")} == february
    assert {r.message_id: r.message_body for r in olap.read_merged(spark).collect()} == {"m1": "newer", "m2": "fine", "m3": "fine"}
    assert olap.merge(spark) == []
    assert olap.merge(spark, whole=True) == [202501, 202502]
    assert olap.read_merged(spark).count() == 3


def test_a_merge_that_dies_is_made_up_for(spark, tmp_path):
    olap = OlapSink(str(tmp_path))
    olap(_batch(spark, [_row(1), _row(2, timestamp="2025-02-03T00:00:00Z")]), 0)
    olap.merge(spark)
    # Between removing a month and putting its new files there a driver may be lost.
    for path in Path(olap.merged_path).glob("event_month=202501/*"):
        path.unlink()
    assert olap.read(spark).count() == 2
    assert olap.merge(spark) == [202501]
    assert _ids(olap.read_merged(spark)) == ["m1", "m2"]


def test_two_merges_at_once_lose_and_double_nothing(spark, tmp_path, monkeypatch):
    olap = OlapSink(str(tmp_path))
    for batch_id in range(2):
        olap(_batch(spark, [_row(1, f"v{batch_id}"), _row(2 + batch_id)], f"2025-06-01T12:0{batch_id}:00Z"), batch_id)
    save = batches.save_partitions

    def slow(*args, **options):
        with monkeypatch.context() as patch:
            patch.setattr(batches, "save_partitions", save)
            olap(_batch(spark, [_row(9)], "2025-06-01T13:00:00Z"), 9)
            olap.merge(spark)  # another merge sees more and is done before this one writes
        assert _ids(olap.read_merged(spark)) == ["m1", "m2", "m3", "m9"]
        save(*args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(batches, "save_partitions", slow)
        olap.merge(spark)
    assert _ids(olap.read(spark)) == ["m1", "m2", "m3", "m9"]
    # The slower one wrote the older state; its mark tells, and the next merge mends it.
    assert _ids(olap.read_merged(spark)) == ["m1", "m2", "m3"]
    assert olap.merge(spark) == [202501]
    assert _ids(olap.read_merged(spark)) == ["m1", "m2", "m3", "m9"]


def test_lake_compaction_keeps_every_row(spark, tmp_path):
    lake = LakeSink(str(tmp_path))
    for batch_id in range(4):
        lake(_batch(spark, MIXED), batch_id)
    days = [dt.date(2025, 1, d) for d in (1, 2, 3)]
    assert lake.compact(spark, SAFE_TABLE) == days
    kept = lake.read_compacted(spark, SAFE_TABLE)
    assert kept.schema == lake.read(spark, SAFE_TABLE).schema
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, lake.read(spark, SAFE_TABLE).collect()))
    assert len(list(tmp_path.glob(f"{SAFE_TABLE}_compacted/timestamp_day=*/*.parquet"))) == 3
    lake(_batch(spark, MIXED[:1]), 4)
    assert lake.compact(spark, SAFE_TABLE) == days[:1]
    assert lake.read_compacted(spark, SAFE_TABLE).count() == lake.read(spark, SAFE_TABLE).count() == 25


def test_a_partition_without_value_is_copied_too(spark, tmp_path):
    rows = spark.sql("SELECT CAST(NULL AS DATE) AS timestamp_day, 's' AS stream_id, 1L AS batch")
    other = spark.sql("SELECT DATE'2025-01-01' AS timestamp_day, 's' AS stream_id, 1L AS batch")
    assert rows.union(other).where(copies.within("timestamp_day", [None])).count() == 1
    assert rows.union(other).where(copies.within("timestamp_day", [None, dt.date(2025, 1, 1)])).count() == 2
    found = {r.timestamp_day: r.made_of for r in copies.marks(rows.union(other), "timestamp_day").collect()}
    assert set(found) == {None, dt.date(2025, 1, 1)} and len(set(found.values())) == 1


@pytest.mark.parametrize("mode", [HASH, NONE, RANGE])
def test_distribution_modes_keep_every_row(spark, tmp_path, mode):
    lake = LakeSink(str(tmp_path), distribution=mode)
    lake(_batch(spark, MIXED).repartition(4), 0)
    assert lake.read(spark, SAFE_TABLE).count() == lake.read(spark, PROFANE_TABLE).count() == 6
    folder = tmp_path / SAFE_TABLE / "stream_id=direct" / "batch=0"
    if mode == HASH:
        assert all(len(list(day.glob("*.parquet"))) == 1 for day in folder.glob("timestamp_day=*"))


def test_hash_mode_splits_a_hot_day(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 8).selectExpr(
        "sha2(cast(id as string), 512) AS message_id", "date'2025-01-01' AS timestamp_day"
    )
    with target_file_size(spark, 2 * 1024 * 1024):
        distribute(rows, HASH, "timestamp_day", ("message_id",)).write.partitionBy(
            "timestamp_day"
        ).parquet(f"{tmp_path}/t")
    assert len(list(tmp_path.glob("t/timestamp_day=*/*.parquet"))) > 3
    assert spark.read.parquet(f"{tmp_path}/t").count() == 200_000


def test_range_mode_splits_equal_rows(spark):
    rows = spark.range(0, 8000, 1, 8).selectExpr("'' AS message_id", "date'2025-01-01' AS timestamp_day")
    spread = distribute(rows, RANGE, "timestamp_day", ("message_id",), 8)
    assert spread.columns == rows.columns
    sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) <= 3000


def test_sized_files_cut_a_hot_day_and_keep_small_ones_whole(spark, tmp_path):
    # One day has most rows, twenty have few, one none of 1.5 files' worth, and some rows have no day.
    day = "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 <> 0 THEN date'2025-01-01' ELSE date_add(date'2025-02-01', cast(id % 7 as int)) END"
    rows = spark.range(0, 50_000, 1, 4).selectExpr("id", f"{day} AS timestamp_day").persist()
    spread = sized(rows, "timestamp_day", 4000)
    assert spread.columns == rows.columns
    spread.write.partitionBy("timestamp_day").parquet(f"{tmp_path}/t")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert sorted(map(tuple, back.select("id").collect())) == [(i,) for i in range(50_000)]
    files = back.groupBy("timestamp_day", "_metadata.file_name").count().collect()
    hot = [r["count"] for r in files if r.timestamp_day == dt.date(2025, 1, 1)]
    assert len(hot) == round(sum(hot) / 4000) and all(0.9 < n * len(hot) / sum(hot) < 1.1 for n in hot)
    assert len(files) - len(hot) == 8  # seven days and the rows without a day, each whole
    assert spread.rdd.getNumPartitions() <= len(hot) + 5  # small days share tasks
    empty = rows.where("id < 0")
    assert sized(empty, "timestamp_day", 4000).count() == 0
    assert all(sized(rows.limit(n), "timestamp_day", 1).count() == n for n in (1, 30))
    rows.unpersist()


def test_files_are_sized_by_those_of_earlier_batches(spark, tmp_path):
    assert bytes_per_row(spark, str(tmp_path), [], 1000) is None
    lake = LakeSink(str(tmp_path), file_bytes=32 * 1024, measured=True)
    for batch_id, n in ((0, 0), (1, 4000), (2, 40_000)):
        ids = spark.range(n).selectExpr("cast(id as string) AS message_id", "sha2(cast(id as string), 256) AS message_body", "'2025-01-01T10:00:00Z' AS timestamp")
        nulls = [F.lit(None).cast("string").alias(c) for c in ("account_id", "correlation_id", "message_status")]
        batch = ids.select("*", *nulls, F.lit("SAFE").alias("profanity_type"), F.lit("2025-06-01").cast("timestamp").alias("ingest_ts"))
        lake(batch, batch_id)
    assert lake.read(spark, SAFE_TABLE).count() == 44_000
    sizes = [p.stat().st_size for p in tmp_path.glob(f"{SAFE_TABLE}/stream_id=direct/batch=2/*/*.parquet")]
    assert len(sizes) > 40 and all(abs(size / (32 * 1024) - 1) < 0.25 for size in sizes)


def test_files_keep_the_order_of_the_source(spark, tmp_path):
    lake = LakeSink(str(tmp_path), writers=6, in_order=True)
    rows = [(i, _row(i, day=1 + i % 2)) for i in range(2000)]
    mixed = sorted(rows, key=lambda row: hash((row[0], "mixed")))
    stamped = _batch(spark, [row for _, row in mixed]).repartition(7)
    place = F.substring("message_id", 2, 9).cast("int")
    batch = stamped.withColumns({"source_partition": place % 3, "offset": F.when(place % 500 != 0, place).cast("long")})
    lake(batch, 0)
    found = lake.read_as_stored(spark, SAFE_TABLE)
    kept = [(r.timestamp_day, r.source_partition, r.offset) for r in found.orderBy("stored").collect()]
    assert len(kept) == 2000 and found.select("stored.file").distinct().count() > 4
    for day in (1, 2):
        for source in range(3):
            offsets = [o if o is not None else -1 for d, s, o in kept if d == dt.date(2025, 1, day) and s == source]
            assert offsets == sorted(offsets)
    # The places are beside the table's columns, not among them; a batch without places has none.
    assert lake.read(spark, SAFE_TABLE).columns == [*MESSAGE_FIELDS, "timestamp_day"]
    lake(_batch(spark, MIXED), 1)
    assert lake.read_as_stored(spark, SAFE_TABLE).where("source_partition IS NULL").count() == 6
    assert lake.read(spark, SAFE_TABLE).count() == 2006


def test_writer_count_and_unknown_mode(spark):
    rows = spark.range(100).selectExpr("id AS message_id", "date'2025-01-01' AS timestamp_day")
    for mode in (NONE, RANGE):
        assert distribute(rows, mode, "timestamp_day", ("message_id",), 3).rdd.getNumPartitions() <= 3
    plan = distribute(rows, HASH, "timestamp_day", (), 3)._jdf.queryExecution().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan or "RebalancePartitions" in plan
    with pytest.raises(ValueError):
        distribute(rows, "ROUND", "timestamp_day", ())


def test_target_file_size_is_restored(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with target_file_size(spark, 1234):
        assert spark.conf.get(key) == "1234"
    assert spark.conf.get(key) == before


def test_stored_size_is_the_size_of_the_files(spark, tmp_path):
    olap = OlapSink(str(tmp_path))
    olap(_batch(spark, MIXED), 0)
    on_disk = sum(p.stat().st_size for p in tmp_path.glob("**/*.parquet"))
    row = analytics.stored_size(spark, olap.path).first()
    assert (row.bytes, row.size) == (on_disk, f"{on_disk / 1024:.2f} KiB")


def test_topic_feed_options():
    assert TopicFeed("broker:29092").options() == {
        "kafka.bootstrap.servers": "broker:29092",
        "topic": "output-topic",
        "kafka.acks": "all",
    }


def test_catalog_tables_follow_the_committed_folders(spark, tmp_path):
    lake, olap = LakeSink(f"{tmp_path}/lake"), OlapSink(f"{tmp_path}/olap")
    for _ in range(2):
        tables.create_lake_tables(spark, "screening_test", lake)
        tables.create_olap_table(spark, "screening_test", olap)
    spark.range(1).createOrReplaceTempView("a_temporary_view")
    names = {r.tableName for r in tables.list_tables(spark, "screening_test").collect()}
    kept = {f"{PROFANE_TABLE}_compacted", f"{SAFE_TABLE}_compacted", "message_events_merged"}
    assert names == {PROFANE_TABLE, SAFE_TABLE, "message_events", *kept}
    columns = tables.describe_table(spark, f"screening_test.{SAFE_TABLE}").collect()
    described = {r.col_name: r.data_type for r in columns}
    assert described["timestamp"] == "timestamp_ntz" and described["timestamp_day"] == "date"

    def count(table):
        return spark.table(f"screening_test.{table}").count()

    lake(_batch(spark, MIXED), 0)
    lake(_batch(spark, MIXED), 1)
    for table in TABLES:
        tables.publish(spark, f"screening_test.{table}", lake.path(table))
        assert count(table) == 12
    lake.compact(spark, SAFE_TABLE)
    lake(_batch(spark, MIXED), 2)
    tables.publish(spark, f"screening_test.{SAFE_TABLE}", lake.path(SAFE_TABLE))
    olap(_batch(spark, MIXED), 0)
    for sink_rows in (12, 18):  # a copy by name follows each refresh
        tables.publish_copies(spark, [("screening_test", lake), ("screening_test", olap)])
        assert (count(SAFE_TABLE), count(f"{SAFE_TABLE}_compacted")) == (18, sink_rows)
        lake.compact(spark, SAFE_TABLE)
        olap.merge(spark)
    tables.publish_copies(spark, [("screening_test", olap)])
    assert count("message_events_merged") == 12
    assert tables.sample(spark.table(f"screening_test.{SAFE_TABLE}"), 5).count() == 5
    spark.sql("DROP DATABASE screening_test CASCADE")
    assert lake.read(spark, SAFE_TABLE).count() == 18
