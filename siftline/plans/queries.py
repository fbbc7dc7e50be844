"""Named queries. Each takes (spark, sf_dir) and reads the whole tables there."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftline.functions.instants import wall_clock
from siftline.operators import analytics, convert, decode, late
from siftline.operators.classify import classify, classify_by_join, profane_only
from siftline.operators.dedup import latest_versions
from siftline.operators.lexicon import DEFAULT_WORDS, clean_words, inline_words, words_table
from siftline.plans import views
from siftline.schema import LAKE_DAY, MESSAGE_FIELDS, OLAP_FIELDS, OLAP_MONTH, PROFANE_TABLE, SAFE_TABLE
from siftline.session import prepare, shared_dir
from siftline.sinks.batches import as_stream, batch_dir
from siftline.sinks.fanout import FanOut, ReportFiles
from siftline.sinks.feed import FileFeed, RejectFiles, RowFiles
from siftline.sinks.lake import TABLES, LakeSink, table_of
from siftline.sinks.olap import OlapSink
from siftline.sinks.records import RecordFiles, without_repeats
from siftline.sources import tables
from siftline.sources.local import MAX_BATCH_BYTES
from siftline.streaming.clocks import arrivals_by_partition
from siftline.streaming.job import run, window_query
from siftline.streaming.late_rows import start_late_rows

Query = Callable[[SparkSession, str], DataFrame]
TAGS = ("account_id", "message_id", "profanity_type")
RANGE_START = dt.datetime(2024, 1, 15, 12)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.document_messages(views.table(spark, sf_dir, "documents"))


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.conversation_messages(views.table(spark, sf_dir, "conversations"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events")


def _irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(views.irregular_event_messages(_events(spark, sf_dir)), views.EVENT_WORDS)


def _event_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.event_table(_events(spark, sf_dir))


def _document_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_documents(spark, sf_dir), DEFAULT_WORDS)


def _event_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.event_table(_events(spark, sf_dir)).withColumnRenamed("event_time", "timestamp")
    return convert.with_lake_day(rows)


# Word lists and classification


def lexicon_words(spark, sf_dir):
    return clean_words(views.word_lines(views.table(spark, sf_dir, "documents")))


def classify_messages(spark, sf_dir):
    return _document_table(spark, sf_dir).select(*TAGS)


def classify_large_lexicon(spark, sf_dir):
    words = views.benchmark_words(views.table(spark, sf_dir, "benchmark"))
    listed = inline_words(words)
    return classify(_documents(spark, sf_dir), words if listed is None else listed).select(*TAGS)


def classify_by_lexicon_table(spark, sf_dir):
    words = views.rough_words(views.table(spark, sf_dir, "benchmark"))
    return classify_by_join(_documents(spark, sf_dir), words).select(*TAGS)


def classify_by_benchmark_table(spark, sf_dir):
    """The list of ``classify_large_lexicon``, as a table."""
    words = views.benchmark_words(views.table(spark, sf_dir, "benchmark"))
    return classify_by_join(_documents(spark, sf_dir), words).select(*TAGS)


def classify_by_shuffled_lexicon(spark, sf_dir):
    """The form for tables that are too large to broadcast."""
    words = views.rough_words(views.table(spark, sf_dir, "benchmark"))
    return classify_by_join(_documents(spark, sf_dir), words, broadcast_rows=0).select(*TAGS)


def classify_default_by_table(spark, sf_dir):
    words = words_table(spark, DEFAULT_WORDS)
    return classify_by_join(_documents(spark, sf_dir), words).select(*TAGS)


def profane_messages(spark, sf_dir):
    return profane_only(classify(_conversations(spark, sf_dir), DEFAULT_WORDS))


# Decoding and encoding


def topic_payload_json(spark, sf_dir):
    feed = profane_only(classify(_conversations(spark, sf_dir), DEFAULT_WORDS))
    value = decode.encode_json(feed)
    keys = F.array_join(F.json_object_keys("value"), ",").alias("fields")
    return value.select(keys, *(F.get_json_object("value", f"$.{f}").alias(f) for f in MESSAGE_FIELDS))


def decode_json_messages(spark, sf_dir):
    raw = views.conversation_values(views.table(spark, sf_dir, "conversations"))
    return decode.messages_of(decode.inspect_json(raw))


def quarantine_json(spark, sf_dir):
    raw = views.conversation_values(views.table(spark, sf_dir, "conversations"))
    return decode.rejects_of(decode.inspect_json(raw)).select("source_partition", "offset", "reason")


# Row conversion and event time


def instants_parsed(spark, sf_dir):
    return views.parsed_instants(views.irregular_event_messages(_events(spark, sf_dir)))


def lake_rows(spark, sf_dir):
    return convert.lake_rows(_irregular(spark, sf_dir), views.ingest_ts())


def olap_rows(spark, sf_dir):
    return convert.olap_rows(_irregular(spark, sf_dir), views.ingest_ts())


def event_time_assigned(spark, sf_dir):
    at = convert.event_time(F.col("timestamp"), views.ingest_ts())
    return _irregular(spark, sf_dir).select("message_id", wall_clock(at).alias("event_ts"))


def route_counts_by_day(spark, sf_dir):
    """Rows per lake table and day, with bad timestamps turning profane rows into safe ones."""
    rows = convert.with_lake_day(convert.lake_rows(_irregular(spark, sf_dir), views.ingest_ts()))
    table = table_of(F.col("profanity_type")).alias("table_name")
    return rows.groupBy(table, LAKE_DAY).agg(F.count("*").alias("n"))


def lake_range_scan(spark, sf_dir):
    return analytics.lake_range(_event_lake(spark, sf_dir), RANGE_START)


# Analytics


def count_all(spark, sf_dir):
    return analytics.count_all(_document_table(spark, sf_dir))


def count_by_type(spark, sf_dir):
    return analytics.count_by_type(_document_table(spark, sf_dir))


def type_share(spark, sf_dir):
    return analytics.type_share(_document_table(spark, sf_dir))


def _now():
    return F.lit("2024-01-20T06:00:00").cast("timestamp_ntz")


def recent_messages(spark, sf_dir):
    return analytics.recent(_event_table(spark, sf_dir), _now())


def messages_per_hour(spark, sf_dir):
    return analytics.messages_per_hour(_event_table(spark, sf_dir), _now())


def daily_trend(spark, sf_dir):
    return analytics.daily_trend(_event_table(spark, sf_dir))


def top_profane_accounts(spark, sf_dir):
    return analytics.top_profane_accounts(_event_table(spark, sf_dir))


def account_hour_heatmap(spark, sf_dir):
    return analytics.account_hour_heatmap(_event_table(spark, sf_dir))


def latest_messages(spark, sf_dir):
    return analytics.latest_messages(_event_table(spark, sf_dir))


def stored_size(spark, sf_dir):
    """Size on storage; no SQL counterpart, as SQL does not see files."""
    return analytics.stored_size(spark, f"{sf_dir}/events.parquet")


# Versions and duplicates


def _versions(spark, sf_dir):
    return views.event_versions(_events(spark, sf_dir))


def duplicate_keys(spark, sf_dir):
    return analytics.duplicate_keys(_versions(spark, sf_dir))


def latest_version_rows(spark, sf_dir):
    stored = convert.with_event_month(_versions(spark, sf_dir))
    return latest_versions(stored).select(*OLAP_FIELDS)


def _bucketed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.store_bucketed(_versions(spark, sf_dir), f"versions_{uuid.uuid4().hex}", shared_dir(spark, "versions"))


def bucketed_latest_versions(spark, sf_dir):
    """The latest versions of a table cut by key, read without a shuffle."""
    return latest_versions(_bucketed_versions(spark, sf_dir)).select(*OLAP_FIELDS)


def bucketed_duplicate_keys(spark, sf_dir):
    return analytics.duplicate_keys(_bucketed_versions(spark, sf_dir))


def merged_table(spark, sf_dir):
    """Versions written as a batch, then the merged table as stored."""
    sink = OlapSink(shared_dir(spark, "merged_table"))
    sink.append_stored(_versions(spark, sf_dir), 0)
    sink.merge(spark)
    return sink.read_merged(spark).select(*OLAP_FIELDS)


def lake_after_replay(spark, sf_dir):
    """The lake tables after a batch was written, written again, and compacted."""
    lake = LakeSink(shared_dir(spark, "lake_after_replay"))
    batch = _irregular(spark, sf_dir).withColumn("ingest_ts", views.ingest_ts())
    with as_stream(spark, "replayed"):
        lake(batch, 0)
        lake(batch, 0)
    for name in TABLES:
        lake.compact(spark, name)
    return _both_tables(spark, lake.read_compacted)


def _both_tables(spark: SparkSession, read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    profane, safe = (read(spark, name).withColumn("table_name", F.lit(name)) for name in TABLES)
    return profane.unionByName(safe)


def lake_in_arrival_order(spark, sf_dir):
    """Rows of the stored lake tables, numbered within their day and source partition as they lie in the files."""
    lake = LakeSink(shared_dir(spark, "in_order"), writers=5, in_order=True)
    arrived = classify(views.positioned_event_messages(_events(spark, sf_dir)), views.EVENT_WORDS)
    batch = arrived.withColumn("ingest_ts", views.ingest_ts())
    half = _events(spark, sf_dir).agg((F.max("event_id") / 2).alias("half")).scalar()
    with as_stream(spark, "ordered"):
        for batch_id, part in enumerate((F.col("offset") <= half, F.col("offset") > half)):
            lake(batch.where(part), batch_id)
    rows = _both_tables(spark, lake.read_as_stored)
    as_read = Window.partitionBy("table_name", LAKE_DAY, "source_partition").orderBy("stored")
    return rows.select("table_name", LAKE_DAY, "source_partition", "offset", F.row_number().over(as_read).alias("place"))


# Target size of the files of ``olap_file_sizes``, so small that a month becomes several at every scale.
SMALL_FILE = 48 * 1024


def olap_file_sizes(spark, sf_dir):
    """Of a batch whose files are sized by those of the two before: rows a month, and files that are further than a
    quarter from the target where a month takes several."""
    sink = OlapSink(shared_dir(spark, "file_sizes"), file_bytes=SMALL_FILE, measured=True)
    rows = _versions(spark, sf_dir)
    with as_stream(spark, "sized"):
        for batch_id in range(3):
            part = rows.where(F.least(F.col("message_id") % 8, F.lit(2)) == batch_id).persist()
            sink.append_stored(part, batch_id)
            part.unpersist()
    stored = spark.read.parquet(batch_dir(sink.path, "sized", 2))
    files = stored.groupBy(OLAP_MONTH, "_metadata.file_path", "_metadata.file_size").agg(F.count("*").alias("n"))
    far = F.abs(F.col("file_size") - SMALL_FILE) * 4 > SMALL_FILE
    off = F.when(F.count("*") > 1, F.count_if(far)).otherwise(0)
    return files.groupBy(OLAP_MONTH).agg(F.sum("n").alias("n_rows"), off.alias("files_off_target"))


# The analytics queries on what the sinks stored


def _stored_olap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged table after two batches of versions with a merge after each."""
    sink = OlapSink(shared_dir(spark, "stored_olap"))
    versions = _versions(spark, sf_dir)
    sink.append_stored(versions.where("batch_id < 2"), 0)
    sink.merge(spark)
    sink.append_stored(versions.where("batch_id >= 2"), 1)
    sink.merge(spark)
    return sink.read_merged(spark).select(*OLAP_FIELDS, OLAP_MONTH)


def stored_recent_messages(spark, sf_dir):
    return analytics.recent(_stored_olap(spark, sf_dir), _now()).select(*OLAP_FIELDS)


def stored_messages_per_hour(spark, sf_dir):
    return analytics.messages_per_hour(_stored_olap(spark, sf_dir), _now())


def stored_daily_trend(spark, sf_dir):
    return analytics.daily_trend(_stored_olap(spark, sf_dir))


def stored_type_share(spark, sf_dir):
    return analytics.type_share(_stored_olap(spark, sf_dir))


def stored_top_profane_accounts(spark, sf_dir):
    return analytics.top_profane_accounts(_stored_olap(spark, sf_dir))


def stored_account_hour_heatmap(spark, sf_dir):
    return analytics.account_hour_heatmap(_stored_olap(spark, sf_dir))


def stored_latest_messages(spark, sf_dir):
    return analytics.latest_messages(_stored_olap(spark, sf_dir)).select(*OLAP_FIELDS)


def _stored_lake(spark: SparkSession, sf_dir: str) -> LakeSink:
    lake = LakeSink(shared_dir(spark, "stored_lake"))
    lake(_irregular(spark, sf_dir).withColumn("ingest_ts", views.ingest_ts()), 0)
    return lake


def stored_lake_range(spark, sf_dir):
    """Rows of a stored lake table after a time, its days pruned."""
    return analytics.lake_range(_stored_lake(spark, sf_dir).read(spark, SAFE_TABLE), RANGE_START)


def lake_by_name(spark, sf_dir):
    """Both lake tables read by their names in the catalog."""
    lake, namespace = _stored_lake(spark, sf_dir), f"lake_{uuid.uuid4().hex}"
    tables.create_lake_tables(spark, namespace, lake)
    tables.publish_all(spark, sinks=[(namespace, lake)])
    profane, safe = (
        spark.table(f"{namespace}.{name}").select(*MESSAGE_FIELDS, LAKE_DAY, F.lit(name).alias("table_name")) for name in TABLES
    )
    return profane.unionByName(safe)


# Late rows and windows


def late_rows_audit(spark, sf_dir):
    return late.mark_late(views.event_arrivals(_events(spark, sf_dir)))


def window_counts(spark, sf_dir):
    messages = _irregular(spark, sf_dir)
    at = convert.event_time(F.col("timestamp"), views.ingest_ts())
    counted = late.window_counts(messages.withColumn("event_ts", at))
    return counted.withColumn("window_start", wall_clock(F.col("window_start"))).withColumn(
        "window_end", wall_clock(F.col("window_end"))
    )


def _slices(rows: DataFrame, path: str, count: int = 3, *partitions: str):
    """Append ``rows`` to a folder in slices of their arrival order, as a source would bring them."""
    last = rows.agg(F.max("offset")).first()[0] or 0
    for n in range(count):
        part = F.floor(F.coalesce("offset", F.lit(0)) * count / (last + 1)) == n
        rows.where(part).write.mode("append").partitionBy(*partitions).parquet(path)
        yield n


def stream_late_rows(spark, sf_dir):
    """The late rows of a stream, written apart; the query is started anew for every slice of the arrivals."""
    root = shared_dir(spark, "late_rows")
    rows = views.event_arrivals(_events(spark, sf_dir)).withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField(n, t) for n, t in (kinds | {"watermark": kinds["event_ts"]}).items()])
    sink = RowFiles(f"{root}/late", schema)
    for _ in _slices(rows, f"{root}/in"):
        source = lambda session: session.readStream.schema(rows.schema).parquet(f"{root}/in")
        start_late_rows(spark, source, sink, f"{root}/checkpoint").awaitTermination()
    times = (wall_clock(F.col(c)).alias(c) for c in ("event_ts", "watermark"))
    return sink.read(spark).select("source_partition", "offset", *times)


def windows_by_partition(spark, sf_dir):
    """Closed windows over sources whose clocks differ by hours, each with a watermark of its own."""
    root = shared_dir(spark, "windows")
    rows = views.skewed_event_messages(_events(spark, sf_dir))
    names = ("window_start", "window_end")
    schema = T.StructType([T.StructField(n, T.TimestampType()) for n in names])
    sink = RowFiles(f"{root}/closed", schema.add("profanity_type", "string").add("n", "long"))

    def source(partition: int):
        folder = f"{root}/in/source_partition={partition}"
        return lambda session: session.readStream.schema(rows.drop("source_partition").schema).parquet(folder)

    for _ in _slices(rows, f"{root}/in", 3, "source_partition"):
        arrived = arrivals_by_partition(spark, [source(p) for p in range(3)])
        counted = late.window_counts(classify(arrived, views.EVENT_WORDS))
        window_query(counted, sink, f"{root}/checkpoint", None, "windows_by_partition").awaitTermination()
    return sink.read(spark).withColumns({n: wall_clock(F.col(n)) for n in names})


# The job end to end


def _stream_documents(spark: SparkSession, sf_dir: str) -> FanOut:
    """Run the job over the documents as JSON values, some with bad timestamps or JSON."""
    schema = views.table(spark, sf_dir, "documents").schema

    def source(session: SparkSession) -> DataFrame:
        # The file source wants a folder or a pattern, not a single file.
        reader = session.readStream.schema(schema).option("maxBytesPerTrigger", MAX_BATCH_BYTES)
        documents = reader.parquet(f"{sf_dir}/documents[.]parquet")
        return views.document_values(documents)

    root = shared_dir(spark, "screening")
    sinks = FanOut(
        words=DEFAULT_WORDS,
        feed=FileFeed(f"{root}/feed"),
        lake=LakeSink(f"{root}/lake"),
        olap=OlapSink(f"{root}/olap"),
        rejects=RejectFiles(f"{root}/rejects"),
        report=ReportFiles(f"{root}/report"),
    )
    run(spark, source, sinks, f"{root}/checkpoint")
    return sinks


def stream_conservation(spark, sf_dir):
    """What arrived in a run of the job, how it was judged and what each sink wrote, as counted on the way."""
    counts = _stream_documents(spark, sf_dir).report.read(spark)
    return counts.groupBy("name").agg(F.sum("n").alias("n"))


def stream_fan_out_counts(spark, sf_dir):
    """Rows in each sink after one run of the job."""
    sinks = _stream_documents(spark, sf_dir)
    written = {
        "feed": sinks.feed.read(spark),
        PROFANE_TABLE: sinks.lake.read(spark, PROFANE_TABLE),
        SAFE_TABLE: sinks.lake.read(spark, SAFE_TABLE),
        "olap": sinks.olap.read(spark),
        "rejects": sinks.rejects.read(spark),
    }
    return _counted(written)


def feed_after_replay(spark, sf_dir):
    """The profane conversation turns as a reader of the feed sees them after batches were sent twice."""
    root = shared_dir(spark, "feed_after_replay")
    raw = views.conversation_values(views.table(spark, sf_dir, "conversations")).withColumn("ingest_ts", views.ingest_ts())
    feed = RecordFiles(f"{root}/records")
    with as_stream(spark, "replayed"):
        for batch_id in (0, 0, 1, 0):  # the last replay comes after a later batch
            part = decode.messages_of(decode.inspect_json(raw.where(F.col("source_partition") % 2 == batch_id)))
            sent = F.col("ingest_ts") + F.make_dt_interval(F.lit(0), F.lit(batch_id))
            batch = classify(part, DEFAULT_WORDS).withColumn("ingest_ts", sent)
            feed(profane_only(batch), batch_id)
            query = (
                without_repeats(feed.read_stream(spark))
                .writeStream.outputMode("append")
                .option("checkpointLocation", f"{root}/checkpoint")
                .option("path", f"{root}/read")
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
    seen = spark.read.schema("value string, sent timestamp").parquet(f"{root}/read")
    return seen.select(*(F.get_json_object("value", f"$.{f}").alias(f) for f in ("account_id", "message_id", "message_body", "profanity_type")))


def job_on_records_counts(spark, sf_dir):
    """Rows in each sink after the job took decoded records instead of JSON values."""
    root = shared_dir(spark, "records")
    sinks = FanOut(DEFAULT_WORDS, FileFeed(f"{root}/feed"), LakeSink(f"{root}/lake"), OlapSink(f"{root}/olap"))
    run(spark, lambda session: _documents(session, sf_dir), sinks)
    written = {
        "feed": sinks.feed.read(spark),
        PROFANE_TABLE: sinks.lake.read(spark, PROFANE_TABLE),
        SAFE_TABLE: sinks.lake.read(spark, SAFE_TABLE),
        "olap": sinks.olap.read(spark),
    }
    return _counted(written)


def _counted(written: dict[str, DataFrame]) -> DataFrame:
    counts = [rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("sink"), "n") for name, rows in written.items()]
    return reduce(DataFrame.unionByName, counts)


def stream_lake_tables(spark, sf_dir):
    """The lake tables a run of the job leaves, except times taken from the clock."""
    lake = _stream_documents(spark, sf_dir).lake
    known = F.col("message_status") != "ERROR"
    return (
        _both_tables(spark, lake.read)
        .withColumn("timestamp", F.when(known, F.col("timestamp")))
        .withColumn(LAKE_DAY, F.when(known, F.col(LAKE_DAY)))
    )


ALL: dict[str, Query] = {
    query.__name__: query
    for query in (
        lexicon_words,
        classify_messages,
        classify_large_lexicon,
        classify_by_lexicon_table,
        classify_by_benchmark_table,
        classify_by_shuffled_lexicon,
        classify_default_by_table,
        profane_messages,
        topic_payload_json,
        decode_json_messages,
        quarantine_json,
        instants_parsed,
        lake_rows,
        olap_rows,
        event_time_assigned,
        route_counts_by_day,
        lake_range_scan,
        count_all,
        count_by_type,
        type_share,
        recent_messages,
        messages_per_hour,
        daily_trend,
        top_profane_accounts,
        account_hour_heatmap,
        latest_messages,
        stored_size,
        duplicate_keys,
        latest_version_rows,
        bucketed_latest_versions,
        bucketed_duplicate_keys,
        merged_table,
        lake_after_replay,
        lake_in_arrival_order,
        olap_file_sizes,
        stored_recent_messages,
        stored_messages_per_hour,
        stored_daily_trend,
        stored_type_share,
        stored_top_profane_accounts,
        stored_account_hour_heatmap,
        stored_latest_messages,
        stored_lake_range,
        lake_by_name,
        late_rows_audit,
        window_counts,
        stream_late_rows,
        windows_by_partition,
        feed_after_replay,
        job_on_records_counts,
        stream_fan_out_counts,
        stream_conservation,
        stream_lake_tables,
    )
}


def prepared(query: Query) -> Query:
    return lambda spark, sf_dir: query(prepare(spark), sf_dir)


def queries() -> dict[str, Query]:
    return {name: prepared(query) for name, query in ALL.items()}
