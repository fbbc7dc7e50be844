"""The whole job over JSON files: counts per sink, restarts, late and bad input."""

import datetime as dt
import json
import os
import time
import uuid
from dataclasses import replace
from functools import partial

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from siftline.__main__ import create_tables, merge_all, sinks_for
from siftline.operators.lexicon import words_table
from siftline.schema import PROFANE_TABLE, SAFE_TABLE
from siftline.settings import Settings
from siftline.sinks import batches
from siftline.sinks.fanout import FanOut
from siftline.sinks.feed import FileFeed, RejectFiles
from siftline.sinks.lake import LakeSink
from siftline.sinks.olap import OlapSink
from siftline.sources import tables
from siftline.sources.local import LineFiles, messages
from siftline.streaming.job import arrivals, run, start, start_all, start_windows


class Job:
    def __init__(self, spark, root, quarantine=False, words=("gun", "bad", "word")):
        self.spark, self.root = spark, root
        (root / "in").mkdir()
        self.written = 0
        self.sinks = FanOut(
            words=list(words),
            feed=FileFeed(f"{root}/feed"),
            lake=LakeSink(f"{root}/lake"),
            olap=OlapSink(f"{root}/olap"),
            rejects=RejectFiles(f"{root}/rejects") if quarantine else None,
        )

    def put(self, name, rows):
        lines = [row if isinstance(row, str) else json.dumps(row) for row in rows]
        path = self.root / "in" / name
        path.write_text("\n".join(lines) + "\n" if lines else "")
        # The file source orders by modification time: keep the order of writing.
        self.written += 1
        os.utime(path, (self.written, 1_700_000_000 + self.written))

    def run(self, sinks=None, **bounds):
        source = LineFiles(f"{self.root}/in", **bounds)
        run(self.spark, source, sinks or self.sinks, f"{self.root}/checkpoint")

    def counts(self):
        s = self.sinks
        return {
            "feed": s.feed.read(self.spark).count(),
            "profane": s.lake.read(self.spark, PROFANE_TABLE).count(),
            "safe": s.lake.read(self.spark, SAFE_TABLE).count(),
            "olap": s.olap.read_all(self.spark).count(),
        }


def _message(n, body, **changes):
    return {
        "account_id": "1",
        "message_id": str(n),
        "message_body": body,
        "timestamp": "2025-01-01T10:00:00Z",
        **changes,
    }


def _counts(profane, safe):
    return {"feed": profane, "profane": profane, "safe": safe, "olap": profane + safe}


@pytest.mark.parametrize(
    "bodies, profane",
    [
        (["see you at six", "a BAD gun, my word"], 1),
        ([], 0),
        (["rain later", "no news"], 0),
        (["begun", "badly"], 2),
        (["gun"] * 5 + ["fine"] * 5, 5),
    ],
)
@pytest.mark.parametrize("injected", [False, True])
def test_counts_per_sink(spark, tmp_path, bodies, profane, injected):
    job = Job(spark, tmp_path)
    rows = [_message(i, body) for i, body in enumerate(bodies)]
    if injected:
        run(spark, lambda session: messages(session, rows), job.sinks)
    else:
        job.put("a.json", rows)
        job.run()
    assert job.counts() == _counts(profane, len(bodies) - profane)


def test_bounded_values_run_once_as_a_batch(spark, tmp_path):
    job = Job(spark, tmp_path, quarantine=True)
    job.put("a.json", [_message(1, "gun"), "not json", _message(2, "ok")])
    run(spark, LineFiles(f"{tmp_path}/in", streaming=False), job.sinks)
    assert job.counts() == _counts(1, 1) and job.sinks.rejects.read(spark).count() == 1


def test_feed_does_not_wait_for_the_lake(spark, tmp_path):
    job = Job(spark, tmp_path, quarantine=True)
    job.put("a.json", [_message(0, "gun")])
    queries = start_all(spark, LineFiles(f"{tmp_path}/in"), job.sinks, f"{tmp_path}/checkpoint", 3_600_000, 100)
    try:
        queries[0].processAllAvailable()
        ends = time.monotonic() + 60
        while job.counts()["profane"] == 0 and time.monotonic() < ends:
            time.sleep(0.2)  # the first lake commit; the next is an hour away
        job.put("b.json", [_message(1, "gun"), _message(2, "ok"), "not json"])
        queries[0].processAllAvailable()
        # The lake's interval is still open.
        assert job.counts() == {"feed": 2, "profane": 1, "safe": 0, "olap": 3}
        assert job.sinks.rejects.read(spark).count() == 1
    finally:
        for query in queries:
            query.stop()
    job2 = start(spark, LineFiles(f"{tmp_path}/in"), job.sinks.lake_only(), f"{tmp_path}/checkpoint/lake", None, mode="quarantine")
    job2.awaitTermination()
    assert job.counts() == _counts(2, 1)


def test_default_deployment_by_name_and_path(spark, tmp_path):
    fresh = uuid.uuid4().hex  # the warehouse outlives a run of the tests
    settings = Settings.from_env({"SIFTLINE_DECODE_MODE": "quarantine", "ICEBERG_NAMESPACE": f"raw_{fresh}", "CLICKHOUSE_DATABASE": f"db_{fresh}"})
    made = sinks_for(spark, settings)
    assert made.lake.root.startswith("file:/")
    sinks = replace(made, feed=FileFeed(f"{tmp_path}/feed"), rejects=RejectFiles(f"{tmp_path}/rejects"))
    with pytest.warns(UserWarning, match="persistent catalog"):
        create_tables(spark, settings, sinks)
    job = Job(spark, tmp_path)
    job.put("a.json", [_message(1, "gun"), _message(2, "ok")])
    for _ in range(2):
        job.run(sinks)
        for table in (PROFANE_TABLE, SAFE_TABLE):
            assert spark.table(f"{settings.namespace}.{table}").count() == sinks.lake.read(spark, table).count() == 1
        assert spark.table(f"{settings.olap_database}.message_events").count() == sinks.olap.read_all(spark).count() == 2
    # A table made by another session in the same place sees the same files.
    assert spark.newSession().table(f"{settings.namespace}.{SAFE_TABLE}").count() == 1
    merge_all(spark, settings)
    for table in ("message_events", "message_events_merged"):
        assert spark.table(f"{settings.olap_database}.{table}").count() == 2
    assert spark.table(f"{settings.namespace}.{SAFE_TABLE}_compacted").count() == 1
    for namespace in (settings.namespace, settings.olap_database):
        spark.sql(f"DROP DATABASE {namespace} CASCADE")


def test_continuous_job_needs_a_checkpoint(spark, tmp_path):
    job = Job(spark, tmp_path)
    with pytest.raises(ValueError, match="checkpoint"):
        start(spark, LineFiles(f"{tmp_path}/in"), job.sinks)


def test_feed_holds_the_profane_message_whole(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.put("a.json", [_message(100, "the starting gun was late", extra=1), _message(101, "on time")])
    job.run()
    (line,) = job.sinks.feed.read(spark).collect()
    assert json.loads(line.value) == {
        "account_id": "1",
        "message_id": "100",
        "message_body": "the starting gun was late",
        "correlation_id": None,
        "message_status": None,
        "timestamp": "2025-01-01T10:00:00Z",
        "profanity_type": "PROFANITY",
    }


def test_restart_continues_where_it_stopped(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.put("a.json", [_message(1, "gun")])
    job.run()
    job.run()
    job.put("b.json", [_message(2, "fine")])
    job.run()
    assert job.counts() == _counts(1, 1)
    folders = batches.committed(spark, f"{tmp_path}/olap/message_events")
    assert len({f.split("/")[0] for f in folders}) == 1


def test_many_batches(spark, tmp_path):
    job = Job(spark, tmp_path)
    for n in range(4):
        job.put(f"{n}.json", [_message(10 * n + i, "gun" if i else "ok") for i in range(3)])
    job.run(max_bytes=1)
    assert job.counts() == _counts(8, 4)
    assert len(batches.committed(spark, f"{tmp_path}/feed")) == 4


class Both:
    def __init__(self, *sinks):
        self.sinks = sinks

    def __call__(self, batch, batch_id):
        for sink in self.sinks:
            sink(batch, batch_id)


def test_failed_batch_is_replayed_without_duplicates(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.put("a.json", [_message(1, "gun", timestamp=None), _message(2, "fine")])
    seen = []

    def broken(batch, batch_id):
        seen.append({r.ingest_ts for r in batch.collect()})
        raise RuntimeError("sink down")

    failing = replace(job.sinks, lake=Both(job.sinks.lake, broken), olap=None)
    with pytest.raises(StreamingQueryException, match="sink down"):
        job.run(failing)
    assert job.counts() == {"feed": 1, "profane": 1, "safe": 1, "olap": 0}
    written = job.sinks.lake.read(spark, PROFANE_TABLE).first().timestamp
    job.run()
    assert job.counts() == _counts(1, 1)
    # The replayed batch has its first ingest time, so all sinks agree on it.
    assert job.sinks.lake.read(spark, PROFANE_TABLE).first().timestamp == written
    stored = job.sinks.olap.read_all(spark).where("message_id = '1'").first()
    assert stored.event_time == written.replace(microsecond=written.microsecond // 1000 * 1000)
    assert stored.inserted_at == written.replace(microsecond=0)


def test_new_checkpoint_never_overwrites(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.put("a.json", [_message(1, "gun")])
    run(spark, LineFiles(f"{tmp_path}/in"), job.sinks, f"{tmp_path}/c1")
    run(spark, LineFiles(f"{tmp_path}/in"), job.sinks, f"{tmp_path}/c2")
    assert job.counts() == _counts(2, 0)
    # The analytics table recognises the repeated message.
    assert job.sinks.olap.read(spark).count() == 1


def test_out_of_order_rows_reach_every_sink(spark, tmp_path):
    job = Job(spark, tmp_path)
    times = ["10:01:00", "10:00:55", "10:00:00", "10:02:00"]
    for n, clock in enumerate(times):
        job.put(f"{n}.json", [_message(n, "gun", timestamp=f"2025-01-01T{clock}Z")])
        job.run()
    assert job.counts() == _counts(4, 0)


def test_quarantine_keeps_bad_values_aside(spark, tmp_path):
    job = Job(spark, tmp_path, quarantine=True)
    job.put("a.json", [_message(1, "gun"), "not json gun", '{"account_id":{"a":1}}', _message(2, "ok"), "null"])
    job.run()
    assert job.counts() == _counts(1, 1)
    rejects = {r.reason: r.value for r in job.sinks.rejects.read(spark).collect()}
    assert rejects == {
        "malformed_json": "not json gun",
        "nested_field": '{"account_id":{"a":1}}',
        "null_record": "null",
    }


def test_failfast_stops_the_job(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.put("a.json", [_message(1, "gun"), "not json"])
    with pytest.raises(StreamingQueryException, match="cannot decode message"):
        job.run()
    assert job.counts() == _counts(0, 0)


def test_unknown_decode_mode(spark):
    with pytest.raises(ValueError):
        arrivals(spark.createDataFrame([("{}",)], "value string"), "lenient")


def test_continuous_trigger(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.put("a.json", [_message(1, "gun")])
    query = start(
        spark, LineFiles(f"{tmp_path}/in"), job.sinks, f"{tmp_path}/checkpoint", 200, "screening_test"
    )
    try:
        query.processAllAvailable()
        job.put("b.json", [_message(2, "ok")])
        query.processAllAvailable()
        assert query.name == "screening_test"
    finally:
        query.stop()
    assert job.counts() == _counts(1, 1)


def test_catalog_shows_each_batch_once_written(spark, tmp_path):
    job = Job(spark, tmp_path)
    published = [("job_lake", job.sinks.lake), ("job_olap", job.sinks.olap)]
    tables.create_lake_tables(spark, "job_lake", job.sinks.lake)
    tables.create_olap_table(spark, "job_olap", job.sinks.olap)
    sinks = replace(job.sinks, written=partial(tables.publish_all, sinks=published))
    for n in range(2):
        job.put(f"{n}.json", [_message(2 * n, "gun"), _message(2 * n + 1, "ok")])
        job.run(sinks)
        assert spark.table(f"job_lake.{PROFANE_TABLE}").count() == n + 1
        assert spark.table(f"job_lake.{SAFE_TABLE}").count() == n + 1
        assert spark.table("job_olap.message_events").count() == 2 * n + 2
    for namespace, _ in published:
        spark.sql(f"DROP DATABASE {namespace} CASCADE")


def test_word_table_as_lexicon(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.put("a.json", [_message(1, "a GUN"), _message(2, "ok"), _message(3, None)])
    sinks = FanOut(words_table(spark, ["gun"]), job.sinks.feed, job.sinks.lake, job.sinks.olap)
    job.run(sinks)
    assert job.counts() == _counts(1, 2)


def test_batch_source_through_the_same_functions(spark, tmp_path):
    job = Job(spark, tmp_path)
    job.put("a.json", [_message(1, "gun"), _message(2, "ok")])
    batch = arrivals(LineFiles(f"{tmp_path}/in", streaming=False)(spark))
    job.sinks(batch, 0)
    assert job.counts() == _counts(1, 1)


def test_windows_drop_late_rows_only_in_their_own_query(spark, tmp_path):
    job = Job(spark, tmp_path)
    # Spark judges lateness by the watermark of the batch before.
    stamps = [["10:00:01", "10:04:59"], ["10:20:00"], ["10:20:30"], ["10:01:00", "10:21:00"], ["10:40:00"]]
    for n, times in enumerate(stamps):
        job.put(
            f"{n}.json",
            [_message(f"{n}-{i}", "gun", timestamp=f"2025-01-01T{t}Z") for i, t in enumerate(times)],
        )
    source = LineFiles(f"{tmp_path}/in", max_bytes=1)
    closed = {}

    def keep(batch, batch_id):
        closed.update({r.window_start: r.n for r in batch.collect()})

    start_windows(spark, source, ["gun"], keep, f"{tmp_path}/windows", None).awaitTermination()
    # 10:01:00 arrived when the watermark stood at 10:19:50: its window was closed.
    assert closed == {dt.datetime(2025, 1, 1, 10, 0): 2, dt.datetime(2025, 1, 1, 10, 20): 3}
    job.run()
    assert job.counts()["olap"] == 7


def test_event_time_falls_back_to_ingest(spark):
    rows = arrivals(spark.createDataFrame([('{"timestamp":""}',), ('{"timestamp":"x"}',), ("{}",)], "value string"))
    assert rows.where(F.col("event_ts") == F.col("ingest_ts")).count() == 3
