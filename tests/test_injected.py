"""The job on an injected stream: offsets, a failing batch, resuming, and counts that add up."""

from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException

from siftline.schema import PROFANE_TABLE, SAFE_TABLE
from siftline.sinks.collected import Collected
from siftline.sinks.fanout import FanOut, ReportFiles, lost_rows
from siftline.sinks.feed import FileFeed
from siftline.sinks.lake import LakeSink
from siftline.sinks.olap import OlapSink
from siftline.sources.injected import Injected
from siftline.streaming.job import run

ROWS = [
    {"account_id": "a", "message_id": str(i), "message_body": "a gun" if i % 3 == 0 else "fine", "timestamp": "2025-01-01T10:00:00Z"}
    for i in range(20)
]


def _ids(df):
    return sorted(int(r.message_id) for r in df.select("message_id").collect())


def _sinks(root):
    return FanOut(
        ["gun"], Collected(f"{root}/feed"), LakeSink(f"{root}/lake"), OlapSink(f"{root}/olap"), report=ReportFiles(f"{root}/report")
    )


def test_positions_are_dealt_and_kept(spark, tmp_path):
    got = []

    def keep(batch, batch_id):
        got.extend((batch_id, r.source_partition, r.offset, int(r.message_id)) for r in batch.collect())

    run(spark, Injected(ROWS, 3, 7), keep_as(keep), f"{tmp_path}/c")
    run(spark, Injected(ROWS, 3), keep_as(keep), f"{tmp_path}/c")
    assert sorted((p, o) for _, p, o, _ in got) == sorted((i % 3, i // 3) for i in range(20))
    assert all(i == o * 3 + p for _, p, o, i in got)
    assert {i for b, _, _, i in got if b == 0} == set(range(7))


def keep_as(function):
    class Kept:
        rejects = None

        def __call__(self, batch, batch_id):
            function(batch, batch_id)

    return Kept()


def test_job_fails_in_its_second_batch_and_resumes(spark, tmp_path):
    sinks = _sinks(tmp_path)
    run(spark, Injected(ROWS, 2, 8), sinks, f"{tmp_path}/checkpoint")

    def broken(batch, batch_id):
        sinks.feed(batch, batch_id)
        raise RuntimeError("feed down")

    with pytest.raises(StreamingQueryException, match="feed down"):
        run(spark, Injected(ROWS, 2), replace(sinks, feed=broken), f"{tmp_path}/checkpoint")
    assert _ids(sinks.olap.read_all(spark)) == list(range(8))
    run(spark, Injected(ROWS, 2), sinks, f"{tmp_path}/checkpoint")
    profane = [i for i in range(20) if i % 3 == 0]
    assert _ids(sinks.feed.read(spark)) == profane
    assert _ids(sinks.olap.read_all(spark)) == list(range(20))
    assert _ids(sinks.lake.read(spark, PROFANE_TABLE)) == profane
    assert _ids(sinks.lake.read(spark, SAFE_TABLE)) == [i for i in range(20) if i % 3]


def test_collected_batches_are_all_or_nothing(spark, tmp_path):
    sink = Collected(f"{tmp_path}/feed")
    rows = spark.range(0, 40, 1, 4).selectExpr(
        "'a' AS account_id", "if(id = 39, raise_error('bad row'), string(id)) AS message_id", "'' AS message_body",
        "'' AS correlation_id", "'' AS message_status", "'' AS timestamp", "'' AS profanity_type",
    )
    with pytest.raises(Exception, match="bad row"):
        sink(rows, 0)
    assert sink.read(spark).count() == 0
    assert not list((tmp_path / "feed").glob("batch-*"))
    good = rows.where("account_id = 'a'").withColumn("message_id", rows.account_id)
    for _ in range(2):  # a batch that is written again counts once
        sink(good, 0)
    assert sink.read(spark).count() == 40


def test_counts_of_a_batch_add_up(spark, tmp_path):
    sinks = replace(_sinks(tmp_path), feed=FileFeed(f"{tmp_path}/f"))
    run(spark, Injected(ROWS, 2, 8), sinks, f"{tmp_path}/checkpoint")
    run(spark, Injected(ROWS, 2), sinks, f"{tmp_path}/checkpoint")
    reports = {}
    for r in sinks.report.read(spark).collect():
        reports.setdefault(r.batch_id, {})[r.name] = r.n
    assert reports[0] == {
        "arrived": 8, "rejected": 0, "profane": 3, "safe": 5, "feed": 3, "olap": 8, PROFANE_TABLE: 3, SAFE_TABLE: 5,
    }
    assert reports[1]["arrived"] == 12 and all(lost_rows(r) == {} for r in reports.values())
    assert lost_rows(reports[0] | {SAFE_TABLE: 4, "feed": 2}) == {"lake": -1, "feed": -1}


def test_counting_reads_nothing_again(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def note(x):
        calls.add(1)
        return x

    from pyspark.sql import functions as F

    noted = F.udf(note)
    sinks = replace(_sinks(tmp_path), feed=FileFeed(f"{tmp_path}/f"))
    source = Injected(ROWS, 2)
    run(spark, lambda s: source(s).withColumn("message_body", noted("message_body")), sinks, f"{tmp_path}/checkpoint")
    assert calls.value == 20
