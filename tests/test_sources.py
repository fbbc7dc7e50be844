from types import SimpleNamespace

import pytest

from siftline.__main__ import sinks_for
from siftline.operators.decode import FAILFAST, QUARANTINE
from siftline.session import RUNTIME_CONF, prepare, shared_dir
from siftline.settings import Settings
from siftline.sources.kafka import TopicSource
from siftline.sources.local import LineFiles, messages


def test_topic_source_options():
    assert TopicSource("broker:29092").options() == {
        "kafka.bootstrap.servers": "broker:29092",
        "subscribe": "profanity_words",
        "startingOffsets": "earliest",
        "kafka.group.id": "flink-test",
    }


def test_bounded_topic_reads_up_to_latest():
    options = TopicSource("b:1", bounded=True, min_partitions=12, max_offsets=5).options()
    assert options["endingOffsets"] == "latest"
    assert options["minPartitions"] == "12"
    assert "maxOffsetsPerTrigger" not in options


def test_stream_batch_size_is_bounded():
    assert TopicSource("b:1", max_offsets=5).options()["maxOffsetsPerTrigger"] == "5"


def test_a_source_per_partition_reads_only_that_one():
    parts = TopicSource("b:1", max_offsets=7).per_partition(3)
    assert [p.options()["assign"] for p in parts] == [f'{{"profanity_words": [{n}]}}' for n in range(3)]
    assert all("subscribe" not in p.options() and p.options()["maxOffsetsPerTrigger"] == "2" for p in parts)


def test_line_files_as_batch_and_stream(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1}\n{"a":2}\n')
    assert LineFiles(str(tmp_path), streaming=False)(spark).count() == 2
    assert LineFiles(str(tmp_path))(spark).isStreaming


def test_injected_messages(spark):
    row = messages(spark, [{"message_id": "1"}]).first()
    assert row.message_id == "1" and row.account_id is None


def test_settings_defaults():
    s = Settings.from_env({})
    assert (s.bootstrap_servers, s.interval_ms, s.distribution) == ("broker:29092", 300_000, "HASH")
    assert (s.file_bytes, s.namespace, s.olap_table) == (134_217_728, "raw_data", "message_events")
    assert s.writers is None and s.checkpoint is None and s.decode_mode == FAILFAST


def test_settings_from_environment(spark, tmp_path):
    s = Settings.from_env(
        {
            "CHECKPOINT_INTERVAL": "1000",
            "WRITE_PARALLELISM": "4",
            "ICEBERG_DISTRIBUTION_MODE": "range",
            "ICEBERG_NAMESPACE": "raw_messages",
            "SIFTLINE_WAREHOUSE": str(tmp_path),
            "SIFTLINE_DECODE_MODE": QUARANTINE,
        }
    )
    sinks = sinks_for(spark, s)
    assert sinks.lake.writers == 4 and sinks.lake.root == f"file:{tmp_path}/raw_messages"
    assert sinks.rejects is not None and "hate" in sinks.words
    assert sinks_for(spark, Settings.from_env({})).rejects is None
    jdbc = sinks_for(spark, Settings.from_env({"CLICKHOUSE_JDBC_URL": "jdbc:x://h/d"})).olap
    assert jdbc.options()["dbtable"] == "default.message_events"
    assert jdbc.options()["batchsize"] == "5000"


def test_prepare_sets_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    prepare(spark)
    assert all(spark.conf.get(key) == value for key, value in RUNTIME_CONF.items())


class _Session:
    """The two things ``shared_dir`` asks a session for."""

    def __init__(self, master, checkpoint_dir=None):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default=None: checkpoint_dir)


def test_shared_dir_follows_the_cluster_setting():
    session = _Session("spark://cluster:7077", "/shared/place/")
    first, second = shared_dir(session, "x"), shared_dir(session, "x")
    assert first.startswith("/shared/place/siftline/x-") and first != second


def test_shared_dir_is_local_only_in_local_mode():
    with pytest.raises(ValueError):
        shared_dir(_Session("spark://cluster:7077"), "x")
    assert "siftline" in shared_dir(_Session("local[2]"), "x")
