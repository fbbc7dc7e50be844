"""Run the continuous job with the Kafka connector, or ``merge`` its tables: ``python -m siftline [merge]``."""

import sys
import warnings
from dataclasses import replace
from functools import partial

from pyspark.sql import SparkSession

from siftline.operators.decode import QUARANTINE
from siftline.operators.lexicon import load_words
from siftline.session import prepare
from siftline.settings import Settings
from siftline.sinks import files
from siftline.sinks.fanout import FanOut
from siftline.sinks.feed import RejectFiles, TopicFeed
from siftline.sinks.lake import TABLES, LakeSink
from siftline.sinks.olap import JdbcOlap, OlapSink
from siftline.sources.kafka import TopicSource
from siftline.sources.tables import create_lake_tables, create_olap_table, publish_all, publish_copies
from siftline.streaming.job import starters
from siftline.streaming.supervise import Supervisor


def sinks_for(spark: SparkSession, settings: Settings) -> FanOut:
    root = files.qualified(spark, settings.warehouse or spark.conf.get("spark.sql.warehouse.dir"))
    lake = LakeSink(
        f"{root}/{settings.namespace}",
        settings.distribution,
        settings.file_bytes,
        settings.writers,
        measured=True,
    )
    if settings.olap_url:
        olap = JdbcOlap(
            settings.olap_url,
            settings.olap_user,
            settings.olap_password,
            f"{settings.olap_database}.{settings.olap_table}",
        )
    else:
        olap = OlapSink(f"{root}/{settings.olap_database}", settings.olap_table, measured=True)
    sinks = FanOut(
        words=load_words(spark, settings.words_path),
        feed=TopicFeed(settings.bootstrap_servers),
        lake=lake,
        olap=olap,
        rejects=RejectFiles(f"{root}/rejects") if settings.decode_mode == QUARANTINE else None,
    )
    return replace(sinks, written=partial(publish_all, sinks=published(settings, sinks)))


def published(settings: Settings, sinks: FanOut) -> list[tuple[str, LakeSink | OlapSink]]:
    """The sinks whose tables have a name, with their namespace."""
    found: list[tuple[str, LakeSink | OlapSink]] = [(settings.namespace, sinks.lake)]
    return found + [(settings.olap_database, sinks.olap)] if isinstance(sinks.olap, OlapSink) else found


def create_tables(spark: SparkSession, settings: Settings, sinks: FanOut) -> None:
    """The tables of the sinks by name, each only if absent."""
    if spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        warnings.warn("without a persistent catalog table names end with this session; read the tables by path", stacklevel=2)
    create_lake_tables(spark, settings.namespace, sinks.lake)
    if isinstance(sinks.olap, OlapSink):
        create_olap_table(spark, settings.olap_database, sinks.olap)


def merge_all(spark: SparkSession, settings: Settings) -> None:
    """Compact the lake, deduplicate the analytics table, each into a table of its own, and show them in the catalog."""
    prepare(spark)
    sinks = sinks_for(spark, settings)
    create_tables(spark, settings, sinks)
    for table in TABLES:
        sinks.lake.compact(spark, table)
    if isinstance(sinks.olap, OlapSink):
        sinks.olap.merge(spark)
    publish_copies(spark, published(settings, sinks))


def main(command: str = "run") -> None:
    settings = Settings.from_env()
    spark = SparkSession.builder.appName(settings.job_name).getOrCreate()
    if command == "merge":
        merge_all(spark, settings)
        return
    if not settings.checkpoint:
        raise SystemExit("set CHECKPOINTS_DIRECTORY: with a new checkpoint everything would be stored again")
    sinks = sinks_for(spark, settings)
    create_tables(spark, settings, sinks)
    queries = starters(
        spark,
        TopicSource(settings.bootstrap_servers, max_offsets=settings.max_offsets),
        sinks,
        settings.checkpoint,
        settings.interval_ms,
        settings.prompt_ms,
        settings.job_name,
    )
    Supervisor(spark, queries, settings.tolerated_failures, settings.pause_ms).run()


if __name__ == "__main__":
    main(*sys.argv[1:2])
