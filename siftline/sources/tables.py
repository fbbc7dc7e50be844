"""Catalog side: create, list, describe and read the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siftline.operators.convert import with_event_month
from siftline.schema import LAKE_DAY, LAKE_SCHEMA, OLAP_KEY, OLAP_MONTH, OLAP_STORED_SCHEMA
from siftline.sinks import files
from siftline.sinks.batches import batch_dir, committed, current_stream, partitions_of
from siftline.sinks.lake import TABLES, LakeSink, compacted
from siftline.sinks.olap import OlapSink


# Partitions named in one statement to the catalog.
AT_ONCE = 500

BATCH_PARTITIONS = "stream_id STRING, batch BIGINT, "


def create_lake_tables(spark: SparkSession, namespace: str, lake: LakeSink) -> None:
    """Namespace, both lake tables and their compacted copies over the sink's folders, each only if absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    for table in TABLES:
        _create(spark, f"{namespace}.{table}", LAKE_SCHEMA, f"{BATCH_PARTITIONS}{LAKE_DAY} DATE", lake.path(table))
        _create(spark, f"{namespace}.{compacted(table)}", LAKE_SCHEMA, f"{LAKE_DAY} DATE", lake.compacted_path(table))


def create_olap_table(spark: SparkSession, namespace: str, olap: OlapSink) -> None:
    """Namespace, the table of all versions and the merged one, each only if absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    _create(spark, f"{namespace}.{olap.table}", OLAP_STORED_SCHEMA, f"{BATCH_PARTITIONS}{OLAP_MONTH} INT", olap.path)
    _create(spark, f"{namespace}.{olap.merged}", OLAP_STORED_SCHEMA, f"{OLAP_MONTH} INT", olap.merged_path)


def _create(spark: SparkSession, name: str, schema, partitions: str, path: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(part.split()[0] for part in partitions.split(", "))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {partitions}) USING parquet "
        f"PARTITIONED BY ({keys}) LOCATION '{files.qualified(spark, path)}'"
    )


def store_bucketed(rows: DataFrame, name: str, path: str, buckets: int | None = None) -> DataFrame:
    """Store analytics rows as a table by month whose files are cut and sorted by key; returns the table.

    What groups by the key, deduplication and the duplicate check, then reads it without a shuffle. ``buckets`` should
    leave a month's bucket below the memory of a task; by default there are as many as shuffle partitions.
    """
    spark = rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = with_event_month(rows).repartition(buckets, *OLAP_KEY)  # one file per bucket and month
    writer = cut.write.mode("overwrite").format("parquet").option("path", files.qualified(spark, path))
    writer.partitionBy(OLAP_MONTH).bucketBy(buckets, *OLAP_KEY).sortBy(*OLAP_KEY).saveAsTable(name)
    return spark.table(name)


def publish(spark: SparkSession, name: str, path: str) -> None:
    """Make the catalog table show all that is committed, as where batches were written without it.

    Only catalog entries change, never files. Reading by path needs no such step.
    """
    for folder in committed(spark, path):
        _add(spark, name, path, partitions_of(spark, path, folder))


def publish_copies(spark: SparkSession, sinks: list[tuple[str, LakeSink | OlapSink]]) -> None:
    """Make the catalog show the partitions of the compacted and merged tables that have been made."""
    for namespace, sink in sinks:
        if isinstance(sink, LakeSink):
            made = [(compacted(table), sink.compacted_path(table)) for table in TABLES]
        else:
            made = [(sink.merged, sink.merged_path)]
        for table, path in made:
            if files.exists(spark, path):
                spark.sql(f"MSCK REPAIR TABLE {namespace}.{table}")


def publish_batch(spark: SparkSession, name: str, path: str, batch_id: int) -> None:
    """Show the partitions of one batch of the running stream, whatever came before it."""
    folder = batch_dir(path, current_stream(spark), batch_id).removeprefix(f"{path}/")
    _add(spark, name, path, partitions_of(spark, path, folder))


def _add(spark: SparkSession, name: str, path: str, partitions: list[str]) -> None:
    root = files.qualified(spark, path)
    specs = [f"PARTITION ({_spec(p)}) LOCATION '{root}/{p}'" for p in partitions]
    for first in range(0, len(specs), AT_ONCE):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[first : first + AT_ONCE])}")


def named_tables(sinks: list[tuple[str, LakeSink | OlapSink]]) -> list[tuple[str, str]]:
    """(table name, path) of each sink given with its namespace."""
    found = []
    for namespace, sink in sinks:
        if isinstance(sink, LakeSink):
            found += [(f"{namespace}.{table}", sink.path(table)) for table in TABLES]
        else:
            found.append((f"{namespace}.{sink.table}", sink.path))
    return found


def publish_all(
    spark: SparkSession, batch_id: int | None = None, *, sinks: list[tuple[str, LakeSink | OlapSink]]
) -> None:
    """``publish_batch`` for the tables of each sink, or ``publish`` without a batch."""
    for name, path in named_tables(sinks):
        if batch_id is None:
            publish(spark, name, path)
        else:
            publish_batch(spark, name, path, batch_id)


def _spec(folder: str) -> str:
    pairs = (part.split("=", 1) for part in folder.split("/"))
    return ", ".join(f"{column}='{value}'" for column, value in pairs)


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """Tables of the namespace; the session's own temporary views are none of them."""
    shown = spark.sql(f"SHOW TABLES FROM {namespace}").where("NOT isTemporary")
    return shown.select("namespace", "tableName")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def sample(table: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows, all columns."""
    return table.limit(n)
